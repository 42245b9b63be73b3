"""The batch stages from the command line, in the session the launcher configures.

    python -m caseframe preprocess TRAIN_CSV TEST_CSV OUT [--multi-line]
    python -m caseframe analyse OUT
    python -m caseframe train OUT
"""

import argparse

from pyspark.sql import SparkSession

from caseframe.plans.analyse import analyse
from caseframe.plans.preprocess import preprocess
from caseframe.plans.train import train_and_score
from caseframe.sources import read_rows


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="caseframe")
    stages = parser.add_subparsers(dest="stage", required=True)
    first = stages.add_parser("preprocess", help="raw CSV to cleaned parquet and CSV")
    first.add_argument("train")
    first.add_argument("test")
    first.add_argument("out")
    first.add_argument(
        "--multi-line", action="store_true", help="quoted fields may hold line breaks"
    )
    for name, text in (
        ("analyse", "show the standing analyses of the cleaned training rows"),
        ("train", "fit the rate model, store it and its predictions, show the metrics"),
    ):
        stages.add_parser(name, help=text).add_argument("out")
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"caseframe-{chosen.stage}").getOrCreate()
    if chosen.stage == "preprocess":
        report = preprocess(spark, chosen.train, chosen.test, chosen.out, chosen.multi_line)
        report.show(truncate=False)
    elif chosen.stage == "analyse":
        for name, result in analyse(read_rows(spark, f"{chosen.out}/parquet/train")).items():
            print(name)
            result.show(truncate=False)
    else:
        train_and_score(spark, chosen.out, chosen.out).show(truncate=False)


if __name__ == "__main__":
    main()
