"""Raw CSV to cleaned parquet and CSV."""

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from caseframe.operators.cleaning import clean
from caseframe.sources import (
    publication,
    read_raw_lines,
    read_rows,
    unsorted_writes,
    write_clean,
    write_csv,
)


def preprocess(
    spark: SparkSession, train_path: str, test_path: str, out_dir: str, multi_line: bool = False
) -> DataFrame:
    """Clean both sets, write them, and return the row report.

    Each raw set is scanned once, by the parquet write, which also counts the rows
    of the report. The CSV copies read the county and state folders of the parquet
    just written. The two sets are worked on side by side, so that the last tasks of
    one do not leave the cores idle.

    Outputs of ``out_dir``: ``parquet/{train,test}``, ``csv/{train,test}``
    with the county rows, ``csv/{train,test}_state`` with the state rows. Malformed
    lines are counted in the report and kept as text under ``level=rejected``. All
    outputs are published together, when the last one is written; until then, and
    where the stage fails, readers see those of the run before.
    """
    sets = {"train": train_path, "test": test_path}

    def written(dataset: str) -> dict[str, int]:
        target = f"{staged}/parquet/{dataset}"
        counts = write_clean(clean(read_raw_lines(spark, sets[dataset], multi_line)), target)
        for end, level in (("", "county"), ("_state", "state")):
            write_csv(read_rows(spark, target, level), f"{staged}/csv/{dataset}{end}")
        return counts

    with publication(spark, out_dir) as staged, unsorted_writes(spark):
        with ThreadPoolExecutor(len(sets)) as pool:
            counted = list(pool.map(inheritable_thread_target(spark)(written), sets))
    report = [
        (dataset, level, n)
        for dataset, counts in zip(sets, counted, strict=True)
        for level, n in counts.items()
    ]
    return spark.createDataFrame(report, "dataset string, level string, n_rows long")
