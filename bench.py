"""Wall seconds of the registered queries, as one JSON line.

Each query runs once to warm up and is then timed; the median counts. Results
go to the ``noop`` sink, so that every row and column is computed and nothing
is collected. The time covers building the plan as well, including the model
fits and the intermediate tables a query writes.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (timed runs
per query, alike for all), BENCH_QUERIES (comma-separated names, default all of
the analyses).
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("caseframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        seconds(spark, name, sf_dir)
        timings[name] = round(
            statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of all registered queries, warm",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
