"""Sinks. Each one is an action and overwrites its target."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caseframe.operators.cleaning import with_level
from caseframe.operators.risk import prediction_columns
from caseframe.schema import LEVELS

#: Files that a task of a write by folders holds open, before it sorts what is left.
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_OPENED = 32


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Writes by folders inside need no sort of the rows, where a task has few folders."""
    before = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, str(_OPENED))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


def write_clean(cleaned: DataFrame, path: str) -> dict[str, int]:
    """Cleaned rows as parquet under ``level=.../Year=...``, in one pass over the input.

    County rows, state rows and rows without a county land in folders of their
    own, so no second scan of the raw text is needed to tell them apart. The
    rebalance hint gathers the rows of a folder into files of the advisory
    size and splits a folder that holds a large share of all rows over many
    tasks; without it every task would write one file per folder.

    Returns the rows written by level, counted by the write itself. They are counted
    in the tasks that write, behind the shuffle: a result task counts once, however
    often the shuffle is repeated for executors that were lost.
    """
    counts = Observation()
    level = F.col("level")
    rows = with_level(cleaned).hint("rebalance", "level", "Year")
    (
        rows.observe(counts, *(F.count_if(level == name).alias(name) for name in LEVELS))
        .write.mode("overwrite")
        .partitionBy("level", "Year")
        .parquet(path)
    )
    return {name: n for name, n in counts.get.items() if n}


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with headers, written by all tasks side by side."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    write_csv(prediction_columns(predictions), path)


def write_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
