"""Intermediate tables, links between rows and other steps that several operators need."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Shuffle files of a written intermediate go when the write has ended.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows go to Python in batches of so many bytes: 10,000 long rows at once take an
#: executor's memory several times over, in the JVM's buffers and in the worker's.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BYTES = 4 << 20


def work_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, as in tests, the tables go below the warehouse, which all
    executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A path for one table, removed when the application ends."""
    path = f"{work_folder(spark)}/llm-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the work folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = new_folder(spark)
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """From now on, batches for Python are bounded in bytes in all jobs of the session."""
    spark.conf.set(_BATCH_BYTES, str(_BYTES))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches for Python are bounded in bytes in the jobs that run inside."""
    before = spark.conf.get(_BATCH_BYTES)
    bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many lines before them as tell them from the columns of ``df``."""
    taken = {name.lower() for name in df.columns}
    before = "_"
    while any((before + name).lower() in taken for name in names):
        before += "_"
    return [before + name for name in names]


def texts(documents: DataFrame, *others: str) -> DataFrame:
    """``doc_id`` (long), ``text`` (null: empty) and the other columns named."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *others,
    )


def groups(frames: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of equal key, from frames sorted by it; a group may span frames."""
    rest = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if frame.empty:
            continue
        new = np.zeros(len(frame), bool)
        for name in key:
            values = frame[name].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        for start, end in zip(starts, starts[1:], strict=False):
            yield frame.iloc[start:end]
        rest = frame.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` of all ends of the edges (long ``a``, ``b``).

    A component is named by its smallest node. Every round takes the smallest
    name among the neighbours and follows it to the name that it had itself, so
    chains halve. The edges are read in each round: give a written table. A
    round is one job and one table. Its joins are on freshly shuffled keys of
    stored tables, so adaptive execution can split a node that has very many
    edges or a name that very many nodes have.
    """
    ends = edges.filter("a <> b").select("a", "b")
    both = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
    names = written(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component"))
    )
    while True:
        seen = names.select(F.col("node").alias("b"), F.col("component").alias("seen"))
        nearest = both.join(seen, "b").groupBy(F.col("a").alias("node")).agg(
            F.min("seen").alias("seen")
        )
        step = names.join(nearest, "node", "left").select(
            "node", "component", F.least("component", "seen").alias("next")
        )
        further = names.select(F.col("node").alias("next"), F.col("component").alias("root"))
        jumped = step.join(further, "next", "left").select(
            "node", "component", F.coalesce("root", "next").alias("name")
        )
        changes = Observation()
        lower = F.count(F.when(F.col("name") < F.col("component"), 1))
        names = written(
            jumped.observe(changes, lower.alias("n")).select(
                "node", F.col("name").alias("component")
            )
        )
        if not changes.get["n"]:
            return names


def whole_groups(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames of sorted rows, cut anew so that no group of equal key is in two of them."""
    rest = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if frame.empty:
            continue
        values = frame[key].to_numpy()
        last = int(np.argmax(values == values[-1]))
        rest = frame.iloc[last:]
        if last:
            yield frame.iloc[:last].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def array_sum(df: DataFrame, column: str, zero: np.ndarray) -> np.ndarray:
    """Sum of the arrays in a binary column, added up in a tree of tasks."""
    kind, shape = zero.dtype, zero.shape

    def add(total, row):
        return total + np.frombuffer(row[column], kind).reshape(shape)

    return df.select(column).rdd.treeAggregate(zero, add, np.add, depth=3)
