"""Categories as numbers: ranks by frequency, and means of the label out of fold.

Both are tables that are joined to the rows, so the labels stay in the cluster,
however many there are; a driver learns at most how many.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseframe.sources.working import materialise

FOLDS = 5
#: How many rows the mean of all rows counts for in the mean of a category.
STRENGTH = 10.0


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with its place (from 0) in an order that has no ties, without one task for all.

    Rows are dealt by ranges of the order and written; a row's place is its place
    in its range after the rows of the ranges before.
    """
    dealt = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: as many as the shuffle has partitions.
    starts = (
        dealt.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (
        dealt.join(starts, "_range")
        .withColumn(name, F.col("_start") + within)
        .drop("_range", "_start")
    )


def frequency_ranks(df: DataFrame, column: str) -> DataFrame:
    """``column``, ``n`` and ``rank``: the most frequent value has 0, ties go by the value.

    Missing values have none. Runs a job, which writes the counted values.
    """
    value = F.col(column).cast("string")
    counts = (
        df.select(value.alias(column))
        .filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return materialise(numbered(counts, [F.desc("n"), F.asc(column)], "rank"))


def with_ranks(df: DataFrame, ranks: dict[str, DataFrame]) -> DataFrame:
    """Adds ``<column>_Index``; unknown and missing values share the number after the last."""
    for column, table in ranks.items():
        known = table.select(
            F.col(column).alias("_value"), F.col("rank").cast("double").alias("_rank")
        )
        n_labels = table.agg(F.count(F.lit(1)).cast("double")).scalar()
        df = (
            df.join(known, F.col(column).cast("string") == F.col("_value"), "left")
            .withColumn(f"{column}_Index", F.coalesce("_rank", n_labels))
            .drop("_value", "_rank")
        )
    return df


def label_counts(ranks: dict[str, DataFrame]) -> dict[str, int]:
    return {column: table.count() for column, table in ranks.items()}


def _nominal(column: str, n_values: int) -> Column:
    """The column with its number of values told, so that no pass has to count them."""
    told = {"ml_attr": {"type": "nominal", "num_vals": n_values, "name": column}}
    return F.col(column).alias(column, metadata=told)


def assembled(
    indexed: DataFrame, n_labels: dict[str, int], first: str = "Year", last: str = "Population"
) -> DataFrame:
    """Adds ``features`` to rows with ``<column>_Index``; a projection, so rows keep their places."""
    indexed = indexed.withColumns(
        {f"{column}_Index": _nominal(f"{column}_Index", n + 1) for column, n in n_labels.items()}
    )
    encoder = OneHotEncoder(
        inputCols=[f"{column}_Index" for column in n_labels],
        outputCols=[f"{column}_Vec" for column in n_labels],
    )
    vectors = [f"{column}_Vec" for column in n_labels]
    assembler = VectorAssembler(
        inputCols=[first, *vectors, last], outputCol="features", handleInvalid="keep"
    )
    encoded = encoder.fit(indexed).transform(indexed)
    helpers = [f"{column}_Index" for column in n_labels] + vectors
    return assembler.transform(encoded).drop(*helpers)


def feature_vectors(df: DataFrame, ranks: dict[str, DataFrame]) -> DataFrame:
    """Adds ``features``: the year, a slot per known category value, and the population.

    A value that the ranks do not have sets no slot. A missing number is NaN.
    """
    return assembled(with_ranks(df, ranks), label_counts(ranks))


# Means of the label


def fold_of(columns: Sequence[str], folds: int = FOLDS) -> Column:
    """A fold for each row by its content, so alike in every layout."""
    return F.pmod(F.xxhash64(*columns), F.lit(folds))


def label_means(df: DataFrame, column: str, label: str, fold: Column) -> DataFrame:
    """``column``, ``fold``, ``mean``: the label's mean in a category over all other folds.

    The mean of all rows counts for ``STRENGTH`` rows, so a category that is found
    in one fold only has that mean. The row without a fold has the mean over all
    folds, for rows that were not learnt from. A missing value is a category.
    """
    sums = df.select(F.col(column), fold.alias("fold"), F.col(label).alias("_label")).groupBy(
        column, "fold"
    )
    sums = sums.agg(F.sum("_label").alias("total"), F.count("_label").alias("n"))
    everything = df.agg(F.avg(label)).scalar()
    # Few rows per category here, one for each fold.
    whole = Window.partitionBy(column)
    others = sums.select(
        column,
        "fold",
        (F.sum("total").over(whole) - F.col("total")).alias("total"),
        (F.sum("n").over(whole) - F.col("n")).alias("n"),
    )
    of_all = sums.groupBy(column).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    both = others.unionByName(of_all.withColumn("fold", F.lit(None).cast("long")).select(others.columns))
    mean = (F.col("total") + everything * STRENGTH) / (F.col("n") + STRENGTH)
    return both.select(column, F.col("fold").cast("long").alias("fold"), mean.alias("mean"))


def with_means(
    df: DataFrame, means: dict[str, DataFrame], otherwise: float, fold: Column | None = None
) -> DataFrame:
    """Adds ``<column>_Mean``, out of the row's ``fold`` or, without one, over all folds.

    Categories that were not learnt from have ``otherwise``.
    """
    df = df if fold is None else df.withColumn("_fold", fold)
    for column, table in means.items():
        wanted = table.filter(F.col("fold").isNull() if fold is None else F.col("fold").isNotNull())
        known = wanted.select(
            F.col(column).alias("_value"), F.col("fold").alias("_of"), F.col("mean").alias("_mean")
        )
        same = F.col(column).eqNullSafe(F.col("_value"))
        if fold is not None:
            same = same & (F.col("_fold") == F.col("_of"))
        df = (
            df.join(known, same, "left")
            .withColumn(f"{column}_Mean", F.coalesce("_mean", F.lit(otherwise)))
            .drop("_value", "_of", "_mean")
        )
    return df.drop("_fold")


@dataclass
class RankedModel:
    """A forest over feature vectors, with the tables of ranks these are made by."""

    ranks: dict[str, DataFrame]
    forest: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.forest.transform(feature_vectors(df, self.ranks))

    def save(self, path: str) -> None:
        for column, table in self.ranks.items():
            table.write.mode("overwrite").parquet(f"{path}/ranks/{column}")
        self.forest.write().overwrite().save(f"{path}/forest")

    @staticmethod
    def load(spark: SparkSession, path: str, columns: Sequence[str]) -> "RankedModel":
        ranks = {column: spark.read.parquet(f"{path}/ranks/{column}") for column in columns}
        return RankedModel(ranks, PipelineModel.load(f"{path}/forest"))


@dataclass
class MeanCodedModel:
    """A forest over label means, with the tables these come from."""

    means: dict[str, DataFrame]
    otherwise: float
    forest: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.forest.transform(with_means(df, self.means, self.otherwise))
