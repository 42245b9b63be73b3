"""Equal rows told apart."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOGETHER = 100_000


def numbered_copies(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the number (from 1) of each row among those equal to it in all columns.

    The numbers do not depend on where the rows are. Equal rows are counted, partly
    before the shuffle, and written out again by number, so that a row that makes up
    much of the table is never a group of that size.
    """
    counted = df.groupBy(*(f"`{column}`" for column in df.columns)).agg(
        F.count(F.lit(1)).alias("_n")
    )
    hundred = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / _TOGETHER)))
    first = F.col("_part") * _TOGETHER
    last = F.least(F.col("_n"), first + _TOGETHER)
    return (
        counted.withColumn("_part", hundred)
        .withColumn(name, F.explode(F.sequence(first + 1, last)))
        .drop("_n", "_part")
    )
