"""Intervention priority of a predicted rate."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseframe.schema import HIGH, LOW, LOW_MAX, MEDIUM, MEDIUM_MAX


def clamp_rate(col: Column) -> Column:
    """Negative predictions become 0, the rest is rounded to 2 places."""
    return F.when(col < 0, F.lit(0.0)).otherwise(F.round(col, 2))


def priority(col: Column) -> Column:
    """Band of a rate. Null stays null; NaN sorts above all and lands in the top band."""
    return (
        F.when(col.isNull(), F.lit(None).cast("string"))
        .when(col <= LOW_MAX, F.lit(LOW))
        .when(col <= MEDIUM_MAX, F.lit(MEDIUM))
        .otherwise(F.lit(HIGH))
    )
