"""Totals and mean rates by disease, year, sex and county, and growth by disease.

Every grouping is a partial aggregation before its shuffle, so a key that
holds a third of all rows still sends one row per input task. Every order ends
with the group key, which makes the limits repeatable.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseframe.functions import mean_rate, percent_growth
from caseframe.operators.selection import only_disease, only_sexes
from caseframe.schema import SEXES

Period = tuple[int, int]


def _totals(df: DataFrame, key: str, digits: int | None, rate: str = "Avg_Rate") -> DataFrame:
    return df.groupBy(key).agg(
        F.sum("Count").alias("Total_Cases"), mean_rate(digits=digits).alias(rate)
    )


def top_diseases(
    df: DataFrame,
    limit: int = 15,
    round_to: int | None = 2,
    sexes: Sequence[str] | None = None,
) -> DataFrame:
    totals = _totals(only_sexes(df, sexes), "Disease", round_to, rate="Avg_Prevalence_Rate")
    return totals.orderBy(F.desc("Total_Cases"), "Disease").limit(limit)


def yearly_trends(
    df: DataFrame,
    disease: str | None = None,
    round_to: int | None = 2,
    sexes: Sequence[str] | None = None,
) -> DataFrame:
    rows = only_sexes(only_disease(df, disease), sexes)
    return _totals(rows, "Year", round_to).orderBy("Year")


def sex_distribution(df: DataFrame, disease: str | None = None) -> DataFrame:
    """Totals of the two sexes and their share of both, without a driver round trip.

    The window spans the aggregated rows, of which there are at most two.
    """
    totals = _totals(only_sexes(only_disease(df, disease), SEXES), "Sex", 2)
    everyone = F.sum("Total_Cases").over(Window.partitionBy())
    share = F.try_divide(F.col("Total_Cases"), everyone) * F.lit(100)
    return totals.withColumn("Percentage", F.round(share, 2)).orderBy(
        F.desc("Total_Cases"), "Sex"
    )


def county_hotspots(
    df: DataFrame, disease: str, limit: int = 10, sexes: Sequence[str] | None = None
) -> DataFrame:
    """Counties with the highest mean rate; the order is that of the rounded rate."""
    rows = only_sexes(df.filter(F.col("Disease") == disease), sexes)
    return _totals(rows, "County", 2).orderBy(F.desc("Avg_Rate"), "County").limit(limit)


def disease_growth(
    df: DataFrame, early: Period = (2001, 2005), late: Period = (2010, 2014)
) -> DataFrame:
    """Growth of the case totals between two periods.

    One scan: both periods are conditional sums of the same grouping, and only
    diseases with rows in both are kept. The year test reaches the scan.
    """
    before, after = (f"Cases_{first}_{last}" for first, last in (early, late))
    in_early, in_late = F.col("Year").between(*early), F.col("Year").between(*late)
    totals = (
        df.filter((in_early | in_late) & F.col("Disease").isNotNull())
        .groupBy("Disease")
        .agg(
            F.sum(F.when(in_early, F.col("Count"))).alias(before),
            F.sum(F.when(in_late, F.col("Count"))).alias(after),
            (F.bool_or(in_early) & F.bool_or(in_late)).alias("in_both"),
        )
        .filter("in_both")
    )
    growth = percent_growth(F.col(before), F.col(after))
    return totals.select(
        "Disease",
        before,
        after,
        (F.col(after) - F.col(before)).alias("Absolute_Increase"),
        F.round(growth, 2).alias("Percentage_Growth"),
    ).orderBy(F.desc("Percentage_Growth"), "Disease")
