"""Figures and chart data of the overview and trend screens.

These differ from the rankings in two ways: means are not rounded, and rows
whose group key is missing form no group.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseframe.operators.rankings import top_diseases, yearly_trends
from caseframe.operators.selection import only_sexes
from caseframe.schema import ALL_DISEASES, NOT_AVAILABLE, SEXES


def key_figures(df: DataFrame, disease: str | None = None) -> DataFrame:
    """One row: total cases, mean rate, county and disease with most cases.

    The rows are scanned once and reduced to one row per county and disease;
    the three levels of totals come from that reduced table. Equal totals go
    to the name that sorts first. An empty input gives 0, null and ``N/A``.
    """
    cells = df.groupBy("County", "Disease").agg(
        F.sum("Count").alias("cases"),
        F.sum("Recalculated_Rate").alias("rate_sum"),
        F.count("Recalculated_Rate").alias("rate_n"),
    )
    levels = cells.groupingSets(
        [["County"], ["Disease"], []], "County", "Disease"
    ).agg(
        F.coalesce(F.sum("cases"), F.lit(0)).alias("cases"),
        F.sum("rate_sum").alias("rate_sum"),
        F.sum("rate_n").alias("rate_n"),
        F.grouping("County").alias("no_county"),
        F.grouping("Disease").alias("no_disease"),
    )

    def largest(key, present, absent):
        is_level = (F.col(present) == 0) & (F.col(absent) == 1) & F.col(key).isNotNull()
        rank = F.when(is_level, F.struct(-F.col("cases"), F.col(key)))
        return F.coalesce(F.min_by(key, rank), F.lit(NOT_AVAILABLE))

    whole = (F.col("no_county") == 1) & (F.col("no_disease") == 1)
    chosen = disease if disease and disease != ALL_DISEASES else None
    figures = levels.agg(
        F.coalesce(F.max(F.when(whole, F.col("cases"))), F.lit(0)).alias("Total_Cases"),
        F.max(
            F.when(whole, F.try_divide(F.col("rate_sum"), F.col("rate_n")))
        ).alias("Avg_Rate"),
        largest("County", "no_county", "no_disease").alias("Top_County"),
        largest("Disease", "no_disease", "no_county").alias("Top_Disease"),
    )
    return figures.withColumn("Top_Disease", F.lit(chosen)) if chosen else figures


def max_rate_order() -> Column:
    """Sorts the highest rate first, then by disease, county, year, sex; null without a rate."""
    rate = F.col("Recalculated_Rate")
    known = rate.isNotNull() & ~F.isnan(rate)
    return F.when(known, F.struct((-rate).alias("rate"), "Disease", "County", "Year", "Sex"))


def max_rate_row(df: DataFrame) -> DataFrame:
    """The whole row with the highest rate; ties by disease, county, year, sex."""
    rate = F.col("Recalculated_Rate")
    return (
        df.filter(rate.isNotNull() & ~F.isnan(rate))
        .orderBy(rate.desc(), "Disease", "County", "Year", "Sex")
        .limit(1)
    )


def disease_chart(df: DataFrame, limit: int = 10) -> DataFrame:
    return top_diseases(
        df.filter(F.col("Disease").isNotNull()), limit=limit, round_to=None
    ).toDF("Disease", "Cas_Totaux", "Taux_Moyen")


def sex_chart(df: DataFrame) -> DataFrame:
    return only_sexes(df, SEXES).groupBy("Sex").agg(F.sum("Count").alias("Count")).orderBy("Sex")


def yearly_chart(df: DataFrame) -> DataFrame:
    return yearly_trends(df.filter(F.col("Year").isNotNull()), round_to=None).toDF(
        "Year", "Cas_Totaux", "Taux_Moyen"
    )


def year_growth(df: DataFrame) -> DataFrame:
    """Growth from the first to the last year present; no row on empty input."""
    years = (
        df.filter(F.col("Year").isNotNull())
        .groupBy("Year")
        .agg(F.coalesce(F.sum("Count"), F.lit(0)).alias("cases"))
    )
    return growth_of(years)


def growth_of(years: DataFrame) -> DataFrame:
    """Growth between the ends of a table of ``Year`` and ``cases``."""
    ends = years.agg(
        F.min("Year").alias("first_year"),
        F.max("Year").alias("last_year"),
        F.min_by("cases", "Year").alias("first_cases"),
        F.max_by("cases", "Year").alias("last_cases"),
    ).filter(F.col("first_year").isNotNull())
    first, last = F.col("first_cases"), F.col("last_cases")
    growth = F.when(first > 0, (last - first) / first * 100).otherwise(F.lit(0.0))
    return ends.withColumn("growth", growth).withColumn(
        "trend", F.when(F.col("growth") > 0, F.lit("augmentation")).otherwise(F.lit("baisse"))
    )
