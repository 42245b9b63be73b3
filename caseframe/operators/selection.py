"""Filters, set operations and the value lists behind the selection boxes."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseframe.schema import ALL_DISEASES, ALL_SEXES


def only_disease(df: DataFrame, disease: str | None) -> DataFrame:
    """All rows when no disease (or an empty name) is given."""
    return df.filter(F.col("Disease") == disease) if disease else df


def only_sexes(df: DataFrame, sexes: Sequence[str] | None) -> DataFrame:
    return df.filter(F.col("Sex").isin(*sexes)) if sexes else df


def apply_filters(
    df: DataFrame,
    disease: str | None = None,
    sex: str | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Disease, sex and inclusive year range, all of them.

    The year range is always in force; without one it spans all known years,
    so a row without a year never passes.
    """
    year = F.col("Year")
    chosen = only_disease(df, None if disease == ALL_DISEASES else disease)
    chosen = only_sexes(chosen, None if sex in (None, ALL_SEXES) else (sex,))
    return chosen.filter(year.isNotNull() if years is None else year.between(*years))


def union_sets(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both sets by column name; ``dataset`` tells them apart (ids may repeat)."""
    return train.withColumn("dataset", F.lit("train")).unionByName(
        test.withColumn("dataset", F.lit("test")), allowMissingColumns=True
    )


def year_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("Year").alias("min_year"), F.max("Year").alias("max_year"))


def disease_options(df: DataFrame) -> DataFrame:
    return (
        df.select("Disease").filter(F.col("Disease").isNotNull()).distinct().orderBy("Disease")
    )


def years_after(last: Column, ahead: int) -> Column:
    if ahead < 1:
        raise ValueError("ahead must be at least 1")
    return F.sequence(last + 1, last + ahead)


def future_years(train: DataFrame, ahead: int = 5) -> DataFrame:
    """The ``ahead`` years after the last year of ``train``, one row each."""
    last = train.agg(F.max("Year").alias("last"))
    return last.select(F.explode(years_after(F.col("last"), ahead)).alias("Year"))


def year_options(predictions: DataFrame, train: DataFrame, ahead: int = 5) -> DataFrame:
    """Years with stored predictions and the years to come, latest first."""
    stored = predictions.select("Year").filter(F.col("Year").isNotNull())
    return stored.union(future_years(train, ahead)).distinct().orderBy(F.desc("Year"))


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    order = [c for c in ("Disease", "County", "Year", "Sex", "Id") if c in df.columns]
    return df.orderBy(*order).limit(n)
