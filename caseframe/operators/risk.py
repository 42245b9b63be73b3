"""Priority bands, county risk and intervention lists."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseframe.functions import clamp_rate, priority
from caseframe.operators.selection import only_disease
from caseframe.schema import HIGH, LOW, MEDIUM, PREDICTIONS

PER_SCREEN = ("Disease", "Year")


def band_predictions(df: DataFrame, col: str = "prediction") -> DataFrame:
    """Adds the cleaned prediction and its band, which is taken after rounding."""
    return df.withColumn("Predicted_Rate", clamp_rate(F.col(col))).withColumn(
        "Priority_Level", priority(F.col("Predicted_Rate"))
    )


def prediction_columns(df: DataFrame) -> DataFrame:
    return df.select(*PREDICTIONS.names)


def predictions_for(
    stored: DataFrame,
    forecast: DataFrame | None = None,
    disease: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """Stored predictions, and the forecast for the years that have none stored.

    The anti join works on the distinct stored years; Spark decides by their
    size at run time whether to broadcast them. Without a forecast this is the
    plain lookup.
    """

    def chosen(df):
        rows = only_disease(df, disease)
        return rows if year is None else rows.filter(F.col("Year") == year)

    if forecast is None:
        return chosen(stored)
    stored_years = stored.select("Year")
    if year is not None:
        stored_years = stored_years.filter(F.col("Year") == year)
    return chosen(stored).unionByName(
        chosen(forecast).join(stored_years.distinct(), "Year", "left_anti"),
        allowMissingColumns=True,
    )


def county_risk(
    predictions: DataFrame, by: Sequence[str] = PER_SCREEN, ordered: bool = True
) -> DataFrame:
    """Mean prediction of each county and the band of that mean, highest first.

    Observed rate and cases are filled where the predictions carry them, and
    are null and 0 otherwise (forecasts have neither).
    """
    observed = (
        F.avg("Recalculated_Rate")
        if "Recalculated_Rate" in predictions.columns
        else F.lit(None).cast("double")
    )
    cases = F.sum("Count") if "Count" in predictions.columns else F.lit(0).cast("bigint")
    risk = (
        predictions.filter(F.col("County").isNotNull())
        .groupBy(*by, "County")
        .agg(
            F.avg("Predicted_Rate").alias("Predicted_Rate"),
            F.avg("Population").alias("Population"),
            observed.alias("Observed_Rate"),
            F.coalesce(cases, F.lit(0)).alias("Cases"),
        )
        .withColumn("Priority_Level", priority(F.col("Predicted_Rate")))
    )
    return risk.orderBy(*by, F.desc("Predicted_Rate"), "County") if ordered else risk


def risk_ranking(risk: DataFrame, by: Sequence[str] = PER_SCREEN) -> DataFrame:
    return risk.select(*by, "County", "Observed_Rate", "Predicted_Rate", "Priority_Level")


def priority_counts(risk: DataFrame, by: Sequence[str] = PER_SCREEN) -> DataFrame:
    """Counties per band; 0 where a band is empty."""
    level = F.col("Priority_Level")
    return risk.groupBy(*by).agg(
        F.count_if(level == HIGH).alias("n_high"),
        F.count_if(level == MEDIUM).alias("n_medium"),
        F.count_if(level == LOW).alias("n_low"),
    )


def recommendations(
    risk: DataFrame,
    n_high: int = 5,
    n_medium: int = 3,
    by: Sequence[str] = PER_SCREEN,
) -> DataFrame:
    """The counties to act on: the worst high ones, else the worst medium ones.

    Where neither band has a county, one row without a county says so. Counties
    without a band are left out.

    Within a band the rank filter is cut off before the shuffle already, so a
    group sends a handful of rows per task. The survivors hold at least one row
    of each band present, so the worst band is read off them.
    """
    if min(n_high, n_medium) < 1:
        raise ValueError("each band must be allowed at least one county")
    keep = F.create_map(
        F.lit(HIGH), F.lit(n_high), F.lit(MEDIUM), F.lit(n_medium), F.lit(LOW), F.lit(1)
    )
    severity = F.when(F.col("Priority_Level") == HIGH, 2).when(
        F.col("Priority_Level") == MEDIUM, 1
    ).otherwise(0)
    in_band = Window.partitionBy(*by, "Priority_Level").orderBy(
        F.desc("Predicted_Rate"), "County"
    )
    leading = (
        risk.select(*by, "County", "Predicted_Rate", "Priority_Level")
        .filter(F.col("Priority_Level").isNotNull())
        .withColumn("Rank", F.row_number().over(in_band))
        .filter(F.col("Rank") <= max(n_high, n_medium))
        .filter(F.col("Rank") <= F.element_at(keep, F.col("Priority_Level")))
        .withColumn("severity", severity)
    )
    worst = F.max("severity").over(Window.partitionBy(*by))
    rows = leading.withColumn("worst", worst).filter(F.col("severity") == F.col("worst"))
    at_risk = F.col("severity") > 0
    shown = {
        name: F.when(at_risk, F.col(name))
        for name in ("County", "Predicted_Rate", "Priority_Level", "Rank")
    }
    action = (
        F.when(F.col("severity") == 2, F.lit("critical"))
        .when(F.col("severity") == 1, F.lit("reinforced"))
        .otherwise(F.lit("none"))
    )
    return rows.select(
        *by, *(col.alias(name) for name, col in shown.items()), action.alias("action")
    ).orderBy(*by, "Rank")
