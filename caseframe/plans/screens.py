"""The data behind each screen of the dashboard, for one choice of filters.

The screens over the fact rows share one summary, which reads these once; only
the preview reads rows again, of the diseases that come first. ``screens`` gives
all of them; the functions for a single one take a summary that is there already.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.operators.forecast import fit_forecast_model, forecast, forecast_grid
from caseframe.operators.places import county_centres
from caseframe.operators.risk import (
    PER_SCREEN,
    county_risk,
    predictions_for,
    priority_counts,
    recommendations,
    risk_ranking,
)
from caseframe.operators.selection import apply_filters, union_sets
from caseframe.operators.summary import Summary
from caseframe.schema import ALL_DISEASES
from caseframe.sources import materialise

Frames = dict[str, DataFrame]


def summary_of(
    df: DataFrame,
    disease: str | None = None,
    sex: str | None = None,
    years: tuple[int, int] | None = None,
) -> Summary:
    return Summary.of(apply_filters(df, disease, sex, years))


def overview(
    df: DataFrame, disease=None, sex=None, years=None, summary: Summary | None = None
) -> Frames:
    told = summary or summary_of(df, disease, sex, years)
    return {
        "key_figures": told.key_figures(disease),
        "max_rate_row": told.max_rate_row(),
        "disease_chart": told.disease_chart(),
        "sex_chart": told.sex_chart(),
        "preview": told.preview(),
    }


def trends(
    df: DataFrame, disease=None, sex=None, years=None, summary: Summary | None = None
) -> Frames:
    told = summary or summary_of(df, disease, sex, years)
    return {"yearly_chart": told.yearly_chart(), "year_growth": told.year_growth()}


def county_map(
    df: DataFrame,
    disease=None,
    sex=None,
    years=None,
    coordinates: DataFrame | None = None,
    summary: Summary | None = None,
) -> DataFrame:
    told = summary or summary_of(df, disease, sex, years)
    return told.map_layer(county_centres(df.sparkSession) if coordinates is None else coordinates)


def screens(
    df: DataFrame, disease=None, sex=None, years=None, coordinates: DataFrame | None = None
) -> Frames:
    """Overview, trends and map for one choice of filters, from one summary."""
    told = summary_of(df, disease, sex, years)
    return {
        **overview(df, disease, summary=told),
        **trends(df, summary=told),
        "map_layer": county_map(df, coordinates=coordinates, summary=told),
    }


def interventions(
    train: DataFrame,
    test: DataFrame,
    stored: DataFrame,
    disease: str,
    year: int,
    model=None,
) -> Frames:
    """Risk tables of one disease and year, from stored or forecast rates.

    A model is only needed, and only fitted if none is given, when no
    prediction is stored for the year; one row is looked at to find out.
    """
    if disease == ALL_DISEASES:
        raise ValueError("the risk screen needs one disease")
    if stored.filter(F.col("Year") == year).isEmpty():
        history = union_sets(train, test)
        fitted = fit_forecast_model(history) if model is None else model
        rows = forecast(fitted, forecast_grid(history, disease, year))
    else:
        rows = predictions_for(stored, None, disease, year)
    # One row per county, which all four tables are taken from.
    risk = materialise(county_risk(rows, ordered=False))
    listed = risk.orderBy(*PER_SCREEN, F.desc("Predicted_Rate"), "County")
    return {
        "county_risk": listed,
        "ranking": risk_ranking(listed),
        "priority_counts": priority_counts(risk),
        "recommendations": recommendations(risk),
    }
