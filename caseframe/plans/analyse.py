"""The four standing analyses over the cleaned training rows."""

from pyspark.sql import DataFrame

from caseframe.operators.rankings import (
    county_hotspots,
    disease_growth,
    sex_distribution,
    top_diseases,
)


def analyse(
    df: DataFrame,
    sex_of: str = "HIV",
    hotspots_of: str = "Chlamydia",
    early: tuple[int, int] = (2001, 2005),
    late: tuple[int, int] = (2010, 2014),
) -> dict[str, DataFrame]:
    return {
        "top_diseases": top_diseases(df, 10),
        "sex_distribution": sex_distribution(df, sex_of),
        "county_hotspots": county_hotspots(df, hotspots_of, 5),
        "disease_growth": disease_growth(df, early, late).limit(10),
    }
