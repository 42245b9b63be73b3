import pytest
from pyspark.sql import functions as F

from caseframe.operators import risk
from caseframe.operators.places import COUNTY_CENTRES, county_centres, map_layer
from caseframe.schema import HIGH, LOW, MEDIUM
from tests.conftest import rows

MAP = "County string, Count int, Recalculated_Rate double, Population int"


def test_centres(spark):
    assert len(COUNTY_CENTRES) == len({name for name, *_ in COUNTY_CENTRES}) == 58
    table = county_centres(spark)
    assert rows(table) == COUNTY_CENTRES
    assert table.dtypes == [("County", "string"), ("latitude", "double"), ("longitude", "double")]


def test_map_layer(spark):
    df = spark.createDataFrame(
        [
            ("Kern", 1, 10.0, 100),
            ("Kern", 2, 30.0, 300),
            ("Lake", 5, 15.0, 50),
            ("Yuba", 5, 3.0, None),
            ("Nowhere", 9, 99.0, 1),
            (None, 9, 99.0, 1),
        ],
        MAP,
    )
    found = {r["County"]: r.asDict() for r in map_layer(df, county_centres(spark)).collect()}
    assert set(found) == {"Kern", "Lake", "Yuba"}
    assert found["Kern"] == {
        "County": "Kern",
        "Total_Count": 3,
        "Mean_Rate": 20.0,
        "Population": 200.0,
        "latitude": 35.34,
        "longitude": -118.96,
        "height": 35000.0,
        "color": [255, 0, 50, 180],
    }
    assert found["Lake"]["height"] == 27500.0
    assert found["Lake"]["color"] == [255, 127, 50, 180]
    assert found["Yuba"]["color"] == [76, 255, 50, 180]


def test_map_without_any_rate(spark):
    df = spark.createDataFrame([("Kern", 0, 0.0, 1)], MAP)
    (point,) = map_layer(df, county_centres(spark)).collect()
    assert (point["height"], point["color"]) == (5000.0, [0, 255, 50, 180])
    gap = spark.createDataFrame([("Kern", 0, None, 1), ("Lake", 0, 2.0, 1)], MAP)
    found = {r["County"]: r for r in map_layer(gap, county_centres(spark)).collect()}
    assert found["Kern"]["color"] is None and found["Lake"]["color"] == [255, 0, 50, 180]


def test_coordinates_of_the_caller(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 1), ("b", 1, 1.0, 1)], MAP)
    places = spark.createDataFrame(
        [("a", 1.0, 2.0), ("b", None, 2.0)],
        "County string, latitude double, longitude double",
    )
    assert [r["County"] for r in map_layer(df, places).collect()] == ["a"]


@pytest.mark.parametrize(
    ("prediction", "rate", "level"),
    [
        (-1.0, 0.0, LOW),
        (5.0, 5.0, LOW),
        (5.004, 5.0, LOW),
        (5.01, 5.01, MEDIUM),
        (50.0, 50.0, MEDIUM),
        (50.004, 50.0, MEDIUM),
        (50.01, 50.01, HIGH),
        (None, None, None),
    ],
)
def test_bands(spark, prediction, rate, level):
    df = spark.createDataFrame([(prediction,)], "prediction double")
    assert rows(risk.band_predictions(df)) == [(prediction, rate, level)]


def test_nan_lands_in_the_top_band(spark):
    df = spark.createDataFrame([(float("nan"),)], "prediction double")
    assert risk.band_predictions(df).collect()[0]["Priority_Level"] == HIGH


STORED = (
    "Disease string, County string, Year int, Population int, Count int,"
    " Recalculated_Rate double, Predicted_Rate double"
)


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame(
        [
            ("A", "x", 2001, 10, 1, 1.0, 4.0),
            ("A", "x", 2001, 30, 2, 3.0, 8.0),
            ("A", "y", 2001, 10, 3, 1.0, 60.0),
            ("A", None, 2001, 10, 3, 1.0, 99.0),
            ("B", "x", 2001, 10, 1, 1.0, 1.0),
        ],
        STORED,
    )


@pytest.fixture(scope="module")
def future(spark):
    return spark.createDataFrame(
        [("A", "x", 2001, 5.0, 7.0), ("A", "x", 2002, 5.0, 7.0), ("B", "x", 2002, 5.0, 9.0)],
        "Disease string, County string, Year int, Population double, Predicted_Rate double",
    )


def test_county_risk_bands_the_mean(stored):
    assert rows(risk.county_risk(stored)) == [
        ("A", 2001, "y", 60.0, 10.0, 1.0, 3, HIGH),
        ("A", 2001, "x", 6.0, 20.0, 2.0, 3, MEDIUM),
        ("B", 2001, "x", 1.0, 10.0, 1.0, 1, LOW),
    ]


def test_county_risk_of_a_forecast(future):
    assert rows(risk.county_risk(future.filter("Year = 2002 AND Disease = 'A'"))) == [
        ("A", 2002, "x", 7.0, 5.0, None, 0, MEDIUM)
    ]


def test_ranking_columns(stored):
    assert risk.risk_ranking(risk.county_risk(stored)).columns == [
        "Disease", "Year", "County", "Observed_Rate", "Predicted_Rate", "Priority_Level",
    ]


def test_stored_years_come_first(stored, future):
    def keys(**choice):
        found = risk.predictions_for(stored, future, **choice)
        return sorted((r["Disease"], r["Year"], r["Predicted_Rate"]) for r in found.collect())

    assert len(keys()) == 5 + 2
    assert keys(disease="A", year=2001) == [
        ("A", 2001, 4.0), ("A", 2001, 8.0), ("A", 2001, 60.0), ("A", 2001, 99.0),
    ]
    assert keys(disease="A", year=2002) == [("A", 2002, 7.0)]
    # a year stored for some disease is not forecast for the others
    assert keys(disease="C", year=2001) == []


def test_lookup_without_forecast(stored):
    assert risk.predictions_for(stored, disease="B", year=2001).count() == 1


def test_priority_counts(stored):
    counts = rows(risk.priority_counts(risk.county_risk(stored)).orderBy("Disease"))
    assert counts == [("A", 2001, 1, 1, 0), ("B", 2001, 0, 0, 1)]


def risk_rows(spark, *cells):
    return spark.createDataFrame(
        [("A", year, county, rate, level) for year, county, rate, level in cells],
        "Disease string, Year int, County string, Predicted_Rate double, Priority_Level string",
    )


def test_recommendations(spark):
    many = [(1, f"h{i}", 100.0 + i, HIGH) for i in range(7)] + [(1, "m", 9.0, MEDIUM)]
    some = [(2, f"m{i}", 10.0, MEDIUM) for i in range(4)] + [(2, "l", 1.0, LOW)]
    calm = [(3, "l1", 1.0, LOW), (3, "l2", 2.0, LOW)]
    unknown = [(4, "u", None, None)]
    found = rows(risk.recommendations(risk_rows(spark, *many, *some, *calm, *unknown)))
    assert [r[1:] for r in found] == [
        (1, "h6", 106.0, HIGH, 1, "critical"),
        (1, "h5", 105.0, HIGH, 2, "critical"),
        (1, "h4", 104.0, HIGH, 3, "critical"),
        (1, "h3", 103.0, HIGH, 4, "critical"),
        (1, "h2", 102.0, HIGH, 5, "critical"),
        (2, "m0", 10.0, MEDIUM, 1, "reinforced"),
        (2, "m1", 10.0, MEDIUM, 2, "reinforced"),
        (2, "m2", 10.0, MEDIUM, 3, "reinforced"),
        (3, None, None, None, None, "none"),
    ]


def test_recommendation_sizes(spark):
    cells = [(1, f"h{i}", 100.0 + i, HIGH) for i in range(7)]
    assert risk.recommendations(risk_rows(spark, *cells), n_high=2).count() == 2
    cells = [(1, f"m{i}", 10.0 + i, MEDIUM) for i in range(9)]
    found = risk.recommendations(risk_rows(spark, *cells), n_high=2, n_medium=8)
    assert found.count() == 8
    assert found.filter(F.col("County") == "m8").count() == 1
    with pytest.raises(ValueError, match="at least one"):
        risk.recommendations(risk_rows(spark, *cells), n_high=0)
