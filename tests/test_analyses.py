import pytest
from pyspark.sql import functions as F

from caseframe.operators import overview, rankings, selection
from caseframe.plans.analyse import analyse
from tests.conftest import rows

CELLS = "Disease string, County string, Year int, Sex string, Count int, Recalculated_Rate double"


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame(
        [
            ("A", "x", 2001, "Male", 10, 1.0),
            ("A", "x", 2001, "Female", 30, 2.0),
            ("A", "y", 2002, "Total", 40, 6.0),
            ("B", "y", 2003, "Male", 0, 9.125),
            ("B", None, 2003, "Female", 100, 3.0),
            (None, "z", None, "Male", 100, 4.0),
        ],
        CELLS,
    )


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], CELLS)


def test_top_diseases_breaks_ties_by_name(county):
    found = rows(rankings.top_diseases(county))
    assert [r[0] for r in found] == ["HIV", "TieA", "TieB", "ZeroBase", "OnlyEarly", "OnlyLate"]
    assert found[0] == ("HIV", 42, round((1000 + 0 + 0 + 0 + 2000 + 100 + 100 + 300) / 8, 2))


def test_top_diseases_options(county):
    assert len(rows(rankings.top_diseases(county, limit=2))) == 2
    males = dict(
        (r[0], r[1]) for r in rows(rankings.top_diseases(county, sexes=["Male"]))
    )
    assert males["HIV"] == 10 + 4 + 1 + 1 + 3


def test_yearly_trends_are_ordered_and_keep_a_missing_year(cells):
    found = rows(rankings.yearly_trends(cells))
    assert found == [(None, 100, 4.0), (2001, 40, 1.5), (2002, 40, 6.0), (2003, 100, 6.06)]


def test_empty_disease_name_is_no_filter(cells):
    assert rows(rankings.yearly_trends(cells, "")) == rows(rankings.yearly_trends(cells))
    assert rows(rankings.yearly_trends(cells, "B")) == [(2003, 100, 6.06)]


def test_sex_distribution_leaves_totals_out(cells):
    assert rows(rankings.sex_distribution(cells)) == [
        ("Female", 130, 2.5, 54.17),
        ("Male", 110, round((1 + 9.125 + 4) / 3, 2), 45.83),
    ]


def test_share_of_nothing_is_null(cells):
    none = cells.withColumn("Count", F.lit(0))
    assert {r[3] for r in rows(rankings.sex_distribution(none))} == {None}


def test_shares_add_up(county):
    shares = [r["Percentage"] for r in rankings.sex_distribution(county, "HIV").collect()]
    assert abs(sum(shares) - 100) <= 0.02


def test_hotspots_by_rounded_rate_then_name(spark):
    df = spark.createDataFrame(
        [("A", "b", 1, 5.001), ("A", "a", 1, 5.004), ("A", "c", 1, 7.0), ("B", "d", 1, 9.0)],
        "Disease string, County string, Count int, Recalculated_Rate double",
    )
    assert [r[0] for r in rows(rankings.county_hotspots(df, "A"))] == ["c", "a", "b"]
    assert [r[0] for r in rows(rankings.county_hotspots(df, "A", limit=1))] == ["c"]


def test_growth_defaults(county):
    growth = rankings.disease_growth(county)
    assert growth.columns[1:3] == ["Cases_2001_2005", "Cases_2010_2014"]
    assert rows(growth) == [("ZeroBase", 0, 6, 6, 600.0), ("HIV", 17, 20, 3, 17.65)]


def test_growth_equals_the_join_of_two_periods(county):
    early, late = (2001, 2004), (2003, 2011)  # overlapping on purpose

    def period(bounds, name):
        return (
            county.filter(F.col("Year").between(*bounds))
            .groupBy("Disease")
            .agg(F.sum("Count").alias(name))
        )

    joined = period(early, "e").join(period(late, "l"), "Disease")
    expected = {(r["Disease"], r["e"], r["l"]) for r in joined.collect()}
    found = {tuple(r)[:3] for r in rankings.disease_growth(county, early, late).collect()}
    assert found == expected and expected


def test_growth_drops_a_missing_disease(spark):
    df = spark.createDataFrame(
        [(None, 2001, 1), (None, 2010, 2), ("A", 2001, 1), ("A", 2010, 2)],
        "Disease string, Year int, Count int",
    )
    assert rows(rankings.disease_growth(df)) == [("A", 1, 2, 1, 100.0)]


def test_global_filter(cells):
    def n(**choice):
        return selection.apply_filters(cells, **choice).count()

    assert n() == 5  # the row without a year never passes
    assert n(disease="Toutes", sex="Tous") == 5
    assert n(disease="A") == 3
    assert n(disease="A", sex="Male") == 1
    assert n(years=(2002, 2003)) == 3
    assert n(disease="B", sex="Female", years=(2003, 2003)) == 1


def test_union_keeps_all_rows_and_all_columns(cells):
    both = selection.union_sets(cells.withColumn("Extra", F.lit(1)), cells)
    assert both.count() == 12
    assert both.filter("dataset = 'test' AND Extra IS NULL").count() == 6


def test_year_options(cells, nothing):
    assert [r[0] for r in rows(selection.year_options(cells, cells.filter("Year < 2003")))] == [
        2007, 2006, 2005, 2004, 2003, 2002, 2001,
    ]
    assert rows(selection.year_options(nothing, nothing)) == []
    assert rows(selection.future_years(cells, 1)) == [(2004,)]
    with pytest.raises(ValueError, match="ahead"):
        selection.future_years(cells, 0)


def test_value_lists(cells):
    assert rows(selection.disease_options(cells)) == [("A",), ("B",)]
    assert rows(selection.year_bounds(cells)) == [(2001, 2003)]


def test_preview_is_ordered_and_limited(county):
    found = [r["Id"] for r in selection.preview(county, 3).collect()]
    assert found == [1, 7, 2]


def test_key_figures(cells):
    total, mean, place, disease = rows(overview.key_figures(cells))[0]
    # missing county and disease count in the totals, not among the names
    assert (total, place, disease) == (280, "z", "B")
    assert abs(mean - (1 + 2 + 6 + 9.125 + 3 + 4) / 6) < 1e-12


def test_key_figures_tie_goes_to_the_first_name(cells):
    tied = cells.filter("County IN ('x', 'y')")
    assert rows(overview.key_figures(tied))[0][2:] == ("x", "A")


def test_key_figures_of_a_chosen_disease_and_of_nothing(cells, nothing):
    assert rows(overview.key_figures(cells, "Q"))[0][3] == "Q"
    assert rows(overview.key_figures(cells, "Toutes"))[0][3] == "B"
    assert rows(overview.key_figures(nothing)) == [(0, None, "N/A", "N/A")]
    assert rows(overview.key_figures(nothing, "A")) == [(0, None, "N/A", "A")]


def test_max_rate_row(cells, nothing):
    assert rows(overview.max_rate_row(cells))[0][:2] == ("B", "y")
    assert rows(overview.max_rate_row(nothing)) == []
    with_nan = cells.withColumn(
        "Recalculated_Rate",
        F.when(F.col("County") == "x", F.lit(float("nan"))).otherwise(F.col("Recalculated_Rate")),
    )
    assert rows(overview.max_rate_row(with_nan))[0][5] == 9.125


def test_charts_leave_missing_keys_out_and_do_not_round(cells):
    assert rows(overview.disease_chart(cells)) == [("B", 100, 6.0625), ("A", 80, 3.0)]
    assert rows(overview.disease_chart(cells, limit=1)) == [("B", 100, 6.0625)]
    assert rows(overview.sex_chart(cells)) == [("Female", 130), ("Male", 110)]
    assert rows(overview.yearly_chart(cells)) == [
        (2001, 40, 1.5),
        (2002, 40, 6.0),
        (2003, 100, 6.0625),
    ]


def test_year_growth(cells, nothing):
    assert rows(overview.year_growth(cells)) == [(2001, 2003, 40, 100, 150.0, "augmentation")]
    falling = cells.filter("Disease = 'A' AND (Year = 2001 OR Sex = 'none')")
    assert rows(overview.year_growth(falling)) == [(2001, 2001, 40, 40, 0.0, "baisse")]
    from_zero = cells.filter("Disease = 'B' OR Sex = 'Total'").withColumn(
        "Count", F.when(F.col("Year") == 2002, 0).otherwise(F.col("Count"))
    )
    assert rows(overview.year_growth(from_zero))[0][4:] == (0.0, "baisse")
    assert rows(overview.year_growth(nothing)) == []


def test_standing_analyses(county):
    results = analyse(county, sex_of="HIV", hotspots_of="HIV")
    assert {name: df.count() for name, df in results.items()} == {
        "top_diseases": 6,
        "sex_distribution": 2,
        "county_hotspots": 4,
        "disease_growth": 2,
    }
