"""The screens' summary against the operators over rows, its merging, and what is scanned."""

import pytest
from pyspark.sql import functions as F

from caseframe.operators import overview
from caseframe.operators.places import county_centres, map_layer
from caseframe.operators.selection import preview
from caseframe.operators.summary import KEYS, Summary, merged, summarise
from caseframe.plans.screens import county_map, interventions, screens, trends
from caseframe.plans.screens import overview as overview_screen
from caseframe.sources import materialise
from tests.conftest import plan


def values(df):
    rounded = [
        F.round(name, 6).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes
    ]
    rows = df.select(*rounded).collect()
    return [tuple("nan" if value != value else value for value in row) for row in rows]


@pytest.fixture(scope="module")
def facts(spark, county):
    """The small table, with rows whose keys or numbers are missing."""
    gaps = spark.createDataFrame(
        [
            (None, "Kern", 2001, "Male", 5, 10, 1.0),
            ("HIV", None, 2002, "Female", None, None, None),
            ("HIV", "Kern", None, None, 7, 0, float("nan")),
        ],
        "Disease string, County string, Year int, Sex string, Count long, Population long, Recalculated_Rate double",
    )
    return materialise(county.unionByName(gaps, allowMissingColumns=True))


@pytest.mark.parametrize("where", ["true", "Disease = 'HIV'", "Year > 2005", "false"])
def test_all_that_the_screens_show_equals_the_operators_over_rows(spark, facts, where):
    rows = facts.filter(where).filter("NOT isnan(coalesce(Recalculated_Rate, 0))")
    told, centres = Summary.of(rows), county_centres(spark)
    pairs = {
        "figures": (told.key_figures(), overview.key_figures(rows)),
        "chosen": (told.key_figures("HIV"), overview.key_figures(rows, "HIV")),
        "highest": (told.max_rate_row(), overview.max_rate_row(rows)),
        "diseases": (told.disease_chart(3), overview.disease_chart(rows, 3)),
        "sexes": (told.sex_chart(), overview.sex_chart(rows)),
        "years": (told.yearly_chart(), overview.yearly_chart(rows)),
        "growth": (told.year_growth(), overview.year_growth(rows)),
        "preview": (told.preview(5), preview(rows, 5)),
        "all rows": (told.preview(1000), preview(rows, 1000)),
    }
    for name, (found, expected) in pairs.items():
        assert found.columns == expected.columns and found.dtypes == expected.dtypes, name
        assert values(found) == values(expected), name
    drawn = told.map_layer(centres), map_layer(rows, centres)
    assert sorted(values(drawn[0]), key=str) == sorted(values(drawn[1]), key=str)


def test_a_rate_that_is_no_number_is_not_the_highest(facts):
    assert values(Summary.of(facts).max_rate_row().select("Recalculated_Rate")) == [(2000.0,)]


def test_summaries_add_up(facts):
    one, other = facts.filter("Year < 2005"), facts.filter("Year >= 2005 OR Year IS NULL")
    assert sorted(values(merged(summarise(one), summarise(other))), key=str) == sorted(
        values(summarise(facts)), key=str
    )
    both = Summary.of(one).merged_with(Summary.of(other))
    whole = Summary.of(facts)
    for name in ("key_figures", "max_rate_row", "disease_chart", "year_growth", "preview"):
        assert values(getattr(both, name)()) == values(getattr(whole, name)()), name


def test_a_missing_key_has_a_row_of_its_own(facts):
    table = {tuple(row)[:5]: row["n_rows"] for row in summarise(facts).collect()}
    assert table["All", None, None, None, None] == 17
    assert table["Disease", None, None, None, None] == 1
    assert table["County", None, None, None, None] == 1
    assert table["Sex", None, None, None, None] == 1 and len(KEYS) == 4


def counted(spark, df):
    """The table, and an accumulator of how many of its rows were read."""
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(read, df.schema), seen


def test_the_screens_read_the_rows_once_and_the_preview_once_more(spark, facts):
    rows, seen = counted(spark, facts.filter("Year IS NOT NULL"))
    n = facts.filter("Year IS NOT NULL").count()
    shown = screens(rows)
    assert seen.value == n
    assert set(shown) == {
        "key_figures", "max_rate_row", "disease_chart", "sex_chart", "preview", "yearly_chart",
        "year_growth", "map_layer",
    }
    for name, frame in shown.items():
        if name != "preview":
            frame.collect()
    assert seen.value == n
    shown["preview"].collect()
    assert seen.value == 2 * n


def test_a_single_screen_takes_a_given_summary(spark, facts):
    rows, seen = counted(spark, facts)
    told = Summary.of(rows)
    before = seen.value
    overview_screen(rows, summary=told)["key_figures"].collect()
    trends(rows, summary=told)["yearly_chart"].collect()
    county_map(rows, summary=told).collect()
    assert seen.value == before == facts.count()


def test_the_preview_reads_the_first_diseases_only(spark, tmp_path):
    df = spark.range(1000).select(
        F.concat(F.lit("D"), F.format_string("%02d", F.col("id") % 20)).alias("Disease"),
        F.lit("Kern").alias("County"), F.lit(2001).alias("Year"), F.lit("Male").alias("Sex"),
        F.lit(1).cast("long").alias("Count"), F.lit(10).cast("long").alias("Population"),
        F.lit(1.0).alias("Recalculated_Rate"), F.col("id").alias("Id"),
    )
    df.write.parquet(str(tmp_path / "t"))
    shown = Summary.of(spark.read.parquet(str(tmp_path / "t"))).preview(60)
    assert "LessThanOrEqual(Disease,D01)" in plan(shown)
    assert {r["Disease"] for r in shown.collect()} == {"D00", "D01"} and shown.count() == 60


def test_risk_is_put_together_once(spark, facts):
    stored = facts.withColumn("Predicted_Rate", F.col("Recalculated_Rate"))
    rows, seen = counted(spark, stored)
    shown = interventions(facts, facts, rows, "HIV", 2001)
    before = seen.value
    for frame in shown.values():
        frame.collect()
    assert seen.value == before
