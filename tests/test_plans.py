"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from caseframe.operators import overview, rankings, risk
from caseframe.operators.cleaning import split_county_state
from caseframe.operators.forecast import forecast_grid
from caseframe.operators.places import county_centres, map_layer
from caseframe.schema import HIGH
from checks import queries, tables
from tests.conftest import TESTDATA, optimized, plan

SMALL = f"{TESTDATA}/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython")
TRAINED = {"rf_predictions", "rf_metrics", "model_round_trip", "forecast_scores"}


@pytest.fixture(scope="module")
def stored(spark, cleaned, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "clean")
    cleaned.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - TRAINED))
def test_no_pairing_joins_and_no_python_rows(spark, name):
    text = plan(queries.QUERIES[name](spark, SMALL))
    assert not [word for word in FORBIDDEN if word in text]


def test_county_half_drops_the_state_branch(spark):
    df = tables.county_rows(spark, SMALL)
    assert "Union" not in optimized(df)
    assert plan(df).count("FileScan") == 6
    assert plan(df).count("FileScan parquet [l_") == 1


def test_scans_read_only_the_columns_in_use(spark):
    text = plan(queries.QUERIES["top_diseases"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert "l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string" in schemas


def test_growth_is_one_scan_with_the_years_pushed_down(stored):
    text = plan(rankings.disease_growth(stored))
    assert text.count("FileScan") == 1
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text)
    assert "GreaterThanOrEqual(Year,2001)" in pushed[1]
    assert pushed[2] == "Disease:string,Year:int,Count:bigint"


def test_key_figures_are_one_scan(stored):
    assert plan(overview.key_figures(stored)).count("FileScan") == 1


def test_limits_are_taken_per_task_first(stored):
    for df in (
        rankings.top_diseases(stored),
        rankings.county_hotspots(stored, "HIV"),
        overview.max_rate_row(stored),
    ):
        assert "TakeOrderedAndProject" in plan(df)


def test_groupings_are_partial_before_the_shuffle(stored):
    text = plan(rankings.yearly_trends(stored))
    assert "partial_sum" in text.split("Exchange hashpartitioning")[1]


def test_equality_reaches_the_scan(stored):
    assert "EqualTo(Disease,HIV)" in plan(rankings.county_hotspots(stored, "HIV"))
    assert "EqualTo(County,California)" in plan(split_county_state(stored)[1])


def test_map_reads_its_input_once(spark, stored):
    layer = map_layer(stored, county_centres(spark))
    layer.collect()
    text = plan(layer)
    assert "BroadcastHashJoin" in text
    assert len(set(re.findall(r"Scan parquet", text.split("Initial Plan")[0]))) == 1


def test_registered_map_scans_the_line_items_once(spark):
    text = plan(queries.QUERIES["map_layer"](spark, f"{TESTDATA}/sf0.001"))
    assert text.count("l_orderkey#") and len(re.findall(r"FileScan parquet \[l_", text)) == 1


def test_grid_needs_no_join(stored):
    for disease in (None, "HIV"):
        assert "Join" not in optimized(forecast_grid(stored, disease, [2020, 2021]))


def test_rank_is_cut_before_the_shuffle(stored):
    banded = stored.withColumns({"Predicted_Rate": F.col("Rate"), "Priority_Level": F.lit(HIGH)})
    text = plan(risk.recommendations(risk.county_risk(banded, ordered=False)))
    assert "WindowGroupLimit" in text


def test_a_hot_join_key_is_split(spark, tmp_path):
    """A third of the line items on one part and one order: the joins must split them."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    folder = str(tmp_path)
    number = F.col("id")
    hot = number % 3 == 0
    spark.range(0, 300_000, 1, 8).select(
        F.when(hot, 7).otherwise(number % 20_000).alias("l_orderkey"),
        F.when(hot, 7).otherwise(number % 5_000).alias("l_partkey"),
        F.lit(1).alias("l_linenumber"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("l_quantity"),
        F.lit(1.0).alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "ANR")), (number % 3 + 1).cast("int")).alias("l_returnflag"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(5_000).select(
        number.alias("p_partkey"),
        F.concat(F.lit("Brand#"), number % 25 + 1).alias("p_brand"),
        F.lit(1).alias("p_size"),
    ).write.parquet(f"{folder}/part.parquet")
    spark.range(20_000).select(
        number.alias("o_orderkey"),
        (number % 1_000).alias("o_custkey"),
        F.lit("1998-01-01").cast("timestamp_ntz").alias("o_orderdate"),
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(1_000).select(
        number.alias("c_custkey"), (number % 25).cast("int").alias("c_nationkey")
    ).write.parquet(f"{folder}/customer.parquet")
    spark.range(25).select(
        number.cast("int").alias("n_nationkey"),
        F.concat(F.lit("NATION_"), number).alias("n_name"),
    ).write.parquet(f"{folder}/nation.parquet")
    expected = spark.read.parquet(f"{folder}/lineitem.parquet").agg(F.sum("l_quantity"))
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = tables.county_rows(spark, folder)
        total = sum(row["Count"] for row in df.collect())
        text = plan(df).split("Initial Plan")[0]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert total == expected.collect()[0][0]
    assert text.count("SortMergeJoin(skew=true)") >= 2
