import math

import pytest
from pyspark.sql import functions as F

from caseframe.operators.cleaning import (
    clean,
    row_report,
    split_county_state,
    with_prevalence,
)
from caseframe.schema import CLEAN, LOW
from caseframe.sources import load_uncleaned, load_uncleaned_predictions, read_raw
from tests.conftest import rows

RATES = [
    1000.0, 0.0, 0.0, 0.0, 1000.0, 7000.0, 2000.0, 500.0,
    500.0, 0.0, 600.0, 800.0, 800.0, 100.0, 100.0, 300.0,
]


def by_id(df):
    return {row["Id"]: row for row in df.collect()}


def test_raw_is_all_text_by_header_name(raw):
    assert raw.columns[0] == "_c0"
    assert set(dict(raw.dtypes).values()) == {"string"}


def test_clean_types_and_order(cleaned):
    assert [(f.name, f.dataType) for f in cleaned.schema] == [
        (f.name, f.dataType) for f in CLEAN
    ]


def test_recomputed_rates(cleaned):
    found = by_id(cleaned)
    assert [found[i]["Recalculated_Rate"] for i in range(1, 17)] == RATES


def test_bad_tokens_are_filled_and_population_is_not(cleaned):
    found = by_id(cleaned)
    assert found[4]["Count"] == 0
    assert (found[4]["Rate"], found[4]["CI_lower"], found[4]["CI_upper"]) == (0.0, 0.0, 0.0)
    assert found[16]["CI_lower"] == 0.0
    assert found[3]["Population"] is None


def test_fraction_text_is_cut(cleaned):
    assert (by_id(cleaned)[16]["Count"], by_id(cleaned)[16]["Population"]) == (3, 1000)


def test_ids_are_generated_without_an_index_column(raw):
    ids = [row["Id"] for row in clean(raw.drop("_c0")).collect()]
    assert len(set(ids)) == 16


def test_further_columns_pass_through(raw):
    assert clean(raw.withColumn("Source", F.lit("x"))).select("Source").distinct().count() == 1


def test_rate_is_rounded_half_up_in_decimal_form(spark):
    # 9 in 200 million is 0.0045, which binary rounding would take down; the
    # double of 143 in 64,000 is 223.43749999999997 and not a tie.
    df = spark.createDataFrame(
        [(9, 200_000_000), (143, 64_000), (1, 3), (0, 5)], "Count int, Population int"
    )
    found = [r["Recalculated_Rate"] for r in with_prevalence(df).collect()]
    assert found == [0.005, 223.437, 33333.333, 0.0]


def test_split(cleaned):
    county, state = split_county_state(cleaned)
    assert county.count() == 14
    assert [row["Id"] for row in state.collect()] == [5]


def test_split_is_case_sensitive(spark):
    df = spark.createDataFrame([("california",), ("California",), (None,)], "County string")
    county, state = split_county_state(df)
    assert (rows(county), rows(state)) == ([("california",)], [("California",)])


def test_row_report_covers_all_rows(cleaned):
    report = dict(rows(row_report(cleaned)))
    assert report == {"county": 14, "state": 1, "unassigned": 1}


def test_row_report_by_data_set(cleaned):
    both = cleaned.withColumn("dataset", F.when(F.col("Year") < 2005, "train").otherwise("test"))
    assert sum(row["n_rows"] for row in row_report(both).collect()) == 16


def test_uncleaned_keeps_missing_county_and_missing_numbers(raw):
    found = {row["_c0"]: row for row in load_uncleaned(raw).collect()}
    assert "5" not in found and "6" in found and len(found) == 15
    assert found["4"]["Count"] is None and found["4"]["Rate"] is None
    assert found["4"]["CI_upper"] is None and found["16"]["CI_lower"] is None
    assert found["1"]["Recalculated_Rate"] == found["1"]["Rate"] == 1.0


def test_uncleaned_predictions(raw):
    predicted = load_uncleaned_predictions(load_uncleaned(raw))
    assert predicted.filter(F.col("Priority_Level") != LOW).count() == 0
    assert predicted.filter(~F.col("Predicted_Rate").eqNullSafe(F.col("Rate"))).count() == 0


def test_missing_file_and_missing_column_are_told(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        read_raw(spark, str(tmp_path / "nowhere.csv"))
    path = tmp_path / "short.csv"
    path.write_text("Disease,County\nHIV,Kern\n")
    with pytest.raises(ValueError, match="Year, Sex, Count"):
        read_raw(spark, str(path))


def test_no_value_of_the_cleaned_table_is_nan(cleaned):
    for row in cleaned.collect():
        assert not any(isinstance(v, float) and math.isnan(v) for v in row)


def test_same_rows_without_ansi_mode(spark, raw, cleaned):
    expected = sorted(rows(cleaned), key=str)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert sorted(rows(clean(raw)), key=str) == expected
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def _one_raw(spark, index, count, population):
    values = (index, "HIV", "Kern", "2001", "Male", count, population, "1", "0", "2")
    names = ["_c0", "Disease", "County", "Year", "Sex", "Count", "Population", "Rate"]
    schema = ", ".join(f"`{name}` string" for name in [*names, "CI.lower", "CI.upper"])
    return clean(spark.createDataFrame([values], schema))


def test_numbers_beyond_32_bits_and_decimal_index_values_are_kept(spark):
    (row,) = _one_raw(spark, "12.0", "3000000000", "6000000000").collect()
    assert (row["Id"], row["Count"], row["Population"]) == (12, 3_000_000_000, 6_000_000_000)
    assert row["Recalculated_Rate"] == 50_000.0
    (row,) = _one_raw(spark, None, "1" + "0" * 25, "1").collect()
    assert (row["Id"], row["Count"]) == (None, None)


def test_index_that_is_no_whole_number_is_refused(spark):
    for index in ("x7", "1.5"):
        with pytest.raises(Exception, match="no whole number"):
            _one_raw(spark, index, "1", "1").collect()
