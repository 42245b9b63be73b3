from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from caseframe.__main__ import main
from caseframe.operators.cleaning import clean, split_county_state
from caseframe.plans.load import load_tables
from caseframe.plans.preprocess import preprocess
from caseframe.plans.screens import county_map, interventions, overview, trends
from caseframe.plans.train import train_and_score
from caseframe.schema import CLEAN, PREDICTIONS
from caseframe.sources import (
    load_uncleaned,
    materialise,
    read_clean_csv,
    read_model,
    read_parquet,
    read_predictions_csv,
    read_raw,
    read_rows,
    write_clean,
    write_csv,
)
from caseframe.sources import working
from tests.conftest import RAW_HEADER, plan, rows


def values(df):
    return sorted(rows(df.select(*sorted(df.columns))), key=str)


@pytest.fixture(scope="module")
def many_raw(spark, tmp_path_factory):
    """Raw train and test files whose rate depends on county and year."""
    folder = tmp_path_factory.mktemp("many")
    counties = [("Alameda", 1), ("Kern", 20), ("Lake", 90), ("California", 5), ("", 3)]
    for name, span in (("train", range(2001, 2008)), ("test", range(2008, 2010))):
        lines, number = [RAW_HEADER], 0
        for year in span:
            for county, weight in counties:
                for disease in ("HIV", "Chlamydia"):
                    for sex in ("Male", "Female", "Total"):
                        number += 1
                        count = weight * (1 + year - 2001)
                        population = "" if county == "Lake" and sex == "Total" else 100_000
                        lines.append(
                            f"{number},{disease},{county},{year},{sex},{count},{population},1.5,1,2"
                        )
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return folder


@pytest.fixture(scope="module")
def stage(spark, many_raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    report = preprocess(spark, f"{many_raw}/train.csv", f"{many_raw}/test.csv", out)
    return out, report


def test_csv_round_trip(spark, cleaned, tmp_path):
    write_csv(cleaned, str(tmp_path / "clean"))
    again = read_clean_csv(spark, str(tmp_path / "clean"))
    assert again.dtypes == cleaned.dtypes
    assert values(again) == values(cleaned)


def test_parquet_round_trip_by_level(spark, cleaned, tmp_path):
    path = str(tmp_path / "clean")
    write_clean(cleaned, path)
    county, state = split_county_state(cleaned)
    assert values(read_rows(spark, path)) == values(county)
    assert values(read_rows(spark, path, "state")) == values(state)
    assert read_rows(spark, path, "unassigned").count() == 1
    assert read_rows(spark, path).columns == CLEAN.names
    write_clean(county, path)
    assert read_parquet(spark, path).count() == 14


def test_year_and_level_prune_folders(spark, cleaned, tmp_path):
    write_clean(cleaned, str(tmp_path / "clean"))
    text = plan(read_rows(spark, str(tmp_path / "clean")).filter("Year = 2001"))
    filters = next(part for part in text.split("PartitionFilters: [")[1:])
    assert "level" in filters.split("]")[0] and "Year" in filters.split("]")[0]


def test_a_year_with_most_rows_is_split_over_tasks(spark, tmp_path):
    """The write must not send all rows of one year through a single task."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    hot = spark.range(200_000).select(
        F.col("id").alias("Id"),
        F.lit("HIV").alias("Disease"),
        F.concat(F.lit("County "), F.col("id")).alias("County"),
        F.when(F.col("id") % 3 == 0, F.lit(2001)).otherwise(2002 + F.col("id") % 13).cast("int").alias("Year"),
    )
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        write_clean(hot, str(tmp_path / "hot"))
    finally:
        for name in settings:
            spark.conf.unset(name)
    files = list(Path(tmp_path / "hot" / "level=county" / "Year=2001").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000


def test_preprocess(spark, stage):
    out, report = stage
    found = {(r["dataset"], r["level"]): r["n_rows"] for r in report.collect()}
    assert found == {
        ("train", "county"): 7 * 18,
        ("train", "state"): 7 * 6,
        ("train", "unassigned"): 7 * 6,
        ("test", "county"): 2 * 18,
        ("test", "state"): 2 * 6,
        ("test", "unassigned"): 2 * 6,
    }
    for dataset in ("train", "test"):
        written = read_clean_csv(spark, f"{out}/csv/{dataset}")
        assert values(written) == values(read_rows(spark, f"{out}/parquet/{dataset}"))
    assert read_clean_csv(spark, f"{out}/csv/test_state").count() == 12


def test_preprocess_equals_clean_and_split(spark, stage, many_raw):
    county, _ = split_county_state(clean(read_raw(spark, f"{many_raw}/train.csv")))
    assert values(read_rows(spark, f"{stage[0]}/parquet/train")) == values(county)


def test_train_and_score(spark, stage):
    out, _ = stage
    metrics = train_and_score(spark, out, out).collect()[0]
    predictions = read_predictions_csv(spark, f"{out}/predictions")
    assert predictions.schema.names == PREDICTIONS.names
    assert predictions.dtypes == [(f.name, f.dataType.simpleString()) for f in PREDICTIONS]
    assert predictions.count() == 36
    unknown = predictions.filter("Population IS NULL")
    assert unknown.count() == 4
    assert unknown.filter("Predicted_Rate IS NOT NULL OR Priority_Level IS NOT NULL").count() == 0
    assert metrics["n_rows"] == 32 and metrics["rmse"] >= 0
    # 7 years x 2 diseases of Lake have no population for one of three sexes
    assert (metrics["n_train"], metrics["n_left_out"]) == (112, 14)
    test = read_rows(spark, f"{out}/parquet/test").filter("Population IS NOT NULL")
    assert read_model(f"{out}/model").transform(test).count() == 32


@pytest.mark.parametrize("empty", ["train", "test"])
def test_a_set_of_nothing_but_the_header(spark, many_raw, tmp_path, empty):
    (tmp_path / "none.csv").write_text(RAW_HEADER + "\n")
    paths = {name: f"{many_raw}/{name}.csv" for name in ("train", "test")}
    paths[empty] = str(tmp_path / "none.csv")
    out = str(tmp_path / "out")
    report = preprocess(spark, paths["train"], paths["test"], out)
    assert {r["dataset"] for r in report.collect()} == {"train", "test"} - {empty}
    rows_read = read_rows(spark, f"{out}/parquet/{empty}")
    assert rows_read.dtypes == [(f.name, f.dataType.simpleString()) for f in CLEAN]
    assert rows_read.count() == 0
    assert read_clean_csv(spark, f"{out}/csv/{empty}").count() == 0
    if empty == "train":
        with pytest.raises(ValueError, match="no county row .* to fit on"):
            train_and_score(spark, out, out)
    else:
        metrics = train_and_score(spark, out, out).collect()[0]
        assert (metrics["n_rows"], metrics["rmse"], metrics["n_train"]) == (0, None, 112)
        train, test, predicted = load_tables(spark, out, paths["train"], paths["test"])
        assert (train.count(), test.count(), predicted.count()) == (7 * 18, 0, 0)


def test_rows_without_any_year(spark, cleaned, tmp_path):
    write_clean(cleaned.withColumn("Year", F.lit(None).cast("int")), str(tmp_path / "clean"))
    again = read_rows(spark, str(tmp_path / "clean"))
    assert dict(again.dtypes)["Year"] == "int" and again.filter("Year IS NULL").count() == 14


def test_screens(spark, stage):
    out, _ = stage
    train = read_rows(spark, f"{out}/parquet/train")
    test = read_rows(spark, f"{out}/parquet/test")
    shown = overview(train, disease="HIV", sex="Male", years=(2002, 2004))
    assert shown["key_figures"].collect()[0]["Top_Disease"] == "HIV"
    assert shown["preview"].count() == 9
    assert trends(train)["year_growth"].collect()[0]["growth"] == 600.0
    assert {r["County"] for r in county_map(train).collect()} == {"Alameda", "Kern", "Lake"}
    stored = test.withColumn("Predicted_Rate", F.col("Recalculated_Rate"))
    past = interventions(train, test, stored, "HIV", 2008)
    assert [r["Cases"] for r in past["county_risk"].collect()] == [8 * 90 * 3, 8 * 20 * 3, 8 * 3]
    ahead = interventions(train, test, stored, "HIV", 2011)
    risk = ahead["county_risk"].collect()
    assert len(risk) == 3 and all(r["Observed_Rate"] is None and r["Cases"] == 0 for r in risk)
    assert ahead["priority_counts"].count() == 1
    assert ahead["recommendations"].count() >= 1
    with pytest.raises(ValueError, match="one disease"):
        interventions(train, test, stored, "Toutes", 2008)


def test_uncleaned_rows_serve_the_screens(spark, many_raw):
    fallback = load_uncleaned(read_raw(spark, f"{many_raw}/train.csv"))
    assert trends(fallback)["yearly_chart"].count() == 7
    figures = overview(fallback)["key_figures"].collect()[0]
    assert figures["Avg_Rate"] == 1.5


def test_load_prefers_the_stages_and_falls_back_to_raw(spark, stage, many_raw, tmp_path):
    raw = f"{many_raw}/train.csv", f"{many_raw}/test.csv"
    train, test, predicted = load_tables(spark, str(tmp_path), *raw)
    # rows without a county stay in the fallback
    assert (train.count(), test.count(), predicted.count()) == (7 * 24, 2 * 24, 2 * 24)
    assert {r[0] for r in predicted.select("Predicted_Rate").distinct().collect()} == {1.5}
    out, _ = stage
    train_and_score(spark, out, out)
    train, test, predicted = load_tables(spark, out, *raw)
    assert (train.count(), test.count(), predicted.count()) == (7 * 18, 2 * 18, 2 * 18)


def test_stages_from_the_command_line(spark, many_raw, tmp_path, capsys):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError, match="run the stage"):
        main(["analyse", out])
    main(["preprocess", f"{many_raw}/train.csv", f"{many_raw}/test.csv", out])
    main(["analyse", out])
    main(["train", out])
    shown = capsys.readouterr().out
    for word in ("unassigned", "county_hotspots", "Percentage", "rmse"):
        assert word in shown
    assert read_predictions_csv(spark, f"{out}/predictions").count() == 36


def test_working_folder_is_the_cluster_setting(spark):
    assert working.working_dir(spark) == spark.conf.get(working.SETTING)


def test_materialised_table_does_not_carry_the_plan(spark, cleaned):
    table = materialise(cleaned.groupBy("Disease").count())
    assert "Aggregate" not in plan(table) and "FileScan parquet" in plan(table)
    assert table.count() == 6


class Session:
    """The parts of a session the working folder is chosen by."""

    def __init__(self, master, setting=None):
        self.conf = {working.SETTING: setting} if setting else {}
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"

    def getCheckpointDir(self):
        return None


def test_no_machine_local_folder_on_a_cluster():
    assert working.working_dir(Session("yarn", "s3a://shared/work/")) == "s3a://shared/work"
    unset = Session("yarn")
    unset.conf = SimpleNamespace(
        get=lambda name, default=None: {"spark.sql.warehouse.dir": "hdfs://shared/w/"}.get(
            name, default
        )
    )
    assert working.working_dir(unset) == "hdfs://shared/w"
