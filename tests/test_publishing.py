"""Stages that publish all their outputs or none, counts of a write, and stable ids."""

import pytest
from pyspark.sql import functions as F

from caseframe.operators.cleaning import clean, row_report
from caseframe.operators.copies import numbered_copies
from caseframe.plans import preprocess as stage
from caseframe.plans import train as training
from caseframe.plans.preprocess import preprocess
from caseframe.plans.train import train_and_score
from caseframe.sources import (
    manifest,
    publication,
    published,
    read_clean,
    read_clean_csv,
    read_model,
    read_predictions_csv,
    read_raw,
    read_raw_lines,
    read_rows,
    write_clean,
)
from tests.conftest import RAW_HEADER, RAW_LINES


def put(path, *lines):
    path.write_text("".join(f"{line}\n" for line in [RAW_HEADER, *lines]))
    return str(path)


@pytest.fixture
def inputs(tmp_path):
    train = put(tmp_path / "train.csv", *RAW_LINES, "17,HIV")
    return train, put(tmp_path / "test.csv", *RAW_LINES[:6]), str(tmp_path / "out")


def test_a_failure_after_the_first_set_leaves_the_old_generation(spark, inputs, tmp_path, monkeypatch):
    train, test, out = inputs
    preprocess(spark, train, test, out)
    before = {name: read_rows(spark, f"{out}/parquet/{name}").count() for name in ("train", "test")}
    entries = manifest(spark, out)["entries"]
    larger = put(tmp_path / "more.csv", *RAW_LINES, "18,HIV,Kern,2001,Male,7,1000,1,0,2")
    calls = []

    def fails_late(df, path):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(stage, "write_csv", fails_late)
        with pytest.raises(OSError, match="disk full"):
            preprocess(spark, larger, larger, out)
    assert manifest(spark, out)["entries"] == entries
    after = {name: read_rows(spark, f"{out}/parquet/{name}").count() for name in ("train", "test")}
    assert after == before
    assert [p.name for p in (tmp_path / "out" / "generations").iterdir()] == list(set(entries.values()))
    preprocess(spark, larger, larger, out)
    assert read_rows(spark, f"{out}/parquet/test").count() == before["train"] + 1
    assert read_clean_csv(spark, f"{out}/csv/test").count() == before["train"] + 1


def test_an_opened_generation_outlives_the_next_one_only(spark, inputs, tmp_path):
    train, test, out = inputs
    preprocess(spark, train, test, out)
    opened = read_rows(spark, f"{out}/parquet/train")
    n, folder = opened.count(), published(spark, f"{out}/parquet/train")
    preprocess(spark, test, test, out)
    assert opened.count() == n
    preprocess(spark, test, test, out)
    assert published(spark, f"{out}/parquet/train") != folder
    left = {p.name for p in (tmp_path / "out" / "generations").iterdir()}
    told = manifest(spark, out)
    assert left == set(told["entries"].values()) | set(told["retired"]) and len(left) == 2


def test_stages_publish_beside_each_other(spark, inputs, monkeypatch):
    train, test, out = inputs
    preprocess(spark, train, test, out)
    train_and_score(spark, out, out)
    assert sorted(manifest(spark, out)["entries"]) == ["csv", "model", "parquet", "predictions"]
    n = read_predictions_csv(spark, f"{out}/predictions").count()
    first = read_model(f"{out}/model").uid

    def fails(df, path):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(training, "write_predictions", fails)
        with pytest.raises(OSError):
            train_and_score(spark, out, out)
    assert read_model(f"{out}/model").uid == first
    assert read_predictions_csv(spark, f"{out}/predictions").count() == n


def test_paths_without_a_manifest_stay_as_they_are(spark, tmp_path):
    assert published(spark, f"{tmp_path}/a/b") == f"{tmp_path}/a/b"
    assert published(spark, "s") == "s" and published(spark, "/x") == "/x"
    with publication(spark, str(tmp_path)) as staged:
        spark.range(3).write.parquet(f"{staged}/a/b")
    assert spark.read.parquet(published(spark, f"{tmp_path}/a/b")).count() == 3
    assert published(spark, f"{tmp_path}/other") == f"{tmp_path}/other"


def test_the_write_counts_its_rows(spark, inputs, tmp_path):
    lines = clean(read_raw_lines(spark, inputs[0]))
    counts = write_clean(lines, str(tmp_path / "t"))
    expected = {r["level"]: r["n_rows"] for r in row_report(lines).collect()}
    assert counts == expected == {"county": 14, "state": 1, "unassigned": 1, "rejected": 1}
    stored = read_clean(spark, str(tmp_path / "t"))
    assert {r["level"]: r["n_rows"] for r in row_report(stored).collect()} == counts


def test_the_report_needs_no_job_of_its_own(spark, inputs):
    train, test, out = inputs
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("report", "report")
    try:
        report = preprocess(spark, train, test, out)
        before = len(tracker.getJobIdsForGroup("report"))
        found = {(r["dataset"], r["level"]): r["n_rows"] for r in report.collect()}
        assert len(tracker.getJobIdsForGroup("report")) - before <= 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found["train", "rejected"] == 1 and found["test", "county"] == 4
    assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString()


def test_generated_ids_do_not_depend_on_the_layout(spark, inputs):
    raw = read_raw(spark, inputs[0]).drop("_c0")
    raw = raw.unionByName(raw.limit(4)).unionByName(raw.limit(2))

    def ids(df):
        return sorted((str(row[:-1]), row[-1]) for row in clean(df).select(*clean(raw).drop("Id").columns, "Id").collect())

    one, many = ids(raw.coalesce(1)), ids(raw.repartition(13))
    assert one == many and len({i for _, i in one}) == len(one) == 22


def test_null_and_neighbour_are_no_equal_content(spark):
    df = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    from caseframe.operators.cleaning import with_id

    assert len({r["Id"] for r in with_id(df).collect()}) == 2


def test_copies_are_numbered_from_one(spark):
    df = spark.range(250_000).select(F.when(F.col("id") < 249_990, F.lit(0)).otherwise(F.col("id")).alias("v"))
    found = numbered_copies(df, "copy").groupBy("v").agg(
        F.min("copy").alias("least"), F.max("copy").alias("most"), F.countDistinct("copy").alias("n")
    )
    table = {r["v"]: (r["least"], r["most"], r["n"]) for r in found.collect()}
    assert table[0] == (1, 249_990, 249_990) and len(table) == 11
