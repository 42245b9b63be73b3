"""Work that grows with the rows is done once."""

import threading

from caseframe.plans import preprocess
from caseframe.sources import unsorted_writes
from checks import queries


def test_the_joins_of_the_input_check_run_once(spark, monkeypatch):
    seen, write = [], queries.write_clean

    def noted(df, path):
        seen.append(df._jdf.queryExecution().analyzed().toString())
        return write(df, path)

    monkeypatch.setattr(queries, "write_clean", noted)
    assert queries.input_check(spark, "/root/testdata/sf0.001").count() == 38
    assert seen and "Join" not in seen[0]


def test_the_stage_works_on_both_sets_side_by_side(spark, raw_csv, tmp_path, monkeypatch):
    both, write = threading.Barrier(2, timeout=60), preprocess.write_clean

    def waiting(cleaned, path):
        both.wait()
        return write(cleaned, path)

    monkeypatch.setattr(preprocess, "write_clean", waiting)
    report = preprocess.preprocess(spark, raw_csv, raw_csv, str(tmp_path)).collect()
    counts = {name: {r["level"]: r["n_rows"] for r in report if r["dataset"] == name} for name in ("train", "test")}
    assert counts["train"] == counts["test"] == {"county": 14, "state": 1, "unassigned": 1}


def test_writes_by_folder_do_not_sort(spark, tmp_path):
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    with unsorted_writes(spark):
        assert int(spark.conf.get(setting)) > 1
        spark.range(100).selectExpr("id", "id % 50 AS part").write.partitionBy("part").parquet(f"{tmp_path}/t")
    assert spark.conf.get(setting) == before
    assert spark.read.parquet(f"{tmp_path}/t").groupBy("part").count().filter("count = 2").count() == 50
