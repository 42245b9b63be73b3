"""CSV files of several layouts, malformed lines, and what is told of inputs."""

import gzip

import pytest

from caseframe.operators.cleaning import clean, row_report
from caseframe.plans.preprocess import preprocess
from caseframe.schema import CLEAN, REJECTED
from caseframe.sources import (
    file_headers,
    input_report,
    layouts,
    read_lines,
    read_raw,
    read_raw_lines,
    read_rows,
)
from caseframe.sources.layouts import column_names
from tests.conftest import RAW_HEADER, RAW_LINES

SWAPPED = ",Disease,County,Year,Sex,Population,Count,Rate,CI.lower,CI.upper"


def put(path, *lines):
    path.write_text("".join(f"{line}\n" for line in lines))


def counties(df):
    return {row["Id"]: (row["County"], row["Count"], row["Population"]) for row in clean(df).collect()}


def test_two_files_with_swapped_columns(spark, tmp_path):
    put(tmp_path / "a.csv", RAW_HEADER, "1,HIV,Kern,2001,Male,7,1000,1,0,2")
    put(tmp_path / "b.csv", SWAPPED, "2,HIV,Kern,2001,Male,1000,7,1,0,2")
    rows = clean(read_raw(spark, str(tmp_path))).collect()
    assert [(r["Count"], r["Population"], r["Recalculated_Rate"]) for r in rows] == [(7, 1000, 700.0)] * 2


def test_columns_that_some_files_lack_are_null_there(spark, tmp_path):
    put(tmp_path / "a.csv", RAW_HEADER + ",Source", "1,HIV,Kern,2001,Male,7,1000,1,0,2,x")
    put(tmp_path / "b.csv", RAW_HEADER, "2,HIV,Kern,2001,Male,7,1000,1,0,2")
    put(tmp_path / "c.csv", RAW_HEADER, "3,HIV,Kern,2001,Male,7,1000,1,0,2")
    found = layouts(spark, str(tmp_path))
    assert [len(files) for _, files in found] == [2, 1]
    assert {r["_c0"]: r["Source"] for r in read_raw(spark, str(tmp_path)).collect()} == {
        "1": "x", "2": None, "3": None,
    }


def test_a_required_column_must_be_in_every_file(spark, tmp_path):
    put(tmp_path / "a.csv", RAW_HEADER, "1,HIV,Kern,2001,Male,7,1000,1,0,2")
    put(tmp_path / "b.csv", RAW_HEADER.replace(",Rate", ",Share"), "2,HIV,Kern,2001,Male,7,1000,1,0,2")
    with pytest.raises(ValueError, match=r"b\.csv lack the columns Rate"):
        read_raw(spark, str(tmp_path))


def test_malformed_lines_are_rejected_and_kept_as_text(spark, tmp_path):
    short, long = "4,HIV", "5,HIV,Kern,2001,Male,7,1000,1,0,2,extra"
    broken = ['6,HIV,"North', 'Sutter",2001,Male,7,1000,1,0,2']
    good = "1,HIV,Kern,2001,Male,7,1000,1,0,2"
    put(tmp_path / "a.csv", RAW_HEADER, good, short, long, *broken, "")
    path = str(tmp_path)
    assert counties(read_raw(spark, path)) == {1: ("Kern", 7, 1000)}
    lines = read_raw_lines(spark, path)
    assert sorted(r[0] for r in lines.select(REJECTED).collect() if r[0]) == sorted([short, long, *broken])
    others = [name for name in lines.columns if name != REJECTED]
    for row in lines.filter(lines[REJECTED].isNotNull()).collect():
        assert all(row[name] is None for name in others)
    assert lines.count() == 5 and read_raw(spark, path).count() == 1
    report = {r["level"]: r["n_rows"] for r in row_report(clean(lines)).collect()}
    assert report == {"county": 1, "rejected": 4}


def test_quoted_line_breaks_are_read_where_allowed(spark, tmp_path):
    put(tmp_path / "a.csv", RAW_HEADER, '6,HIV,"North', 'Sutter",2001,Male,7,1000,1,0,2', "7,HIV")
    lines = read_raw_lines(spark, str(tmp_path), multi_line=True)
    report = {r["level"]: r["n_rows"] for r in row_report(clean(lines)).collect()}
    assert report == {"county": 1, "rejected": 1}
    assert counties(read_raw(spark, str(tmp_path), multi_line=True)) == {6: ("North\nSutter", 7, 1000)}


def test_the_stage_counts_and_keeps_rejected_lines(spark, tmp_path):
    put(tmp_path / "train.csv", RAW_HEADER, *RAW_LINES, "17,HIV,Kern", "x,y,z,1,2,3,4,5,6,7,8,9")
    put(tmp_path / "test.csv", RAW_HEADER, *RAW_LINES[:2])
    out = str(tmp_path / "out")
    report = preprocess(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"), out)
    found = {(r["dataset"], r["level"]): r["n_rows"] for r in report.collect()}
    assert found == {
        ("train", "county"): 14, ("train", "state"): 1, ("train", "unassigned"): 1,
        ("train", "rejected"): 2, ("test", "county"): 2,
    }
    kept = read_rows(spark, f"{out}/parquet/train", "rejected").select(REJECTED).collect()
    assert sorted(r[0] for r in kept) == ["17,HIV,Kern", "x,y,z,1,2,3,4,5,6,7,8,9"]
    assert read_rows(spark, f"{out}/parquet/train").columns == CLEAN.names


def test_odd_files(spark, tmp_path):
    folder = tmp_path / "odd [1] {a} 100%"
    folder.mkdir()
    put(folder / "a b.csv", "﻿" + RAW_HEADER, "1,HIV,Kern,2001,Male,7,1000,1,0,2")
    put(folder / "c*d.csv", SWAPPED, "2,HIV,Kern,2001,Male,1000,7,1,0,2")
    put(folder / "only header.csv", RAW_HEADER)
    (folder / "empty.csv").write_text("")
    with gzip.open(folder / "e.csv.gz", "wt") as file:
        file.write(f"{RAW_HEADER}\n3,HIV,Kern,2001,Male,7,1000,1,0,2\n")
    for pattern in ("odd ?1? ?a? 100%", "odd*"):
        path = str(tmp_path / pattern)
        assert file_headers(spark, path).count() == 4
        assert counties(read_raw(spark, path)) == {n: ("Kern", 7, 1000) for n in (1, 2, 3)}


def test_partition_folders_stay_columns(spark, tmp_path):
    for name, header, line in (
        ("a", RAW_HEADER, "1,HIV,Kern,2001,Male,7,1000,1,0,2"),
        ("b", SWAPPED, "2,HIV,Kern,2001,Male,1000,7,1,0,2"),
    ):
        (tmp_path / f"state={name}").mkdir()
        put(tmp_path / f"state={name}" / "x.csv", header, line)
    rows = read_raw(spark, str(tmp_path)).collect()
    assert {r["_c0"]: r["state"] for r in rows} == {"1": "a", "2": "b"}


def test_headers_are_read_from_the_start_of_each_file_only(spark, tmp_path):
    put(tmp_path / "a.csv", RAW_HEADER, *(f"{n},HIV,Kern,2001,Male,7,1000,1,0,2" for n in range(30_000)))
    put(tmp_path / "b.csv", SWAPPED, *(f"{n},HIV,Kern,2001,Male,1000,7,1,0,2" for n in range(30_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert sorted(r["header"] for r in file_headers(spark, str(tmp_path)).collect()) == sorted(
        [RAW_HEADER, SWAPPED]
    )
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert file_headers(spark, str(tmp_path)).rdd.getNumPartitions() == 2
    rows = clean(read_raw(spark, str(tmp_path)))
    assert rows.filter("Count <> 7 OR Population <> 1000").count() == 0 and rows.count() == 60_000


def test_only_the_first_line_of_a_file_is_read_for_its_header(spark, tmp_path):
    lines = "".join(f"{n},HIV,Kern,2001,Male,7,{n * n},1,0,2\n" for n in range(200_000))
    whole = gzip.compress(f"{RAW_HEADER}\n{lines}".encode())
    # Reading on would come to where the file breaks off.
    (tmp_path / "a.csv.gz").write_bytes(whole[: len(whole) // 2])
    assert [names for names, _ in layouts(spark, str(tmp_path))] == [column_names(RAW_HEADER)]


def test_lines_may_end_in_any_way(spark, tmp_path):
    for name, end in (("a", "\r\n"), ("b", "\r"), ("c", "\n"), ("d", "")):
        (tmp_path / f"{name}.csv").write_bytes(f"{RAW_HEADER}{end}".encode())
    (tmp_path / "e.csv").write_bytes(b"\n1,2")
    found = {tuple(names): len(files) for names, files in layouts(spark, str(tmp_path))}
    assert found == {tuple(column_names(RAW_HEADER)): 4, (): 1}


def test_names_of_a_header():
    assert column_names('a,"b,c",,d') == ["a", "b,c", "_c2", "d"]
    assert column_names("") == []
    with pytest.raises(ValueError, match="names a more than once"):
        column_names("a,b,a")


def test_nothing_to_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, str(tmp_path / "none"))
    (tmp_path / "empty.csv").write_text("")
    assert read_lines(spark, str(tmp_path / "empty.csv")).count() == 0
    with pytest.raises(ValueError, match="lacks the columns Disease"):
        read_raw(spark, str(tmp_path / "empty.csv"))


def test_input_report(spark, tmp_path):
    put(tmp_path / "a.csv", RAW_HEADER, *RAW_LINES)
    put(tmp_path / "b.csv", RAW_HEADER.replace(",Rate", ""), "1,HIV,Kern,2001,Male,7,1000,0,2")
    report = input_report(spark, {"raw": str(tmp_path), "none": str(tmp_path / "x")}, {"gone": str(tmp_path / "y")})
    found = {(r["dataset"], r["column"]): r for r in report.collect()}
    assert len(found) == 9 + 9 + 11
    rate = found["raw", "Rate"]
    assert (rate["n_files"], rate["n_with_column"], rate["usable"]) == (2, 1, False)
    assert found["raw", "Year"]["usable"]
    for key in (("none", "Year"), ("gone", "Year")):
        assert not found[key]["path_found"] and not found[key]["usable"] and found[key]["n_files"] == 0
