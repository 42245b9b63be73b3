"""Run queries and their SQL side by side and compare rows, values and types.

    python -m checks.compare [folder of the tables] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TYPES = {
    "BOOLEAN": "boolean",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def _sorted_rows(rows, order):
    plain = [tuple(_plain(row[place]) for place in order) for row in rows]
    return sorted(plain, key=lambda row: [(value is None, str(value)) for value in row])


def differences(df: DataFrame, connection, sql: str) -> list[str]:
    """What differs, in words; empty when schema and all values agree."""
    result = connection.sql(sql)
    ours = dict(df.dtypes)
    theirs = {
        name: TYPES.get(str(kind), str(kind))
        for name, kind in zip(result.columns, result.types, strict=True)
    }
    found = []
    if ours != theirs:
        found.append(f"schema {sorted(ours.items())} against {sorted(theirs.items())}")
        if set(ours) != set(theirs):
            return found
    names = sorted(ours)
    left = _sorted_rows(df.collect(), [df.columns.index(name) for name in names])
    right = _sorted_rows(result.fetchall(), [result.columns.index(name) for name in names])
    if len(left) != len(right):
        found.append(f"{len(left)} rows against {len(right)}")
    unequal = [(a, b) for a, b in zip(left, right, strict=False) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first: {unequal[0]}")
    return found


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caseframe-checks")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES

    spark, connection, failed = session(), duck(sf_dir), 0
    for name in names or QUERIES:
        start = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        if name in ORACLES:
            found = differences(df, connection, ORACLES[name])
        else:
            found = [] if df.count() else ["no rows"]
        failed += bool(found)
        verdict = "; ".join(found) or "equal" if name in ORACLES else "rows only"
        print(f"{name:20} {time.perf_counter() - start:6.2f}s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
