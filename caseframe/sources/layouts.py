"""CSV files read by the names in their own headers.

The files of a folder need not share a header: columns may be in another order,
and a file may have columns that others lack. The first line of every
file is read; files with equal headers are read together, and the layouts are
united by name. A line with more or fewer fields than its header is no row: it
is kept as text in ``REJECTED``, where all other columns are null.
"""

import csv
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caseframe.schema import REJECTED

#: Files that are opened side by side; opening one waits for the storage.
_OPENED = 16


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file as Spark's text reader splits it, None where it has none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        line = jvm.org.apache.hadoop.io.Text()
        found = jvm.org.apache.hadoop.util.LineReader(stream, conf).readLine(line)
        return line.toString() if found else None
    finally:
        stream.close()


def _first_lines(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Each file that has a line, and that line.

    The driver lists the files, as it does to plan any scan, and reads the first
    buffer of each: the rest of a file is not read, however long it is. (A task that
    hands its rows to Python reads its whole file, even if Python takes one line.)
    """
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(_OPENED) as pool:
        lines = list(pool.map(lambda file: _first_line(spark, file), files))
    return [(file, line) for file, line in zip(files, lines, strict=True) if line is not None]


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``header``, the first line of each file that has one."""
    found = _first_lines(spark, path)
    rows = spark.sparkContext.parallelize(found, max(len(found), 1))
    return spark.createDataFrame(rows, "file string, header string")


def column_names(header: str) -> list[str]:
    """Names in a header line; a column without one is ``_c`` and its place."""
    fields = next(csv.reader([header.removeprefix("﻿")]), [])
    names = [name or f"_c{place}" for place, name in enumerate(fields)]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"a header names {', '.join(twice)} more than once")
    return names


def layouts(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """Column names and files of each layout found, the most common first.

    The driver holds the names of the files, as it does to plan any scan.
    """
    files = defaultdict(list)
    for file, header in _first_lines(spark, path):
        files[header].append(file)
    found = [(column_names(header), sorted(of_header)) for header, of_header in files.items()]
    return sorted(found, key=lambda layout: (-len(layout[1]), layout[0]))


def _plain(file: str) -> str:
    """A file's address as a path that no pattern matching changes."""
    return "".join(f"\\{sign}" if sign in "*?[]{}\\" else sign for sign in unquote(file))


def _is_folder(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(target) and system.getFileStatus(target).isDirectory()


def read_lines(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    found: list[tuple[list[str], list[str]]] | None = None,
) -> DataFrame:
    """All columns of all files as text, united by name, and ``REJECTED``.

    With ``multi_line`` a quoted field may hold line breaks; a file is then read
    by a single task. Without it, such a field's lines are rejected. ``found`` are
    the layouts, where they are known already.
    """
    found = layouts(spark, path) if found is None else found
    if not found:
        return spark.createDataFrame([], StructType([StructField(REJECTED, StringType())]))
    parts = []
    for names, files in found:
        reader = (
            spark.read.schema(StructType([StructField(name, StringType()) for name in [*names, REJECTED]]))
            .option("header", True)
            .option("columnNameOfCorruptRecord", REJECTED)
            # Fields are counted only where a line is split as a whole.
            .option("columnPruning", False)
            .option("multiLine", multi_line)
        )
        if len(found) == 1:
            parts.append(reader.csv(path))
            continue
        if _is_folder(spark, path):
            reader = reader.option("basePath", path)
        parts.append(reader.csv([_plain(file) for file in files]))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    good = F.col(REJECTED).isNull()
    names = [name for name in united.columns if name != REJECTED]
    kept = [F.when(good, F.col(f"`{name}`")).alias(name) for name in names]
    # Spark refuses queries that need nothing but the rejected text, such as a count of
    # the good rows. Naming a second column, which is never taken, makes them possible.
    text = F.when(~good, F.coalesce(F.col(REJECTED), F.col(f"`{names[0]}`")))
    return united.select(*kept, text.alias(REJECTED))
