"""Raw, cleaned and predicted tables from CSV or parquet.

CSV is read by the names in the header of each file and without inference: every
column arrives as text under its own name, and bad tokens reach the lenient casts
instead of changing a column's type. Files of one folder may have their columns
in different orders. Lines with more or fewer fields than their header are no
rows; ``read_raw_lines`` keeps them as rejected, the other readers leave them out.
"""

from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caseframe.functions.casting import (
    lenient_double,
    lenient_int,
    lenient_long,
    missing_if_nan,
)
from caseframe.schema import (
    CLEAN,
    DOTTED,
    DOUBLE_COLUMNS,
    INT_COLUMNS,
    LONG_COLUMNS,
    LOW,
    PREDICTIONS,
    RAW_REQUIRED,
    REJECTED,
    STATE,
)
from caseframe.sources.layouts import layouts, read_lines
from caseframe.sources.publishing import published

_CASTS = {"int": lenient_int, "bigint": lenient_long, "double": lenient_double}


def _open(read: Callable[[], DataFrame], path: str) -> DataFrame:
    """Storage is asked by Spark itself, so any file system it knows will do."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(
            f"no input at {path}; run the stage that writes it first"
        ) from error


def _require(df: DataFrame, names: Iterable[str], path: str) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return df


def _read_text(
    spark: SparkSession, path: str, required: Iterable[str], multi_line: bool = False
) -> DataFrame:
    """Rows by name and rejected lines; every layout must have the required columns."""
    found = _open(lambda: layouts(spark, path), path)
    for names, files in found:
        missing = [name for name in required if name not in names]
        if missing:
            more = f" and {len(files) - 1} more files" if len(files) > 1 else ""
            raise ValueError(f"{files[0]}{more} lack the columns {', '.join(missing)}")
    return _require(read_lines(spark, path, multi_line, found), required, path)


def _good(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def _as_schema(df: DataFrame, schema: StructType) -> DataFrame:
    casts = {
        field.name: _CASTS[field.dataType.simpleString()](F.col(field.name))
        for field in schema
        if field.dataType.simpleString() in _CASTS
    }
    return df.withColumns(casts)


def read_raw_lines(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw extract, all text, with the text of malformed lines in ``REJECTED``.

    An unnamed first column shows up as ``_c0``. ``multi_line`` allows line breaks
    in quoted fields, at the price of one task per file.
    """
    return _read_text(spark, path, RAW_REQUIRED, multi_line)


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The rows of a raw extract, all text, without malformed lines."""
    return _good(read_raw_lines(spark, path, multi_line))


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    return _as_schema(_good(_read_text(spark, published(spark, path), CLEAN.names)), CLEAN)


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    return _as_schema(_good(_read_text(spark, published(spark, path), PREDICTIONS.names)), PREDICTIONS)


def input_report(
    spark: SparkSession,
    csv: Mapping[str, str],
    parquet: Mapping[str, str] | None = None,
    csv_columns: Iterable[str] = RAW_REQUIRED,
    parquet_columns: StructType = CLEAN,
) -> DataFrame:
    """One row per data set and expected column: whether it is there, and with which type.

    ``csv`` and ``parquet`` are paths by data set. ``n_files`` counts files with a
    header (of a parquet set: all), ``n_with_column`` those that have the column; a
    path that is not there has none. Only headers and footers are read.
    """
    rows = []
    for dataset, path in csv.items():
        try:
            found = _open(lambda path=path: layouts(spark, path), path)
        except FileNotFoundError:
            found = None
        n_files = sum(len(files) for _, files in found or [])
        for name in csv_columns:
            having = sum(len(files) for names, files in found or [] if name in names)
            kind = "string" if having else None
            rows.append((dataset, name, found is not None, n_files, having, kind, "string"))
    for dataset, path in (parquet or {}).items():
        try:
            table = read_parquet(spark, path)
        except FileNotFoundError:
            table = None
        n_files = 0 if table is None else len(table.inputFiles())
        kinds = {} if table is None else dict(table.dtypes)
        for field in parquet_columns:
            kind = kinds.get(field.name)
            expected = field.dataType.simpleString()
            having = n_files if kind else 0
            rows.append((dataset, field.name, table is not None, n_files, having, kind, expected))
    report = spark.createDataFrame(
        rows,
        "dataset string, column string, path_found boolean, n_files long, n_with_column long,"
        " found_type string, expected_type string",
    )
    everywhere = (F.col("n_files") > 0) & (F.col("n_with_column") == F.col("n_files"))
    right = F.col("found_type").eqNullSafe(F.col("expected_type"))
    return report.withColumn("usable", everywhere & right)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A table; where a stage published it, its current generation."""
    return _open(lambda: spark.read.parquet(published(spark, path)), path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned table written by ``write_clean``, all levels.

    An empty set leaves a folder without files; it has the known columns and no rows.
    """
    try:
        rows = read_parquet(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        layout = StructType([*CLEAN, StructField("level", StringType(), True)])
        rows = spark.read.schema(layout).parquet(published(spark, path))
    # Without a known year in any row the folder names alone do not tell its type.
    return rows.withColumn("Year", F.col("Year").cast("int"))


def read_rows(spark: SparkSession, path: str, level: str = "county") -> DataFrame:
    """One half of a cleaned table written by ``write_clean``.

    ``level`` and, in later filters, ``Year`` are partition columns, so only the
    folders asked for are listed and read.
    """
    rows = read_clean(spark, path).filter(F.col("level") == level).drop("level")
    if level != "rejected":
        rows = rows.drop(REJECTED)
    extra = [name for name in rows.columns if name not in CLEAN.names]
    return rows.select(*CLEAN.names, *extra)


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(published(SparkSession.active(), path))


def load_uncleaned(raw: DataFrame, state: str = STATE) -> DataFrame:
    """Stand-in for the cleaned table when only the raw extract is there.

    The published rate is taken over as it is. Missing numbers stay missing,
    and so do rows without a county: only the state rows are dropped.
    """
    casts = {name: missing_if_nan(lenient_double(F.col(name))) for name in DOUBLE_COLUMNS}
    casts |= {name: lenient_int(F.col(name)) for name in INT_COLUMNS}
    casts |= {name: lenient_long(F.col(name)) for name in LONG_COLUMNS}
    return (
        raw.withColumnsRenamed(DOTTED)
        .withColumns(casts)
        .withColumn("Recalculated_Rate", F.col("Rate"))
        .filter(~F.col("County").eqNullSafe(state))
    )


def load_uncleaned_predictions(test: DataFrame) -> DataFrame:
    """Stand-in for the predictions: the published rate, all in the lowest band."""
    return test.withColumns({"Predicted_Rate": F.col("Rate"), "Priority_Level": F.lit(LOW)})
