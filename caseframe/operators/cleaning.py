"""From raw text to the typed fact table, and its county and state halves."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.functions import (
    is_number,
    lenient_double,
    lenient_int,
    lenient_long,
    prevalence,
    whole_number,
)
from caseframe.operators.copies import numbered_copies
from caseframe.schema import (
    DOTTED,
    DOUBLE_COLUMNS,
    FILLED,
    INT_COLUMNS,
    LONG_COLUMNS,
    RAW_INDEX,
    REJECTED,
    STATE,
)


def with_id(df: DataFrame) -> DataFrame:
    """``Id`` from the unnamed index column, or generated.

    A generated id is a hash of the row's content and of its number among equal
    rows, so it is the same in every run and in every layout of the files. Two
    different rows of n share one with a probability of about n² / 2⁶⁴; ids repeat
    between two frames, so nothing joins on them. An index written as ``12.0`` is
    12; one that is no whole number fails the job.
    """
    if RAW_INDEX in df.columns:
        return df.withColumnRenamed(RAW_INDEX, "Id").withColumn(
            "Id", whole_number(F.col("Id"))
        )
    names = [f"`{name}`" for name in df.columns]
    # Nulls are part of the content: without their places, neighbours could be taken for each other.
    missing = F.array(*(F.col(name).isNull() for name in names))
    return numbered_copies(df, "_copy").withColumn("Id", F.xxhash64(missing, *names, "_copy")).drop("_copy")


def with_prevalence(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "Recalculated_Rate", prevalence(F.col("Count"), F.col("Population"))
    )


def clean(raw: DataFrame) -> DataFrame:
    """Typed rows with filled gaps and the recomputed prevalence.

    Further columns pass through. Population, Year and the keys keep nulls. A
    count is filled where none was given or it was no number; a number beyond
    64 bits is null, not 0.
    """
    casts = {name: lenient_int(F.col(name)) for name in INT_COLUMNS}
    casts |= {name: lenient_long(F.col(name)) for name in LONG_COLUMNS}
    given = F.when(is_number(F.col("Count")), casts["Count"])
    casts["Count"] = given.when(~is_number(F.col("Count")), F.lit(0).cast("bigint"))
    casts |= {name: lenient_double(F.col(name)) for name in DOUBLE_COLUMNS}
    typed = with_id(raw).withColumnsRenamed(DOTTED).withColumns(casts)
    return with_prevalence(typed.na.fill(FILLED))


def split_county_state(df: DataFrame, state: str = STATE) -> tuple[DataFrame, DataFrame]:
    """County rows and state rows. A row without a county is in neither."""
    county = F.col("County")
    return df.filter(county != state), df.filter(county == state)


def with_level(df: DataFrame, state: str = STATE) -> DataFrame:
    """Adds ``level``: county, state, unassigned where the county is missing, or rejected.

    Rejected are malformed lines, where the rows come with their text.
    """
    county = F.col("County")
    rejected = F.col(REJECTED).isNotNull() if REJECTED in df.columns else F.lit(False)
    level = (
        F.when(rejected, F.lit("rejected"))
        .when(county.isNull(), F.lit("unassigned"))
        .when(county == state, F.lit("state"))
        .otherwise(F.lit("county"))
    )
    return df.withColumn("level", level)


def row_report(df: DataFrame, by: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """Rows per data set and level, in one pass."""
    keys = [name for name in by if name in df.columns]
    return with_level(df).groupBy(*keys, "level").agg(F.count(F.lit(1)).alias("n_rows"))
