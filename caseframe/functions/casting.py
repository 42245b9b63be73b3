"""Casts that turn bad tokens into null instead of failing the job."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(col: Column) -> Column:
    return col.try_cast("double")


def lenient_int(col: Column) -> Column:
    """Go through double, so that the text ``3.9`` becomes 3 and not null."""
    return col.try_cast("double").try_cast("int")


def lenient_long(col: Column) -> Column:
    """As ``lenient_int``, but through a decimal, which keeps all digits."""
    return col.try_cast("decimal(38,18)").try_cast("bigint")


def whole_number(col: Column) -> Column:
    """The text of a whole number, ``12`` or ``12.0``; any other text fails the job."""
    number = col.try_cast("decimal(38,18)")
    return F.when(number == F.floor(number), number.try_cast("bigint")).when(
        col.isNotNull(),
        F.raise_error(F.concat(F.lit("index value is no whole number: "), col.cast("string"))),
    )


def is_number(col: Column) -> Column:
    """Whether a value was given and is a number."""
    number = lenient_double(col)
    return number.isNotNull() & ~F.isnan(number)


def missing_if_nan(col: Column) -> Column:
    return F.when(~F.isnan(col), col)
