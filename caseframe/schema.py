"""Column names, table layouts and fixed labels shared by the package."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields):
    return StructType([StructField(name, kind(), True) for name, kind in fields])


# Column names of the raw extract and of the tables made from it.
_KEYS = (
    ("Id", LongType),
    ("Disease", StringType),
    ("County", StringType),
    ("Year", IntegerType),
    ("Sex", StringType),
    ("Count", LongType),
    ("Population", LongType),
)

CLEAN = _struct(
    *_KEYS,
    ("Rate", DoubleType),
    ("CI_lower", DoubleType),
    ("CI_upper", DoubleType),
    ("Recalculated_Rate", DoubleType),
)

PREDICTIONS = _struct(
    *_KEYS,
    ("Recalculated_Rate", DoubleType),
    ("Predicted_Rate", DoubleType),
    ("Priority_Level", StringType),
)

COORDINATES = _struct(
    ("County", StringType), ("latitude", DoubleType), ("longitude", DoubleType)
)

# Columns a raw extract must carry. The unnamed index column is optional.
RAW_REQUIRED = (
    "Disease",
    "County",
    "Year",
    "Sex",
    "Count",
    "Population",
    "Rate",
    "CI.lower",
    "CI.upper",
)
RAW_INDEX = "_c0"
# The text of a line that is no row, and the levels of rows.
REJECTED = "_rejected"
LEVELS = ("county", "state", "unassigned", "rejected")
# Names with dots, and what stands for missing numbers.
DOTTED = {"CI.lower": "CI_lower", "CI.upper": "CI_upper"}
INT_COLUMNS = ("Year",)
LONG_COLUMNS = ("Count", "Population")
DOUBLE_COLUMNS = ("Rate", "CI_lower", "CI_upper")
FILLED = {"Rate": 0.0, "CI_lower": 0.0, "CI_upper": 0.0}

# The state roll-up row, the two sexes that are no roll-up, the
# "no filter" choices of the selection lists and the "no data" text.
STATE = "California"
SEXES = ("Male", "Female")
ALL_DISEASES = "Toutes"
ALL_SEXES = "Tous"
NOT_AVAILABLE = "N/A"

# Priority bands and their inclusive upper bounds per 100,000.
LOW = "Basse Priorite"
MEDIUM = "Moyenne Priorite"
HIGH = "Haute Priorite"
LOW_MAX = 5.0
MEDIUM_MAX = 50.0
