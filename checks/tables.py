"""The given tables in the shape of surveillance data.

brand -> Disease, nation -> County, order year -> Year, return flag -> Sex,
summed quantity -> Count, customers of the nation x 1000 -> Population. One
nation has population 0 and one has none, and ``California`` rows sum the
counties. Counts and populations are bigint here, because they grow with the
tables.

The joins carry no hints: with small tables Spark broadcasts what it measures
to be small, with large ones it sort-merges, and adaptive execution splits a
join key that holds a large share of the rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseframe.operators.cleaning import split_county_state, with_prevalence
from caseframe.schema import STATE

ZERO_POPULATION_NATION = 13
NO_POPULATION_NATION = 17
FIRST_NATION_OFF_THE_MAP = 20

EARLY, LATE = (1995, 1997), (1999, 2001)
FIRST_TEST_YEAR = 2000
DISEASE = "Brand#11"
BEYOND_32_BITS = 3_000_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key and year of each order."""
    customer = _table(spark, sf_dir, "customer")
    return (
        _table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey", F.year("o_orderdate").alias("Year"))
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with brand, nation key and year."""
    return (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(order_places(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumnRenamed("p_brand", "Disease")
        .withColumn(
            "Sex",
            F.when(F.col("l_returnflag") == "A", "Male")
            .when(F.col("l_returnflag") == "N", "Female")
            .otherwise("Total"),
        )
    )


def populations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and population of each nation."""
    customers = (
        _table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.count("c_custkey").alias("customers"))
    )
    nation = F.col("n_nationkey")
    return (
        _table(spark, sf_dir, "nation")
        .join(customers, "n_nationkey", "left")
        .select(
            "n_nationkey",
            F.col("n_name").alias("County"),
            F.when(nation == ZERO_POPULATION_NATION, F.lit(0).cast("bigint"))
            .when(nation != NO_POPULATION_NATION, F.coalesce("customers", F.lit(0)) * 1000)
            .alias("Population"),
        )
    )


def county_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per disease, county, year and sex.

    Names and populations of the nations are joined to the groups, not to the
    line items: the wide shuffles carry the integer key only.
    """
    groups = (
        line_items(spark, sf_dir)
        .groupBy("Disease", F.col("c_nationkey").alias("n_nationkey"), "Year", "Sex")
        .agg(F.sum("l_quantity").cast("bigint").alias("Count"))
    )
    return groups.join(populations(spark, sf_dir), "n_nationkey").select(
        "Disease", "County", "Year", "Sex", "Count", "Population"
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County and state rows with the recomputed rate."""
    county = county_cases(spark, sf_dir)
    state = county.groupBy("Disease", "Year", "Sex").agg(
        F.sum("Count").alias("Count"), F.sum("Population").alias("Population")
    )
    return with_prevalence(county.unionByName(state.withColumn("County", F.lit(STATE))))


def county_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County half. The split prunes the state branch from the plan."""
    return split_county_state(cases(spark, sf_dir))[0]


def halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    year = F.col("Year")
    return rows.filter(year < FIRST_TEST_YEAR), rows.filter(year >= FIRST_TEST_YEAR)


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("n_nationkey")
    return (
        _table(spark, sf_dir, "nation")
        .filter(nation < FIRST_NATION_OFF_THE_MAP)
        .select(
            F.col("n_name").alias("County"),
            (30 + nation * 0.5).alias("latitude"),
            (-120 + nation * 0.25).alias("longitude"),
        )
    )


def with_stand_in(rows: DataFrame) -> DataFrame:
    """A made-up prediction that reaches all three bands."""
    number = F.regexp_extract("Disease", r"#(\d+)", 1).cast("int")
    return rows.withColumn(
        "prediction", F.col("Recalculated_Rate") * (number % 5) / 20 - 1
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw text record per line item, with gaps, zeros and bad tokens.

    No grouping: this is the map-only shape of the cleaning stage, at the full
    size of the largest table.
    """
    line = F.col("l_linenumber")

    def text(col):
        return col.cast("string")

    places = _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("County")
    )
    return line_items(spark, sf_dir).join(places, "c_nationkey").select(
        F.when(line == 1, F.concat(text(F.col("l_orderkey") * 10 + line), F.lit(".0")))
        .otherwise(text(F.col("l_orderkey") * 10 + line))
        .alias("_c0"),
        "Disease",
        F.when(line == 6, F.lit(STATE)).when(line != 5, F.col("County")).alias("County"),
        text(F.col("Year")).alias("Year"),
        "Sex",
        F.when(line == 2, F.lit("NA"))
        .when(line == 7, text(F.col("l_quantity").cast("bigint") + BEYOND_32_BITS))
        .otherwise(text(F.col("l_quantity") + 0.5))
        .alias("Count"),
        F.when(line == 3, F.lit("0"))
        .when(line != 4, text(F.col("p_size") * 1000))
        .alias("Population"),
        F.when(line == 2, F.lit("-")).otherwise(text(F.col("l_extendedprice"))).alias("Rate"),
        F.when(line == 3, F.lit("NaN")).otherwise(text(F.col("l_discount"))).alias("CI.lower"),
        F.when(line != 4, text(F.col("l_tax"))).alias("CI.upper"),
    )
