"""County coordinates and the map layer."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseframe.functions import bar_height, heat_colour
from caseframe.functions.colours import share_of_maximum
from caseframe.schema import COORDINATES

# Centre of each of the 58 counties (latitude, longitude).
COUNTY_CENTRES = [
    ("Alameda", 37.65, -121.92),
    ("Alpine", 38.60, -119.82),
    ("Amador", 38.45, -120.65),
    ("Butte", 39.67, -121.60),
    ("Calaveras", 38.20, -120.55),
    ("Colusa", 39.18, -122.24),
    ("Contra Costa", 37.93, -121.93),
    ("Del Norte", 41.74, -124.00),
    ("El Dorado", 38.78, -120.53),
    ("Fresno", 36.75, -119.65),
    ("Glenn", 39.59, -122.39),
    ("Humboldt", 40.70, -123.93),
    ("Imperial", 33.04, -115.35),
    ("Inyo", 36.51, -117.41),
    ("Kern", 35.34, -118.96),
    ("Kings", 36.07, -119.82),
    ("Lake", 39.05, -122.75),
    ("Lassen", 40.67, -120.59),
    ("Los Angeles", 34.31, -118.22),
    ("Madera", 37.22, -119.76),
    ("Marin", 38.07, -122.75),
    ("Mariposa", 37.58, -119.91),
    ("Mendocino", 39.44, -123.43),
    ("Merced", 37.19, -120.72),
    ("Modoc", 41.59, -120.72),
    ("Mono", 37.92, -118.89),
    ("Monterey", 36.24, -121.32),
    ("Napa", 38.51, -122.33),
    ("Nevada", 39.30, -120.77),
    ("Orange", 33.68, -117.78),
    ("Placer", 39.06, -120.75),
    ("Plumas", 40.01, -120.84),
    ("Riverside", 33.74, -115.99),
    ("Sacramento", 38.45, -121.34),
    ("San Benito", 36.61, -121.08),
    ("San Bernardino", 34.84, -116.18),
    ("San Diego", 33.03, -116.74),
    ("San Francisco", 37.77, -122.44),
    ("San Joaquin", 37.93, -121.27),
    ("San Luis Obispo", 35.39, -120.45),
    ("San Mateo", 37.42, -122.33),
    ("Santa Barbara", 34.65, -120.02),
    ("Santa Clara", 37.20, -121.69),
    ("Santa Cruz", 37.02, -122.01),
    ("Shasta", 40.76, -122.04),
    ("Sierra", 39.58, -120.50),
    ("Siskiyou", 41.59, -122.62),
    ("Solano", 38.27, -121.94),
    ("Sonoma", 38.53, -122.92),
    ("Stanislaus", 37.56, -121.00),
    ("Sutter", 39.03, -121.69),
    ("Tehama", 40.13, -122.23),
    ("Trinity", 40.65, -123.11),
    ("Tulare", 36.23, -118.80),
    ("Tuolumne", 38.03, -119.95),
    ("Ventura", 34.46, -119.08),
    ("Yolo", 38.69, -121.90),
    ("Yuba", 39.27, -121.35),
]


def county_centres(spark: SparkSession) -> DataFrame:
    """The fixed table above; its 58 rows may always be broadcast.

    Written as SQL values, the rows are part of the plan and need no Python
    worker to unpack them.
    """
    values = ", ".join(f"('{name}', {lat}D, {lon}D)" for name, lat, lon in COUNTY_CENTRES)
    names = ", ".join(COORDINATES.names)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS centres({names})"))


def with_coordinates(df: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Adds latitude and longitude; rows of places without them drop out.

    No hint here: a table of the caller's is broadcast only if Spark finds it
    small enough.
    """
    known = coordinates.filter(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    return df.join(known, "County", "inner")


def county_means(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("County").isNotNull())
        .groupBy("County")
        .agg(
            F.sum("Count").alias("Total_Count"),
            F.avg("Recalculated_Rate").alias("Mean_Rate"),
            F.avg("Population").alias("Population"),
        )
    )


def map_layer(df: DataFrame, coordinates: DataFrame) -> DataFrame:
    """One row per county on the map, with bar height and colour.

    Both are relative to the highest mean rate on the map: a window over the
    rows left after the grouping and the join, one per place of the coordinates
    table. That table is a list of places drawn on one map, so one task holds it;
    the input is read once.
    """
    return drawn(county_means(df), coordinates)


def drawn(means: DataFrame, coordinates: DataFrame) -> DataFrame:
    """The map layer of counties with their ``Mean_Rate``, one row each."""
    placed = with_coordinates(means, coordinates)
    highest = F.max("Mean_Rate").over(Window.partitionBy())
    share = share_of_maximum(F.col("Mean_Rate"), highest)
    return (
        placed.withColumn("share", share)
        .withColumns(
            {"height": bar_height(F.col("share")), "color": heat_colour(F.col("share"))}
        )
        .drop("share")
    )
