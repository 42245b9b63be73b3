"""Bar height and colour of a county on the map."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the map style.
HEIGHT_SPAN = 30_000
HEIGHT_FLOOR = 5_000
BLUE = 50
ALPHA = 180
FULL = 255.0


def share_of_maximum(rate: Column, maximum: Column) -> Column:
    """Rate relative to the maximum; a maximum that is not positive counts as 1."""
    return rate / F.when(maximum > 0, maximum).otherwise(F.lit(1.0))


def bar_height(share: Column) -> Column:
    return share * F.lit(HEIGHT_SPAN) + F.lit(HEIGHT_FLOOR)


def heat_colour(share: Column) -> Column:
    """``[red, green, blue, alpha]`` from green over yellow to red; null without a share.

    Red rises over the lower half of the range and green falls over the upper
    half; both are cut to whole numbers.
    """
    doubled = share * 2
    red = F.least(F.lit(FULL), doubled * FULL)
    green = F.when(
        share > 0.5, F.least(F.lit(FULL), (F.lit(2.0) - doubled) * FULL)
    ).otherwise(F.lit(FULL))
    return F.when(
        share.isNotNull(),
        F.array(red.cast("int"), green.cast("int"), F.lit(BLUE), F.lit(ALPHA)),
    )
