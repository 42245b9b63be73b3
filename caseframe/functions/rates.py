"""Rates per 100,000, their means, and relative change."""

from pyspark.sql import Column
from pyspark.sql import functions as F

PER = 100_000


def prevalence(count: Column, population: Column) -> Column:
    """Cases per 100,000 inhabitants; 0 when the population is 0 or unknown."""
    return F.when(
        population > 0, F.round(count / population * F.lit(PER), 3)
    ).otherwise(F.lit(0.0))


def mean_rate(name: str = "Recalculated_Rate", digits: int | None = 2) -> Column:
    mean = F.avg(name)
    return mean if digits is None else F.round(mean, digits)


def percent_growth(before: Column, after: Column) -> Column:
    """Change in percent; a base that is not positive counts as 1."""
    base = F.when(before > 0, before).otherwise(F.lit(1))
    return (after - before) / base * F.lit(100)
