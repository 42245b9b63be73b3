"""Column expressions. All are native Spark functions, so they stay in codegen."""

from caseframe.functions.casting import (
    is_number,
    lenient_double,
    lenient_int,
    lenient_long,
    whole_number,
)
from caseframe.functions.colours import bar_height, heat_colour
from caseframe.functions.levels import clamp_rate, priority
from caseframe.functions.rates import mean_rate, percent_growth, prevalence

__all__ = [
    "bar_height",
    "clamp_rate",
    "heat_colour",
    "is_number",
    "lenient_double",
    "lenient_int",
    "lenient_long",
    "mean_rate",
    "percent_growth",
    "prevalence",
    "priority",
    "whole_number",
]
