"""Column expressions shared by the operators (all built-in, JVM-side)."""

from tillroll.functions.columns import (
    day_of,
    int_ratio,
    float_ratio,
    mobile_filled,
    mobile_label,
    month_text,
    non_empty,
    quarter_label,
    year_text,
)

__all__ = [
    "day_of",
    "int_ratio",
    "float_ratio",
    "mobile_filled",
    "mobile_label",
    "month_text",
    "non_empty",
    "quarter_label",
    "year_text",
]
