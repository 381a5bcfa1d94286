"""The reusable report operators (O2-O11)."""

from tillroll.operators.averages import avg_per_day
from tillroll.operators.catalog import dimension_catalog
from tillroll.operators.contact import daily_category_scorecard, mobile_completeness
from tillroll.operators.filters import exclude_year, readable_rows, require_non_empty
from tillroll.operators.measures import measure_by, monthly_by_quarter
from tillroll.operators.ranking import top_items
from tillroll.operators.targets import pos_target_sum

__all__ = [
    "avg_per_day",
    "daily_category_scorecard",
    "dimension_catalog",
    "exclude_year",
    "measure_by",
    "mobile_completeness",
    "monthly_by_quarter",
    "pos_target_sum",
    "readable_rows",
    "require_non_empty",
    "top_items",
]
