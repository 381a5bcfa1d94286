"""tillroll: retail sales reports as Spark DataFrame plans.

Typed sale lines come from raw sales text (``sources.read_sales_text``) or from
star-schema tables (``sources.sales_from_tables``); the report catalogue in
``plans.REPORTS`` turns them into report DataFrames built from the operators in
``operators``; ``sources.write_report`` appends results to a sink.
"""

from tillroll.plans import REPORTS, report_names, run_all, run_report
from tillroll.session import build_session, shared_dir

__all__ = ["REPORTS", "build_session", "report_names", "run_all", "run_report", "shared_dir"]
