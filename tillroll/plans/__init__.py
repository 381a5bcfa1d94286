"""Report catalogue, reference SQL, and the multi-report run."""

from tillroll.plans.reports import REPORTS, Report, report_names, run_report
from tillroll.plans.run import run_all

__all__ = ["REPORTS", "Report", "report_names", "run_all", "run_report"]
