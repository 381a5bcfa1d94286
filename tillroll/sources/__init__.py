"""Sources and sinks: raw sales text, star-schema tables, written fact, report sink."""

from tillroll.sources.fact import read_sales_fact, write_sales_fact
from tillroll.sources.sink import run_timestamp, stamp, write_report, write_reports
from tillroll.sources.tables import read_table, sales_from_tables
from tillroll.sources.text import (
    header_line,
    parse_sales_lines,
    read_sales_text,
    rejected_lines,
    to_sales_lines,
    with_headers,
)

# O1 under its catalogue name.
read_sales = read_sales_text

__all__ = [
    "header_line",
    "parse_sales_lines",
    "read_sales",
    "read_sales_fact",
    "read_sales_text",
    "read_table",
    "rejected_lines",
    "run_timestamp",
    "sales_from_tables",
    "stamp",
    "to_sales_lines",
    "with_headers",
    "write_report",
    "write_reports",
    "write_sales_fact",
]
