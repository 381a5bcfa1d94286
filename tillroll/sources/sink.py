"""O12: append report rows to a sink, stamped with one run timestamp.

The source jobs collect every result to the driver and save one document per
Spark job. Here each report is one distributed write: executors write their
partitions directly, and every row of a run carries the same ``TimeStamp``.
Any DataFrame writer format works (parquet, json, orc, or a connector format
such as a document store when its package is on the classpath).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_timestamp() -> dt.datetime:
    """One instant per run (UTC, millisecond precision), taken on the driver."""
    now = dt.datetime.now(dt.timezone.utc)
    return now.replace(microsecond=now.microsecond // 1000 * 1000)


def utc(ts: dt.datetime) -> dt.datetime:
    """``ts`` in UTC; one without a zone is taken to be UTC already."""
    return ts.replace(tzinfo=dt.timezone.utc) if ts.tzinfo is None else ts.astimezone(dt.timezone.utc)


def stamp(report: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Add the run's ``TimeStamp`` column as the first column.

    The literal is built from epoch milliseconds, so neither the driver's zone
    nor the session's changes the instant.
    """
    millis = (utc(run_ts) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(milliseconds=1)
    return report.select(F.timestamp_millis(F.lit(millis)).alias("TimeStamp"), "*")


def with_row_ids(report: DataFrame, run: str, field: str) -> DataFrame:
    """An id for each row, the same whenever this run writes the row again: a digest of the
    run, the row and its number among rows equal to it.

    Stores without transactions keep what a failed task had written before it is retried.
    One that replaces documents by id ends up with every row once nevertheless. Rows
    are numbered among equal ones only, so the shuffle is dealt by the whole row."""
    columns = [F.col(c) for c in report.columns]
    number = F.row_number().over(Window.partitionBy(*columns).orderBy(F.lit(0)))
    row = F.to_json(F.struct(F.lit(run).alias("run"), number.alias("number"), F.struct(*columns).alias("row")), {"ignoreNullFields": "false"})
    return report.select("*", F.sha2(row, 256).alias(field))


def write_report(
    report: DataFrame,
    target: str | None,
    run_ts: dt.datetime | None = None,
    fmt: str = "parquet",
    mode: str = "append",
    options: dict[str, str] | None = None,
) -> dt.datetime:
    """Append one report under ``target``; returns the timestamp used.

    ``target=None`` is for formats addressed by options rather than a path
    (a document-store or JDBC connector, e.g. ``options={"collection": ...}``).
    """
    ts = run_ts or run_timestamp()
    writer = stamp(report, ts).write.format(fmt).mode(mode)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if target is None:
        writer.save()
    else:
        writer.save(target)
    return ts


def write_reports(
    reports: dict[str, DataFrame],
    root: str,
    run_ts: dt.datetime | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> dt.datetime:
    """Append several reports, each under ``root/<name>``, with one shared timestamp."""
    ts = run_ts or run_timestamp()
    for name, report in reports.items():
        write_report(report, os.path.join(root, name), ts, fmt=fmt, options=options)
    return ts
