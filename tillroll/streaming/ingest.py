"""Reports kept current while raw sales text files keep arriving in a folder.

``start_report_stream`` reads the folder with the Structured Streaming file
source, parses lines with the same rules as the batch text source (O1), runs a
report's plan as a streaming aggregation, and writes each trigger's result to
the sink with that trigger's ``TimeStamp`` (O12) through ``foreachBatch``, one
``batch_id=<n>`` folder per trigger (a replayed trigger overwrites its folder).

Running totals live in the state store under the checkpoint location, so a
restarted query or a lost executor resumes from the last committed batch
instead of re-reading every file.

Only reports computed by one aggregation (sums, quarter-labelled months, the
scorecard, target totals) can run this way: Structured Streaming
does not support ``count(distinct)`` or an aggregation over the result of
another one, which the per-day averages and the mobile-completeness counts
need. Those stay batch reports, and so do the rankings: a sorted stream would
hold and rewrite about one group per line.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.plans.reports import REPORTS
from tillroll.schema import DEFAULT_EXCLUDED_YEAR
from tillroll.sources.sink import run_timestamp, write_report
from tillroll.sources.text import header_line, parse_sales_lines

STREAMABLE = (
    "daily_quantity",
    "daily_value",
    "quarter_quantity",
    "quarter_value",
    "category_quantity",
    "subcategory_quantity",
    "salesperson_quantity",
    "salesperson_value",
    "daily_category_scorecard",
    "pos_target",
    "zone_daily_quantity",
    "zone_daily_value",
    "zone_category_quantity",
    "zone_subcategory_quantity",
    "zone_salesperson_quantity",
    "zone_salesperson_value",
    "rep_daily_quantity",
    "rep_daily_value",
    "rep_contribution_value",
    "rep_contribution_quantity",
    "rep_category_quantity",
    "rep_subcategory_quantity",
)


def streaming_sales(
    spark: SparkSession,
    source_dir: str,
    header: str | None = None,
    mode: str = "strict",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming DataFrame of typed sale lines from text files in ``source_dir``.

    The header must be known up front (a stream has no "first line"); by
    default it is the standard header.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir)
    return parse_sales_lines(lines, header if header is not None else header_line(), mode)


def default_checkpoint(spark: SparkSession, report_name: str, source_dir: str, sink_dir: str) -> str:
    """A checkpoint folder for one (report, source, sink) under ``spark.checkpoint.dir``,
    the same in every session, so a restarted process resumes where it stopped. A
    folder made up for one session would not do, so without that setting a
    checkpoint folder must be given."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("give checkpoint_dir, or set spark.checkpoint.dir")
    key = hashlib.sha1(f"{report_name}|{source_dir}|{sink_dir}".encode()).hexdigest()[:16]
    return f"{shared.rstrip('/')}/stream-{report_name}-{key}"


def start_report_stream(
    spark: SparkSession,
    source_dir: str,
    report_name: str,
    sink_dir: str,
    checkpoint_dir: str | None = None,
    excluded_year: str = DEFAULT_EXCLUDED_YEAR,
    header: str | None = None,
    mode: str = "strict",
    output_mode: str = "update",
    fmt: str = "parquet",
    available_now: bool = False,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start keeping one report current; returns the running query.

    ``output_mode="update"`` writes the groups that a trigger changed;
    ``"complete"`` writes the whole report at every trigger, which grows with the
    number of groups. ``available_now=True`` processes the files present now and stops.
    ``max_files_per_trigger`` bounds the input of one trigger when a large
    backlog of files is waiting.
    """
    if report_name not in STREAMABLE:
        raise ValueError(f"report {report_name!r} cannot run as a stream; use a batch run")
    if output_mode not in ("complete", "update"):
        raise ValueError("output_mode must be 'complete' or 'update'")
    sales = streaming_sales(spark, source_dir, header, mode, max_files_per_trigger)
    report = REPORTS[report_name].run(sales, excluded_year)

    def emit(batch: DataFrame, epoch_id: int) -> None:
        # A batch replayed after a failure rewrites its own folder instead of
        # appending a second copy, so the sink holds each batch exactly once.
        target = f"{sink_dir.rstrip('/')}/batch_id={epoch_id}"
        write_report(batch, target, run_timestamp(), fmt=fmt, mode="overwrite")

    writer = (
        report.writeStream.outputMode(output_mode)
        .foreachBatch(emit)
        .option(
            "checkpointLocation",
            checkpoint_dir or default_checkpoint(spark, report_name, source_dir, sink_dir),
        )
        .queryName(f"tillroll_{report_name}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
