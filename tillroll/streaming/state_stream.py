"""Averages per day and mobile completeness as streams, from state kept in tables.

Both need a distinct count below an aggregate, which one streaming aggregation cannot do. Here each
trigger turns its own lines into a mergeable state and adds it to a table under
``state_dir``; the report is computed from the table:

* averages (O6): ``trading_state`` of the trigger's lines, 64-bit day words and sums. Every
  ``merge_every`` triggers the states so far are merged into one, so a report reads one
  merged state and the few after it, whatever the age of the stream;
* completeness (O7): the trigger's distinct (bill, dims, mobile) that no earlier trigger
  had, by an anti-join with those seen, and their counts by label. The report adds up
  the counts. An exact count has to keep what it has seen, so this table grows with the bills.

Nothing is held in the memory of a task or of the driver between triggers. Each trigger
writes folders named by its number, reads only those of earlier triggers, and overwrites
its own when it is replayed after a failure; so results do not depend on retries, and a
restarted process goes on from the checkpoint and the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions import mobile_filled, mobile_label
from tillroll.operators.averages import SITE_KEY
from tillroll.operators.day_state import avg_per_day_of_state, merge_states, trading_state
from tillroll.plans.reports import GEO, REP, REPORTS, named_averages, named_completeness
from tillroll.schema import DEFAULT_EXCLUDED_YEAR, SALES_SCHEMA
from tillroll.session import path_exists
from tillroll.sources.sink import run_timestamp, write_report
from tillroll.streaming.ingest import default_checkpoint, streaming_sales

#: Report: its dims beyond the pair, and the kind of its ratio.
AVERAGES = {
    "avg_quantity_per_day": ((), "int"),
    "zone_avg_quantity_per_day": (("city", "state", "zone"), "int"),
    "rep_avg_quantity_per_day": (REP, "float"),
}
COMPLETENESS = {"mobile_completeness": (), "zone_mobile_completeness": GEO, "rep_mobile_completeness": REP}
STATE_STREAMABLE = (*AVERAGES, *COMPLETENESS)


def _state_schema(dims: tuple[str, ...]) -> T.StructType:
    text = [T.StructField(c, T.StringType()) for c in (*SITE_KEY, *dims)]
    return T.StructType([
        *text, T.StructField("day_word", T.IntegerType()), T.StructField("other_date", T.StringType()),
        T.StructField("day_bits", T.LongType()), T.StructField("quantity", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ])


class _Tables:
    """Folders ``<dir>/<name>/batch_id=<n>`` of one stream."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, rows: DataFrame, name: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch_id={batch}")

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)


def _averages(tables: _Tables, rows: DataFrame, batch: int, name: str, merge_every: int) -> DataFrame:
    dims, mode = AVERAGES[name]
    schema = _state_schema(dims)
    tables.write(trading_state(rows, dims), "state", batch)
    # States are merged at triggers merge_every - 1, 2 * merge_every - 1, ...
    merged_at = (batch + 1) // merge_every * merge_every - 1
    before = merged_at - merge_every
    if batch == merged_at:
        so_far = tables.read("merged", schema).where(F.col("batch_id") == before).unionByName(
            tables.read("state", schema).where((F.col("batch_id") > before) & (F.col("batch_id") <= batch))
        )
        tables.write(merge_states(so_far, dims), "merged", batch)
    state = tables.read("merged", schema).where(F.col("batch_id") == merged_at).unionByName(
        tables.read("state", schema).where((F.col("batch_id") > merged_at) & (F.col("batch_id") <= batch))
    )
    return named_averages(name, avg_per_day_of_state(state, dims, mode))


def _completeness(tables: _Tables, rows: DataFrame, batch: int, name: str) -> DataFrame:
    dims = COMPLETENESS[name]
    fields = ("bill_no", *dims, "customer_mobile")
    text = [T.StructField(c, T.StringType()) for c in fields]
    seen_schema = T.StructType([*text, T.StructField("batch_id", T.LongType())])
    own = rows.select(*fields).distinct()
    seen = tables.read("bills", seen_schema).where(F.col("batch_id") < batch)
    # Fields may be null: null-safe equality, which Spark joins by hash or sort as well.
    same = [own[c].eqNullSafe(seen[c]) for c in fields]
    tables.write(own.join(seen, same, "left_anti"), "bills", batch)
    new = tables.read("bills", seen_schema).where(F.col("batch_id") == batch)
    labelled = new.select(*dims, mobile_label(mobile_filled("customer_mobile")).alias("CustomerMobile"))
    tables.write(labelled.groupBy(*dims, "CustomerMobile").agg(F.count(F.lit(1)).alias("Count")), "counts", batch)
    counts_schema = T.StructType([
        *(T.StructField(c, T.StringType()) for c in (*dims, "CustomerMobile")),
        T.StructField("Count", T.LongType()), T.StructField("batch_id", T.LongType()),
    ])
    counts = tables.read("counts", counts_schema).where(F.col("batch_id") <= batch)
    return named_completeness(name, counts.groupBy(*dims, "CustomerMobile").agg(F.sum("Count").alias("Count")))


def start_state_stream(
    spark: SparkSession,
    source_dir: str,
    report_name: str,
    sink_dir: str,
    state_dir: str | None = None,
    checkpoint_dir: str | None = None,
    excluded_year: str = DEFAULT_EXCLUDED_YEAR,
    header: str | None = None,
    mode: str = "strict",
    fmt: str = "parquet",
    available_now: bool = False,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    merge_every: int = 16,
) -> StreamingQuery:
    """Keep an average or completeness report current; each trigger writes the whole report to
    ``<sink_dir>/batch_id=<n>``. ``state_dir`` defaults to a folder in the checkpoint's, and
    belongs to this stream alone."""
    if report_name not in STATE_STREAMABLE:
        raise ValueError(f"report {report_name!r} is not kept by state tables")
    if merge_every < 1:
        raise ValueError("merge_every must be at least 1")
    checkpoint = checkpoint_dir or default_checkpoint(spark, report_name, source_dir, sink_dir)
    tables = _Tables(spark, state_dir or f"{checkpoint.rstrip('/')}-state")
    sales = streaming_sales(spark, source_dir, header, mode, max_files_per_trigger)

    def emit(batch: DataFrame, epoch_id: int) -> None:
        rows = REPORTS[report_name].rows(batch.select(*SALES_SCHEMA.names), excluded_year)
        if report_name in AVERAGES:
            report = _averages(tables, rows, epoch_id, report_name, merge_every)
        else:
            report = _completeness(tables, rows, epoch_id, report_name)
        write_report(report, f"{sink_dir.rstrip('/')}/batch_id={epoch_id}", run_timestamp(), fmt=fmt, mode="overwrite")

    writer = sales.writeStream.foreachBatch(emit).option("checkpointLocation", checkpoint).queryName(f"tillroll_{report_name}")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
