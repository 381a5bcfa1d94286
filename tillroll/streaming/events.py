"""Event-time windows with late rows kept aside, and session windows.

Windows: ``start_window_stream`` counts events in tumbling windows and writes a window once,
when it is final. The watermark before a trigger is the latest event time that earlier
triggers had, less the allowed delay. A row whose window ended at or before it comes too late
for the window's result; Spark's own streaming aggregation would drop it without a trace. Here
it goes to a side output, so that finals and late rows together hold every row.

Each trigger works from tables by its number, as in ``state_stream``: its rows' partial sums, the
latest event time, the windows that became final and the late rows. So a replayed trigger
overwrites what it wrote and a restart goes on; nothing depends on when triggers ran beyond
the watermark itself. Partial sums of windows that are final are not read again, as the
table is partitioned by day and old days fall behind the watermark.

Sessions: ``sessions`` groups the events of a user that are less than ``gap`` apart, in batch and
as a stream in append mode (a session is written when the watermark has passed its end).

Defined results: events with a null time belong to no window; they are late rows in the
stream and in no session; a null user or type is a group of its own; empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.session import path_exists

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
PARTIAL_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
    T.StructField("event_type", T.StringType()), T.StructField("events", T.LongType()),
    T.StructField("cents", T.LongType()), T.StructField("batch_id", T.LongType()),
    T.StructField("day", T.DateType()),
])
CLOCK_SCHEMA = T.StructType([T.StructField("latest", T.TimestampType()), T.StructField("batch_id", T.LongType())])


def cents(value: str = "value"):
    """Money in whole hundredths, so that sums do not depend on an order."""
    return F.round(F.col(value) * 100).cast("bigint")


def window_sums(events: DataFrame, width: str) -> DataFrame:
    """``window_start, window_end, event_type, events, cents`` of tumbling windows; sums that
    add up."""
    rows = events.where("ts is not null")
    sums = rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.coalesce(F.sum(cents()), F.lit(0)).alias("cents")
    )
    return sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "events", "cents")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """``user_id, session_start, session_end, events, cents``: events of a user with less
    than ``gap`` between neighbours; a session ends ``gap`` after its last event. A
    streaming ``events`` needs a watermark on ``ts``."""
    grouped = events.where("ts is not null").groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(
        F.count(F.lit(1)).alias("events"), F.coalesce(F.sum(cents()), F.lit(0)).alias("cents")
    )
    return grouped.select(
        "user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events", "cents"
    )


def streaming_events(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def start_session_stream(
    spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
    gap: str = "30 minutes", delay: str = "1 hour", available_now: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Sessions written once each, when the watermark has passed their end. A user's rows
    are merged to sessions within each task before the shuffle (Spark's setting), so a user
    with a third of all rows sends a few rows a task."""
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    events = streaming_events(spark, source_dir, max_files_per_trigger).withWatermark("ts", delay)
    writer = (
        sessions(events, gap).writeStream.outputMode("append").format("parquet")
        .option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_window_stream(
    spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
    width: str = "1 hour", delay: str = "2 hours", available_now: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Final windows go to ``<sink_dir>/windows``, late rows to ``<sink_dir>/late``, each under the
    trigger's number; the stream's own tables are beside the checkpoint."""
    state = f"{checkpoint_dir.rstrip('/')}-state"
    sink = sink_dir.rstrip("/")

    def stored(name: str, schema: T.StructType) -> DataFrame:
        if not path_exists(spark, f"{state}/{name}"):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{state}/{name}")

    def watermark(batch: int):
        """The watermark before a trigger; null if there is none yet."""
        latest = stored("clock", CLOCK_SCHEMA).where(F.col("batch_id") < batch).agg(
            (F.max("latest") - F.expr(f"interval {delay}")).alias("mark")
        )
        return latest.first()["mark"]

    def emit(batch: DataFrame, epoch_id: int) -> None:
        mark = F.lit(watermark(epoch_id)).cast("timestamp")
        rows = batch.withColumn("window_end", F.window("ts", width)["end"])
        is_late = F.col("ts").isNull() | F.coalesce(F.col("window_end") <= mark, F.lit(False))
        # F.window drops rows without a time, so the late ones among them are added again.
        late = rows.where(is_late).drop("window_end").unionByName(batch.where("ts is null"))
        late.write.mode("overwrite").parquet(f"{sink}/late/batch_id={epoch_id}")
        on_time = rows.where(~is_late)
        on_time.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{state}/clock/batch_id={epoch_id}")
        sums = window_sums(on_time, width).withColumn("day", F.to_date("window_start"))
        sums.write.mode("overwrite").partitionBy("day").parquet(f"{state}/partial/batch_id={epoch_id}")
        # Windows that ended after the watermark before this trigger and not after the next one.
        after = F.lit(watermark(epoch_id + 1)).cast("timestamp")
        partial = stored("partial", PARTIAL_SCHEMA).where(F.col("batch_id") <= epoch_id)
        due = partial.where(F.coalesce(F.col("window_end") > mark, F.lit(True)) & (F.col("window_end") <= after))
        due = due.where(F.col("day") >= F.coalesce(F.date_sub(F.to_date(mark - F.expr(f"interval {width}")), 1), F.col("day")))
        final = due.groupBy("window_start", "window_end", "event_type").agg(
            F.sum("events").alias("events"), F.sum("cents").alias("cents")
        )
        final.write.mode("overwrite").parquet(f"{sink}/windows/batch_id={epoch_id}")

    events = streaming_events(spark, source_dir, max_files_per_trigger)
    writer = events.writeStream.foreachBatch(emit).option("checkpointLocation", checkpoint_dir)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
