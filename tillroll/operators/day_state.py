"""O6 from a mergeable state: exact sets of trading days as bits.

The state of some sale lines has, per (pos_code, source_site, dims) and per stretch of 64
days, the sum of the quantity and one 64-bit word with a bit for each day that has a sale.
Sums add up and words are or-ed, so states of several batches, or of finer dims, merge
by an ordinary aggregate with a fixed-size buffer (map-side combined, in whole-stage
code), where ``count(distinct)`` has to see every (pair, date) again. One scan of the
lines gives both the totals by dims and the days of each pair.

The words are 64 days wide because most keys of a fine state have a few days only: the
32,768-day bitmaps of ``bitmap_construct_agg`` take 4 KB for each key, whatever it holds.
``as_bitmap`` gives that form for a pair's days where another system reads it.

The denominator counts distinct date texts. A text that is more than a plain day (a time
follows) is not a bit but a key of its own (``other_date``), so the count stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import day_of, float_ratio, int_ratio
from tillroll.operators.averages import JOIN_HASH, SITE_KEY

WORD_DAYS = 64
STATE_KEY = ("day_word", "other_date")


def _is_plain_day() -> Column:
    return F.length("sale_date") == 10


def trading_state(rows: DataFrame, dims: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """``pos_code, source_site, *dims, day_word, other_date, day_bits, quantity`` of sale
    lines that passed a report's row rules."""
    day = F.when(_is_plain_day(), F.unix_date(day_of("sale_date")))
    keyed = rows.select(
        *SITE_KEY, *dims, "quantity",
        F.floor(day / WORD_DAYS).cast("int").alias("day_word"),
        F.when(~_is_plain_day(), F.col("sale_date")).alias("other_date"),
        F.coalesce(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(WORD_DAYS))), F.lit(0)).alias("bit"),
    )
    return keyed.groupBy(*SITE_KEY, *dims, *STATE_KEY).agg(
        F.bit_or("bit").alias("day_bits"), F.sum("quantity").alias("quantity")
    )


def merge_states(states: DataFrame, dims: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One state of the rows of several (a union, or the state of finer dims)."""
    return states.groupBy(*SITE_KEY, *dims, *STATE_KEY).agg(
        F.bit_or("day_bits").alias("day_bits"), F.sum("quantity").alias("quantity")
    )


def days_of(state: DataFrame) -> DataFrame:
    """``pos_code, source_site, days``: the number of distinct sale dates of each pair."""
    words = state.groupBy(*SITE_KEY, *STATE_KEY).agg(F.bit_or("day_bits").alias("day_bits"))
    return words.groupBy(*SITE_KEY).agg(
        (F.sum(F.bit_count("day_bits")) + F.count("other_date")).alias("days")
    )


def as_bitmap(state: DataFrame) -> DataFrame:
    """``pos_code, source_site, bucket, days``: the plain days in Spark's bitmap form
    (``bitmap_count`` and ``bitmap_or_agg`` read it)."""
    place = F.explode(F.sequence(F.lit(0), F.lit(WORD_DAYS - 1)))
    bits = state.where("other_date is null").select(*SITE_KEY, "day_word", "day_bits", place.alias("place"))
    day = (F.col("day_word") * WORD_DAYS + F.col("place")).cast("bigint")
    held = bits.where(F.getbit("day_bits", "place") == 1).select(
        *SITE_KEY, F.bitmap_bucket_number(day).alias("bucket"), F.bitmap_bit_position(day).alias("position")
    )
    return held.groupBy(*SITE_KEY, "bucket").agg(F.bitmap_construct_agg("position").alias("days"))


def avg_per_day_of_state(
    state: DataFrame, dims: tuple[str, ...] | list[str] = (), mode: str = "int", alias: str = "QtnPerDay"
) -> DataFrame:
    """O6 (:func:`avg_per_day`) from a state of ``dims`` or finer ones."""
    ratio = int_ratio("qty", "days") if mode == "int" else float_ratio("qty", "days")
    totals = state.groupBy(*SITE_KEY, *dims).agg(F.sum("quantity").alias("qty"))
    # The hash in the key lets AQE split a hot pair, as in ``avg_per_day``.
    pair = F.xxhash64(*SITE_KEY)
    joined = totals.withColumn(JOIN_HASH, pair).join(
        days_of(state).withColumn(JOIN_HASH, pair), [*SITE_KEY, JOIN_HASH]
    )
    return joined.select(*SITE_KEY, *dims, ratio.alias(alias))
