"""Queries over the given tables that go beyond the report catalogue: reports from stored
aggregates and mergeable states, items ranked by place, figures in force, sales in
periods, event windows and sessions, two runs compared, and sketches by day.

Each takes (spark, tables folder) and returns a DataFrame; ``ANALYSES`` names them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import day_of
from tillroll.operators.asof import asof_join
from tillroll.operators.day_state import avg_per_day_of_state, merge_states, trading_state
from tillroll.operators.periods import join_periods
from tillroll.operators.reconcile import differences
from tillroll.operators.sketches import RANK_BOUND, daily_sketches, merged_bills, merged_quantiles
from tillroll.operators.top_groups import top_items_by
from tillroll.plans.lattice import NODE_OF, answer, store_lattice
from tillroll.plans.reports import GEO, REPORTS, named_averages
from tillroll.session import scratch_path
from tillroll.sources.tables import read_table, sales_from_tables, spread_lines
from tillroll.streaming.events import sessions, window_sums
from tillroll.streaming.state_stream import AVERAGES

#: As in the entry's checks: a year that the test tables hold.
CHECK_YEAR, OTHER_YEAR = "1998", "1999"
# Campaigns of a site: the first starts somewhere in 2400 days; their lengths in days.
CAMPAIGNS_FROM, CAMPAIGN_DAYS = "1995-01-01", (20, 200, 900)
SECOND, MICROSECOND = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS"

Query = Callable[[SparkSession, str], DataFrame]


def lattice_query(report: str) -> Query:
    """The report from its stored node, which is made from the sale lines first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_path(spark, "lattice")
        store_lattice(sales_from_tables(spark, sf_dir), folder, [NODE_OF[report]])
        return answer(spark, folder, report, CHECK_YEAR)

    run.__name__ = f"lattice_{report}"
    return run


def state_query(report: str) -> Query:
    """The average from two batches' states, of even and odd years, stored and merged."""
    dims, mode = AVERAGES[report]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = REPORTS[report].rows(sales_from_tables(spark, sf_dir), CHECK_YEAR)
        path = scratch_path(spark, "day-state")
        odd = F.col("sale_year").cast("int") % 2
        for batch in (0, 1):
            trading_state(rows.where(odd == batch), dims).write.parquet(f"{path}/batch={batch}")
        states = spark.read.parquet(path).drop("batch")
        return named_averages(report, avg_per_day_of_state(merge_states(states, dims), dims, mode))

    run.__name__ = f"state_{report}"
    return run


def top_items_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten items with the most sale lines of every site."""
    return top_items_by(spread_lines(sales_from_tables(spark, sf_dir)), GEO, 10)


def top_items_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best counts of every zone, with all items that tie."""
    return top_items_by(spread_lines(sales_from_tables(spark, sf_dir)), ("zone",), 3, "all")


def unit_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unit price of an item on the days on which it was shipped (the highest of a day)."""
    lines = read_table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_partkey").cast("string").alias("item_code"), F.to_date("l_shipdate").alias("price_day"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("bigint").alias("unit_price"),
    )


def dated_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_tables(spark, sf_dir).select(
        "bill_no", "item_code", "pos_code", "source_site", "quantity", day_of("sale_date").alias("sale_day")
    )


def unit_price_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale line with the last unit price of its item on or before its day."""
    rows = dated_sales(spark, sf_dir).drop("source_site")
    prices = unit_prices(spark, sf_dir)
    return asof_join(rows, prices, ("item_code",), "sale_day", "price_day", ("unit_price",), width=512)


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short, a medium and a long period of every site, from the supplier table."""
    sites = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("source_site"),
        F.posexplode(F.array(*(F.lit(d) for d in CAMPAIGN_DAYS))).alias("k", "days"),
    )
    first = F.date_add(F.lit(CAMPAIGNS_FROM).cast("date"), ((F.col("s_suppkey") * 131 + F.col("k") * 700) % 2400).cast("int"))
    return sites.select("source_site", F.col("k").alias("campaign"), first.alias("first_day"), "days", "s_suppkey").select(
        "source_site", "campaign", "first_day",
        F.date_add("first_day", (F.col("days") + F.col("s_suppkey") % 50).cast("int")).alias("last_day"),
    )


def sales_in_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale line with every campaign of its site that its day falls in."""
    rows = dated_sales(spark, sf_dir)
    return join_periods(rows, campaigns(spark, sf_dir), ("source_site",), "sale_day", "first_day", "last_day")


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their value by hour and type."""
    sums = window_sums(read_table(spark, sf_dir, "events"), "1 hour")
    return sums.withColumns({c: F.date_format(c, SECOND) for c in ("window_start", "window_end")})


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users, at half an hour without an event apart."""
    found = sessions(read_table(spark, sf_dir, "events"), "30 minutes")
    return found.withColumns({c: F.date_format(c, MICROSECOND) for c in ("session_start", "session_end")})


def reconciled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that two runs of a report, which leave out different years, do not share."""
    sales = sales_from_tables(spark, sf_dir)
    report = REPORTS["zone_category_quantity"]
    return differences(report.run(sales, CHECK_YEAR), report.run(sales, OTHER_YEAR))


def sketched_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact bills and lines of every zone, and whether the estimates from the sketches kept by
    day are as near as they promise."""
    lines = sales_from_tables(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    daily_sketches(lines.select("sale_date", "zone", "bill_no", "amount"), ("zone",)).write.parquet(path)
    kept = spark.read.parquet(path)
    estimates = merged_bills(kept, ("zone",)).withColumnRenamed("bills", "estimate").join(
        merged_quantiles(kept, ("zone",), (0.5,)), "zone"
    )
    # The estimates have one row per zone. A shuffle by zone would put a zone's lines into one task.
    exact = spread_lines(lines).join(F.broadcast(estimates), "zone").groupBy("zone").agg(
        F.countDistinct("bill_no").alias("bills"), F.count("amount").alias("lines"),
        F.first("estimate").alias("estimate"), F.first("bound").alias("bound"),
        F.count_if(F.col("amount") < F.col("quantiles")[0]).alias("below"),
        F.count_if(F.col("amount") <= F.col("quantiles")[0]).alias("up_to"),
    )
    half, off = F.col("lines") / 2, F.col("lines") * RANK_BOUND + 1
    return exact.select(
        "zone", "bills", (F.abs(F.col("estimate") - F.col("bills")) <= F.col("bound")).alias("bills_within_bound"), "lines",
        ((F.col("below") <= half + off) & (F.col("up_to") >= half - off)).alias("median_within_bound"),
    )


ANALYSES: dict[str, Query] = {
    **{f"lattice_{report}": lattice_query(report) for report in NODE_OF},
    **{f"state_{report}": state_query(report) for report in AVERAGES},
    **{
        f.__name__: f
        for f in (
            top_items_by_site, top_items_by_zone, unit_price_in_force, sales_in_campaigns, event_windows, user_sessions,
            reconciled_runs, sketched_zones,
        )
    },
}
