"""Sale lines derived from the star-schema tables (lineitem, orders, ...).

The test data ships as TPC-H-like parquet tables rather than the flat sales
text. ``sales_from_tables`` derives one sale line per ``lineitem`` row with the
same typed columns that :func:`tillroll.sources.text.read_sales_text` yields.

Scale notes: every table is read with only the columns it contributes, so the
parquet scans prune columns. The two small geography tables are joined to
``supplier`` first (a dimension-side join); ``customer`` is joined to
``orders`` before the fact meets them. No side is hinted for broadcast: the
planner broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime) and uses a
shuffle join otherwise, so the plan holds when ``supplier`` or ``part`` grow to
billions of rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import year_text
from tillroll.schema import BAD_FIELDS, SALES_COLUMNS


def read_table(spark: SparkSession, tables_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(tables_dir, f"{name}.parquet"))


def _text(c) -> F.Column:
    return c.cast(T.StringType())


def sales_from_tables(spark: SparkSession, tables_dir: str) -> DataFrame:
    """One typed sale line per lineitem row (see FIXTURES.md §3)."""
    li = read_table(spark, tables_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
    )
    orders = read_table(spark, tables_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, tables_dir, "customer").select("c_custkey")
    part = read_table(spark, tables_dir, "part").select(
        "p_partkey", "p_type", "p_brand", "p_size"
    )
    supplier = read_table(spark, tables_dir, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal"
    )
    nation = read_table(spark, tables_dir, "nation").select(
        "n_nationkey", "n_name", "n_regionkey"
    )
    region = read_table(spark, tables_dir, "region").select("r_regionkey", "r_name")

    sites = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    bills = orders.join(customer, orders.o_custkey == customer.c_custkey)

    joined = (
        li.join(bills, li.l_orderkey == bills.o_orderkey)
        .join(part, li.l_partkey == part.p_partkey)
        .join(sites, li.l_suppkey == sites.s_suppkey)
    )

    # After the inner join c_custkey equals o_custkey; using the orders column
    # lets the planner drop c_custkey before the lineitem-sized shuffles.
    cust = F.col("o_custkey")
    rep = F.col("o_custkey") % 37
    mobile = F.when(cust % 6 == 0, F.lit("")).otherwise(
        F.lpad(_text(cust), (F.lit(8) + cust % 6).cast(T.IntegerType()), "9")
    )
    # Lines that the zero policies act on: one rep and some items have only zero
    # measures (groups of nothing but zero lines), and another rep's measures
    # alternate in sign (groups that cancel to zero without a zero line).
    item_is_free = F.col("p_partkey") % 97 == 0
    only_zeros = item_is_free | (rep == 36)
    sign = F.lit(1) - 2 * (F.col("l_linenumber") % 2)

    def measure(cancelling: int, usual: F.Column) -> F.Column:
        return (
            F.when(only_zeros, F.lit(0)).when(rep == 35, sign * cancelling).otherwise(usual).cast(T.LongType())
        )

    quantity = F.when(
        (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.lit(0)
    ).otherwise(F.floor("l_quantity"))
    sale_date = F.date_format("o_orderdate", "dd-MM-yyyy")

    sales = joined.select(
        _text(F.col("s_suppkey") * 10 + F.col("l_linenumber") % 3).alias("pos_code"),
        sale_date.alias("sale_date"),
        _text(F.col("o_orderkey")).alias("bill_no"),
        F.col("s_name").alias("source_site"),
        mobile.alias("customer_mobile"),
        _text(rep).alias("rep_id"),
        F.concat(F.lit("Rep-"), _text(rep)).alias("rep_name"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
        .otherwise(F.col("o_orderpriority"))
        .alias("promo_name"),
        F.when(item_is_free, F.lit("GIVEAWAY")).otherwise(F.col("p_type")).alias("category"),
        F.when(item_is_free, F.lit("GIVEAWAY")).otherwise(F.col("p_brand")).alias("sub_category"),
        _text(F.col("p_partkey")).alias("item_code"),
        F.col("l_returnflag").alias("item_attr"),
        measure(1, quantity).alias("quantity"),
        measure(100, F.floor("l_extendedprice")).alias("amount"),
        measure(90, F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("measure_19"),
        F.concat(F.col("n_name"), F.lit("-"), _text(F.col("s_suppkey") % 3)).alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("zone"),
        F.floor("s_acctbal").cast(T.LongType()).alias("pos_target"),
        _text(F.col("p_size")).alias("field_28"),
    )
    sales = sales.withColumn(BAD_FIELDS, F.lit(None).cast(T.StringType()))
    return sales.withColumn("sale_year", year_text("sale_date")).select(*SALES_COLUMNS)


def spread_lines(sales: DataFrame) -> DataFrame:
    """The same sale lines, dealt anew by bill and item, for aggregates with about one group per line.

    Such an aggregate holds a group for each line of its task. Right after the joins it would share the task
    with the joins' sorts, and the task's size is measured before the joins widen the lines. Dealt anew,
    the lines are measured as they are aggregated, and the joins' memory is free by then. No aggregate
    has both among its keys, so a group holding many lines is still many tasks, and AQE splits
    what is larger than its advisory size.
    """
    return sales.hint("rebalance", "bill_no", "item_code")
