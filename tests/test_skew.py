"""One key holding a third of all rows: results stay exact and whole, and the
join of the per-day averages gets split by AQE instead of landing in one task."""

from __future__ import annotations

import os

import pytest
from compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillroll.operators import avg_per_day
from tillroll.plans.inspect import plan_text
from sales_oracle import _bodies
from tillroll.plans.reports import REPORTS
from tillroll.sources import read_sales_fact, write_sales_fact

YEAR = entry.CHECK_YEAR


@pytest.fixture(scope="module")
def skewed(spark, oracle_sales, tmp_path_factory):
    """The sf0.01 sale lines with one (pos, site, city, state, zone) and one rep on a third of the rows."""
    df = oracle_sales.withColumn("hot", F.pmod(F.xxhash64("bill_no", "pos_code"), F.lit(3)) == 0)
    hot = F.col("hot")
    for col, value in [("pos_code", "HOT-POS"), ("source_site", "HOT-SITE"), ("city", "HOT-CITY"),
                       ("state", "HOT-STATE"), ("zone", "HOT-ZONE"), ("rep_id", "99"),
                       ("rep_name", "Rep-99")]:
        df = df.withColumn(col, F.when(hot, F.lit(value)).otherwise(F.col(col)))
    path = write_sales_fact(df.drop("hot"), str(tmp_path_factory.mktemp("skew") / "fact"))
    return path


@pytest.fixture(scope="module")
def skew_duck(skewed):
    import duckdb

    con = duckdb.connect()
    con.execute(
        f"create view sales as select * exclude (sale_year, bad_fields) "
        f"from read_parquet('{os.path.join(skewed, '**', '*.parquet')}', hive_partitioning = true)"
    )
    return con


def test_hot_key_really_holds_a_third(spark, skewed):
    fact = read_sales_fact(spark, skewed)
    share = fact.filter(F.col("source_site") == "HOT-SITE").count() / fact.count()
    assert 0.3 < share < 0.37


@pytest.mark.parametrize("name", list(REPORTS))
def test_report_exact_under_skew(name, spark, skewed, skew_duck):
    fact = read_sales_fact(spark, skewed)
    df = REPORTS[name].run(fact, YEAR)
    assert compare(df, skew_duck, _bodies(YEAR)[name]) is None


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.files.openCostInBytes": "16KB",
    "spark.sql.files.maxPartitionBytes": "256KB",
}


@pytest.fixture()
def splitting(spark):
    """Shuffle joins only, and partitions of a few KB count as skewed."""
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_average_join_splits_a_hot_pair(spark, skewed, skew_duck, splitting):
    # With the item among the dims the hot pair has a third of the join's rows.
    dims = ("rep_id", "rep_name", "promo_name", "category", "item_code")
    df = avg_per_day(read_sales_fact(spark, skewed), dims, "float", "r")
    keys = ", ".join(("pos_code", "source_site", *dims))
    sql = f"""select {keys}, cast(qty as float) / cast(days as float) as r
        from (select {keys}, sum(quantity) as qty from sales group by all)
        join (select pos_code, source_site, count(distinct sale_date) as days from sales group by all)
        using (pos_code, source_site)"""
    assert compare(df, skew_duck, sql) is None
    final = plan_text(df, "simple")
    assert "SortMergeJoin(skew=true)" in final
    assert "Generate explode" not in final


@pytest.mark.parametrize("table,column,key", [
    ("lineitem", "l_suppkey", 7), ("lineitem", "l_partkey", 11), ("lineitem", "l_orderkey", None),
    ("orders", "o_custkey", 3),
])
def test_fact_build_splits_a_hot_key(spark, tmp_path, splitting, table, column, key):
    import duckdb

    from sales_oracle import SALES_CTE
    from tillroll.sources.tables import read_table, sales_from_tables

    src = "/root/testdata/sf0.01"
    out = str(tmp_path / "tables")
    names = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")
    for name in names:
        frame = read_table(spark, src, name)
        if name == table:
            if key is None:
                key = frame.agg(F.min(column)).first()[0]
            hot = F.pmod(F.xxhash64(*frame.columns), F.lit(3)) == 0
            frame = frame.withColumn(column, F.when(hot, F.lit(key).cast("bigint")).otherwise(F.col(column)))
        # Several files, so that the scan has several tasks whose output can be split.
        frame.repartition(8).write.parquet(f"{out}/{name}.parquet")
    sales = sales_from_tables(spark, out)
    sales.collect()
    assert "SortMergeJoin(skew=true)" in plan_text(sales, "simple")
    con = duckdb.connect()
    for name in names:
        con.execute(f"create view {name} as select * from read_parquet('{out}/{name}.parquet/*.parquet')")
    assert compare(sales.drop("sale_year", "bad_fields"), con, SALES_CTE + "select * from sales") is None
