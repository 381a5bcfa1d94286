"""Runs compared by digests equal exceptAll; sketches by day keep their bounds."""

from __future__ import annotations

import random

import pytest
from frames import frame, sale
from pyspark.sql import functions as F

from tillroll.operators.reconcile import LEFT, RIGHT, differences, differing_buckets, run_digest, surplus
from tillroll.operators.sketches import RANK_BOUND, RELATIVE_BOUND, daily_sketches, merged_bills, merged_quantiles
from tillroll.plans.inspect import plan_summary


def run(spark, rows):
    return spark.createDataFrame(rows, "a string, b int, c double")


def two_runs(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "y", None, ""]), rng.choice([1, 2, None]), rng.choice([0.5, None])) for _ in range(300)]
    hot = [("hot", 7, 1.0)] * 400
    left = rows + hot + [("only left", 1, 1.0)] * 2 + [(None, None, None)] * 3
    right = rows[:-20] + hot[:-1] + [("only right", None, 2.0), (None, None, None)]
    return run(spark, left).repartition(5), run(spark, right).repartition(3)


def listed(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_differences_equal_except_all(spark, buckets):
    left, right = two_runs(spark)
    found = differences(left, right, buckets)
    assert found.columns == ["a", "b", "c", LEFT, RIGHT]
    assert listed(surplus(found, LEFT)) == listed(left.exceptAll(right))
    assert listed(surplus(found, RIGHT)) == listed(right.exceptAll(left))


def test_kept_digests_and_columns_by_name(spark, scratch):
    left, right = two_runs(spark)
    run_digest(left).write.parquet(f"{scratch}/left")
    digest = spark.read.parquet(f"{scratch}/left")
    turned = right.select("c", "a", "b")
    assert listed(differences(left, turned, left_digest=digest)) == listed(differences(left, right))


def test_only_differing_buckets_are_compared(spark):
    rows = [(str(i), i, 0.0) for i in range(2000)]
    left, right = run(spark, rows), run(spark, rows[:-1] + [("changed", 1999, 0.0)])
    differ = differing_buckets(run_digest(left, 64), run_digest(right, 64))
    assert 1 <= differ.count() <= 2
    assert differences(left, right, 64).count() == 2


def test_equal_empty_and_unlike_runs(spark):
    left, _ = two_runs(spark)
    assert differing_buckets(run_digest(left), run_digest(left.repartition(9))).count() == 0
    assert differences(left, left).count() == 0
    assert differences(left.limit(0), left.limit(0)).count() == 0
    assert differences(left, left.limit(0)).agg(F.sum(LEFT)).first()[0] == left.count()
    with pytest.raises(ValueError):
        differences(left, left.drop("a"))


def test_nulls_in_other_places_differ(spark):
    assert differences(run(spark, [(None, 1, None)]), run(spark, [("", 1, None)])).count() == 2
    digests = [run_digest(spark.createDataFrame([r], "a int, b int")) for r in ((None, 5), (5, None))]
    assert differing_buckets(*digests).count() > 0


def test_rows_are_not_joined(spark):
    left, right = two_runs(spark)
    # The one join is with the differing buckets' numbers, which go to every task.
    summary = plan_summary(differences(left, right))
    assert summary["joins"] <= 2 and summary["broadcasts"] == summary["joins"]


# Sketches


def test_merged_sketches_are_within_their_bounds(spark, oracle_sales, scratch):
    daily_sketches(oracle_sales, ("zone", "state")).write.parquet(f"{scratch}/sketches")
    kept = spark.read.parquet(f"{scratch}/sketches")
    for by in (("zone",), ("zone", "state")):
        exact = {tuple(r)[:-1]: r["n"] for r in oracle_sales.groupBy(*by).agg(F.countDistinct("bill_no").alias("n")).collect()}
        for r in merged_bills(kept, by).collect():
            n = exact[tuple(r[c] for c in by)]
            assert abs(r["bills"] - n) <= r["bound"] <= 1 + RELATIVE_BOUND * 1.06 * n
    amounts = sorted(r[0] for r in oracle_sales.select("amount").collect())
    shares = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = merged_quantiles(kept.withColumn("all", F.lit(1)), ("all",), shares).first()["quantiles"]
    for share, value in zip(shares, got, strict=True):
        below = sum(a < value for a in amounts) / len(amounts)
        up_to = sum(a <= value for a in amounts) / len(amounts)
        assert below - RANK_BOUND <= share <= up_to + RANK_BOUND


def test_sketches_of_batches_merge_and_nulls_do_not_count(spark):
    rows = [sale(bill_no=str(i % 50), amount=i, sale_date=f"0{1 + i % 3}-01-2017") for i in range(200)]
    parts = [daily_sketches(frame(spark, *rows[:90]), ("zone",)), daily_sketches(frame(spark, *rows[90:]), ("zone",))]
    merged = merged_bills(parts[0].unionByName(parts[1]), ("zone",)).first()
    assert merged["bills"] == 50
    none = daily_sketches(frame(spark, sale(bill_no=None, amount=None)), ("zone",))
    assert merged_bills(none, ("zone",)).first()["bills"] == 0
    assert merged_bills(daily_sketches(frame(spark), ("zone",)), ("zone",)).count() == 0
