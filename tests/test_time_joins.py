"""Items by place, figures in force, periods: against brute force, with hot keys."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from compare import compare
from frames import frame, sale

import __spark_entry__ as entry
from tillroll.operators.asof import asof_join
from tillroll.operators.periods import join_periods
from tillroll.operators.top_groups import top_items_by
from tillroll.plans.analyses import ANALYSES
from tillroll.plans.inspect import plan_text

SF = "/root/testdata/sf0.01"
SQL = entry.oracle_sql()


# The other stored aggregates are held against the reports in test_lattice.
CHECKED = [n for n in ANALYSES if not n.startswith("lattice_")] + ["lattice_category_quantity", "lattice_quarter_value"]


@pytest.mark.parametrize("name", CHECKED)
def test_matches_oracle(spark, duck, name):
    assert compare(ANALYSES[name](spark, SF), duck, SQL[name]) is None


def no_nested_loops(df):
    plan = plan_text(df)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    return plan


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


# Items by place


def test_top_items_ties_and_a_hot_place(spark):
    rows = [sale(zone="hot", item_code=f"I{i}") for i in range(300) for _ in range(1 + i % 4)]
    rows += [sale(zone="cold", item_code="A"), sale(zone="cold", item_code="B"), sale(zone=None, item_code="C")]
    lines = frame(spark, *rows).repartition(7)
    by_key = top_items_by(lines, ("zone",), 3)
    assert [(r["zone"], r["rank"], r["item_code"], r["Quantity"]) for r in by_key.orderBy("zone", "rank").collect()] == [
        (None, 1, "C", 1), ("cold", 1, "A", 1), ("cold", 2, "B", 1), ("hot", 1, "I103", 4), ("hot", 2, "I107", 4), ("hot", 3, "I11", 4),
    ]
    shared = top_items_by(lines, ("zone",), 1, "all").where("zone = 'hot'")
    assert shared.count() == 75 and {r["Quantity"] for r in shared.collect()} == {4}
    assert top_items_by(frame(spark), ("zone",)).count() == 0
    with pytest.raises(ValueError):
        top_items_by(lines, ("zone",), 3, "some")
    with pytest.raises(ValueError):
        top_items_by(lines, ())


def test_the_group_limit_comes_before_the_shuffle(spark):
    plan = plan_text(top_items_by(frame(spark, sale()), ("zone",), 3))
    tree = plan.split("\n\n")[0]
    limits = [i for i, line in enumerate(tree.splitlines()) if "WindowGroupLimit" in line]
    shuffles = [i for i, line in enumerate(tree.splitlines()) if "Exchange" in line]
    assert len(limits) == 2 and limits[0] < shuffles[0] < limits[1]


# Figures in force


def brute_asof(rows, figures):
    out = []
    for i, k, t in rows:
        held = [(ft, v) for fk, ft, v in figures if None not in (k, t, fk, ft) and fk == k and ft <= t]
        out.append((i, k, t, *(max(held, key=lambda x: (x[0], x[1] is not None, x[1] or 0)) if held else (None, None))))
    return out


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_figures_in_force(spark, width):
    rng = random.Random(width)
    keys = ["hot"] * 20 + ["a", "b", "c", None]
    rows = [(i, rng.choice(keys), rng.choice([None, *range(-50, 300)])) for i in range(500)]
    figures = [(rng.choice(keys), rng.choice([None, *range(-40, 200)]), rng.choice([None, 1, 2, 3])) for _ in range(60)]
    left = spark.createDataFrame(rows, "id int, k string, t int").repartition(5)
    right = spark.createDataFrame(figures, "k string, since int, v int").repartition(3)
    got = asof_join(left, right, ("k",), "t", "since", ("v",), width=width, prefix="f_")
    assert got.columns == ["id", "k", "t", "f_since", "f_v"]
    assert tuples(got) == sorted(brute_asof(rows, figures), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert "Join" not in no_nested_loops(got).split("\n\n")[0]


def test_figures_by_date_and_empty_sides(spark):
    day = dt.date(2017, 1, 31)
    left = spark.createDataFrame([("a", day), ("a", day), ("b", day)], "k string, d date")
    right = spark.createDataFrame([("a", dt.date(1969, 5, 1), 4), ("a", dt.date(2017, 2, 1), 5)], "k string, since date, v int")
    got = asof_join(left, right, ("k",), "d", "since", ("v",))
    assert tuples(got) == [("a", day, dt.date(1969, 5, 1), 4)] * 2 + [("b", day, None, None)]
    assert asof_join(left.limit(0), right, ("k",), "d", "since", ("v",)).count() == 0
    assert {r["v"] for r in asof_join(left, right.limit(0), ("k",), "d", "since", ("v",)).collect()} == {None}


# Periods


def brute_periods(rows, periods):
    return [
        (*r, *p[1:]) for r in rows for p in periods
        if None not in (r[1], r[2], *p[:3]) and r[1] == p[0] and p[1] <= r[2] <= p[2]
    ]


@pytest.mark.parametrize("width, levels", [(1, 3), (16, 5), (1000, 1)])
def test_rows_in_periods(spark, width, levels):
    rng = random.Random(width)
    keys = ["hot"] * 20 + ["a", "b", None]
    rows = [(i, rng.choice(keys), rng.choice([None, *range(-50, 300)])) for i in range(300)]
    rows += [(1000 + i, "hot", 7) for i in range(200)]  # one bin with most rows
    periods = []
    for n in range(80):
        start = rng.choice([None, *range(-60, 320)])
        size = rng.choice([0, 1, 5, 40, 9000, -3])
        periods.append((rng.choice(keys), start, None if start is None else start + size, n % 60))
    left = spark.createDataFrame(rows, "id int, k string, t int").repartition(5)
    right = spark.createDataFrame(periods, "k string, first int, last int, p int").repartition(3)
    got = join_periods(left, right, ("k",), "t", "first", "last", width=width, levels=levels, prefix="p_")
    assert got.columns == ["id", "k", "t", "p_first", "p_last", "p_p"]
    assert tuples(got) == sorted(brute_periods(rows, periods), key=lambda r: tuple((x is None, str(x)) for x in r))
    no_nested_loops(got)
    assert join_periods(left.limit(0), right, ("k",), "t", "first", "last").count() == 0
    assert join_periods(left, right.limit(0), ("k",), "t", "first", "last").count() == 0


def test_a_hot_bin_is_split(spark, scratch):
    """Half a million rows of one key and day against its periods: AQE splits the bin."""
    rows = spark.range(500_000).selectExpr("if(id % 5 < 4, 'hot', cast(id % 97 as string)) as k", "cast(id % 3 as int) as t", "id")
    periods = spark.range(2000).selectExpr(
        "if(id < 3, 'hot', cast(id % 97 as string)) as k", "0 as first", "cast(id % 5 as int) as last", "id as p"
    )
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = join_periods(rows, periods, ("k",), "t", "first", "last")
        n = len(got.select("id", "p").toArrow())
        plan = got.select("id", "p")
        plan.write.format("noop").mode("overwrite").save()
        assert n == rows.alias("r").join(periods.alias("p"), "k").where("first <= t and t <= last").count()
        no_nested_loops(got)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_unsorted_duplicates_stay(spark):
    left = spark.createDataFrame([(1, "a", 5)] * 3, "id int, k string, t int")
    right = spark.createDataFrame([("a", 0, 9, 1)] * 2, "k string, first int, last int, p int")
    assert join_periods(left, right, ("k",), "t", "first", "last").count() == 6
