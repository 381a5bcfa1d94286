"""Averages, completeness, event windows and sessions as streams equal the batch results."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from compare import normalised_rows
from frames import frame, sale
from pyspark.sql import functions as F
from test_streaming import _drop, _latest, _same

from tillroll.plans.reports import REPORTS
from tillroll.sources import header_line, read_sales_text
from tillroll.streaming import STATE_STREAMABLE, start_session_stream, start_state_stream, start_window_stream
from tillroll.streaming.events import EVENT_SCHEMA, sessions, window_sums

DROPS = [
    [
        sale(sale_date="01-01-2017", quantity=10, bill_no="1"),
        sale(sale_date="01-01-2017", quantity=-10, bill_no="2", customer_mobile=""),
        sale(sale_date="02-03-2016", quantity=4),
        sale(sale_date="02-03-2017", quantity=3, rep_id="R2"),
    ],
    [
        sale(sale_date="01-01-2017", quantity=5, bill_no="1"),
        sale(sale_date="05-01-2017", quantity=7, bill_no="3", city="City2"),
        sale(sale_date="05-01-2017 10:15", quantity=1, bill_no="3", pos_code="P2"),
    ],
    [sale(sale_date="01-01-2016", bill_no="9")],
    [sale(sale_date="31-12-2018", quantity=8, bill_no="2", customer_mobile=""), sale(sale_date="02-03-2017", bill_no="7")],
]


@pytest.mark.parametrize("merge_every", [1, 2, 16])
@pytest.mark.parametrize("name", ["rep_avg_quantity_per_day", "zone_mobile_completeness"])
def test_every_drop_equals_the_batch_report(spark, scratch, name, merge_every):
    if name.endswith("completeness") and merge_every != 16:
        pytest.skip("completeness has no merged state")
    _run_drops(spark, scratch, name, merge_every)


@pytest.mark.parametrize("name", [n for n in STATE_STREAMABLE if n not in ("rep_avg_quantity_per_day", "zone_mobile_completeness")])
def test_other_reports_equal_the_batch_report(spark, scratch, name):
    _run_drops(spark, scratch, name, 2)


def _run_drops(spark, scratch, name, merge_every):
    """Each drop is a new query on the same checkpoint: a restart."""
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    os.makedirs(source)
    for k, lines in enumerate(DROPS):
        _drop(spark, frame(spark, *lines), source, f"{k}.csv")
        query = start_state_stream(
            spark, source, name, sink, checkpoint_dir=ckpt, excluded_year="2016", available_now=True, merge_every=merge_every
        )
        query.awaitTermination(120)
        batch = REPORTS[name].run(read_sales_text(spark, source, header=header_line()), "2016")
        assert _same(_latest(spark, sink), batch)


@pytest.mark.parametrize("name", ["avg_quantity_per_day", "mobile_completeness"])
def test_a_replayed_trigger_changes_nothing(spark, scratch, name):
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    os.makedirs(source)
    for k, lines in enumerate(DROPS[:2]):
        _drop(spark, frame(spark, *lines), source, f"{k}.csv")
        start_state_stream(spark, source, name, sink, checkpoint_dir=ckpt, available_now=True, merge_every=2).awaitTermination(120)
    before = normalised_rows(["a"], [(str(r),) for r in _latest(spark, sink).collect()])
    for file in ("1", ".1.crc"):
        path = os.path.join(ckpt, "commits", file)
        if os.path.exists(path):
            os.remove(path)
    start_state_stream(spark, source, name, sink, checkpoint_dir=ckpt, available_now=True, merge_every=2).awaitTermination(120)
    after = normalised_rows(["a"], [(str(r),) for r in _latest(spark, sink).collect()])
    assert before == after
    batch = REPORTS[name].run(read_sales_text(spark, source, header=header_line()), "2016")
    assert _same(_latest(spark, sink), batch)


def test_unsuitable_arguments(spark, scratch):
    with pytest.raises(ValueError):
        start_state_stream(spark, scratch, "daily_value", scratch, checkpoint_dir=scratch)
    with pytest.raises(ValueError):
        start_state_stream(spark, scratch, "mobile_completeness", scratch, checkpoint_dir=scratch, merge_every=0)


# Events

START = dt.datetime(2024, 1, 1)


def events(spark, minutes):
    """(minutes after the start or None, user, type, value)."""
    rows = [
        (i, None if m is None else START + dt.timedelta(minutes=m), user, kind, value, None)
        for i, (m, user, kind, value) in enumerate(minutes)
    ]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


EVENT_DROPS = [
    [(0, 1, "view", 1.1), (59, 1, "view", 2.25), (61, 2, "buy", 3.0), (150, 3, "view", None)],
    [(200, 1, "view", 1.0), (10, 1, "view", 5.0), (130, None, "buy", 2.0), (None, 4, "buy", 1.0)],
    [(20, 1, "view", 9.0), (119, 1, None, 4.0), (121, 2, "buy", 7.0), (400, 1, "view", 1.5)],
    [(405, 2, "view", 1.0), (150, 9, "view", 2.0), (2000, 1, "view", 0.5)],
    [(2001, 1, "view", 0.5), (9000, 1, "end", 0.0)],
]


def expected_late(drops, delay=120, width=60):
    """Rows whose window ended at or before the watermark of earlier drops."""
    latest, late = None, []
    for drop in drops:
        on_time = []
        for row in drop:
            m = row[0]
            over = m is None or (latest is not None and (m // width + 1) * width <= latest - delay)
            (late if over else on_time).append(row)
        times = [r[0] for r in on_time]
        latest = max([*times, *([] if latest is None else [latest])], default=latest)
    return late


def test_final_windows_and_late_rows(spark, scratch):
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    for drop in EVENT_DROPS:
        events(spark, drop).coalesce(1).write.mode("append").parquet(source)
        start_window_stream(spark, source, sink, ckpt, available_now=True).awaitTermination(120)
    late = spark.read.parquet(f"{sink}/late")
    expected = expected_late(EVENT_DROPS)
    assert sorted((r["user_id"], r["value"]) for r in late.collect()) == sorted((r[1], r[3]) for r in expected)
    assert len(expected) == 3
    every = [r for drop in EVENT_DROPS for r in drop]
    on_time = [r for r in every if r not in expected]
    # All windows that the last watermark (9000 minutes less two hours) has passed, once each.
    batch = window_sums(events(spark, on_time), "1 hour").where(F.col("window_end") <= START + dt.timedelta(minutes=8880))
    final = spark.read.parquet(f"{sink}/windows").drop("batch_id")
    assert _same(final, batch)
    assert final.count() == final.select("window_start", "event_type").distinct().count()


def test_a_replayed_window_trigger(spark, scratch):
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    for drop in EVENT_DROPS[:4]:
        events(spark, drop).coalesce(1).write.mode("append").parquet(source)
        start_window_stream(spark, source, sink, ckpt, available_now=True).awaitTermination(120)
    before = sorted(map(str, spark.read.parquet(f"{sink}/windows").collect()))
    for file in ("3", ".3.crc"):
        path = os.path.join(ckpt, "commits", file)
        if os.path.exists(path):
            os.remove(path)
    start_window_stream(spark, source, sink, ckpt, available_now=True).awaitTermination(120)
    assert sorted(map(str, spark.read.parquet(f"{sink}/windows").collect())) == before


def brute_sessions(rows, gap=30):
    users = {}
    for m, user, _, value in rows:
        if m is not None:
            users.setdefault(user, []).append((m, value))
    out = []
    for user, held in users.items():
        held.sort(key=lambda x: x[0])
        current = []
        for m, value in held + [(None, None)]:
            if current and (m is None or m - current[-1][0] >= gap):
                ends = START + dt.timedelta(minutes=current[-1][0] + gap)
                cents = sum(round((v or 0) * 100) for _, v in current)
                out.append((user, START + dt.timedelta(minutes=current[0][0]), ends, len(current), cents))
                current = []
            current.append((m, value))
    return out


def test_sessions_of_a_hot_user(spark):
    rows = [((i * i) % 4000, 1, "view", 0.25) for i in range(400)] + EVENT_DROPS[0] + EVENT_DROPS[1]
    got = [tuple(r) for r in sessions(events(spark, rows).repartition(5)).collect()]
    assert sorted(got, key=str) == sorted(brute_sessions(rows), key=str)


def test_session_stream_equals_the_batch(spark, scratch):
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    drops = [
        [(0, 1, "view", 1.0), (20, 1, "view", 1.0), (25, 2, "view", 2.0)],
        [(45, 1, "buy", 3.0), (100, 2, "view", 1.0), (74, 1, "view", 1.0)],
        [(400, 1, "view", 1.0)],
        [(5000, 3, "end", 0.0)],
    ]
    for drop in drops:
        events(spark, drop).coalesce(1).write.mode("append").parquet(source)
        start_session_stream(spark, source, sink, ckpt, available_now=True).awaitTermination(120)
    written = spark.read.parquet(sink)
    batch = sessions(events(spark, [r for d in drops for r in d])).where("user_id <> 3")
    assert _same(written, batch)
