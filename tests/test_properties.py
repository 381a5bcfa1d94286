"""Generated literal frames: O4's zero policies against a plain-Python model."""

from __future__ import annotations

from collections import defaultdict

from frames import frame, sale
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll.operators import measure_by

lines = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(min_value=-3, max_value=3)),
    min_size=1,
    max_size=12,
)


def _model(rows, policy):
    sums = defaultdict(int)
    for key, value in rows:
        if policy == "rows" and value == 0:
            continue
        sums[key] += value
    if policy == "groups":
        return sorted((k, v) for k, v in sums.items() if v != 0)
    return sorted(sums.items())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=lines, policy=st.sampled_from(["none", "rows", "groups"]))
def test_measure_by_matches_model(spark, rows, policy):
    df = frame(spark, *[sale(category=k, amount=v) for k, v in rows])
    out = measure_by(df, ["category"], "amount", policy, "t")
    got = sorted((r["category"], r["t"]) for r in out.collect())
    assert got == _model(rows, policy)
