"""Random small histories against brute force, and invariants of the operators."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.rows import assets, snaps, tables, values
from waterline.operators.ranking import dense_numbers, rank_objects
from waterline.operators.snapshots import (
    aligned_last_vs_prev,
    daily_grain,
    last_vs_prev,
    latest,
)
from waterline.plans import reports, trends

START = datetime(2026, 1, 1)
FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

history = st.lists(
    st.tuples(
        st.integers(1, 4),
        st.integers(0, 5).map(lambda h: START + timedelta(hours=8 * h)),
        st.integers(0, 9),
        st.sampled_from(["ok", "ok", "failed"]),
    ),
    min_size=1,
    max_size=30,
)


def brute_pairs(rows, gated):
    """All (key, last time, last value, previous time, previous value)."""
    out = []
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        last = max(r[1] for r in own)
        older = [r[1] for r in own if r[1] < last and (r[3] == "ok" or not gated)]
        prev = max(older, default=None)
        current = [r for r in own if r[1] == last and (r[3] == "ok" or not gated)]
        before = [r for r in own if r[1] == prev] or [(None, None, None, None)]
        out += [(key, c[1], c[2], p[1], p[2]) for c in current for p in before]
    return sorted(out, key=str)


PAIR = (
    "instance_id", "last_stat_time", "last_logical_total_bytes",
    "prev_stat_time", "prev_logical_total_bytes",
)


@pytest.mark.parametrize("gated", [True, False])
@FEW
@given(rows=history)
def test_last_vs_prev(spark, gated, rows):
    ok = F.col("collect_status") == "ok" if gated else None
    out = last_vs_prev(snaps(spark, *rows), ["instance_id"], ["logical_total_bytes"], ok=ok)
    assert values(out, *PAIR) == brute_pairs(rows, gated)


@FEW
@given(rows=history)
def test_latest_keeps_ties(spark, rows):
    newest = {k: max(r[1] for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    want = sorted(((r[0], r[2], r[3]) for r in rows if r[1] == newest[r[0]]), key=str)
    out = latest(snaps(spark, *rows), ["instance_id"])
    assert values(out, "instance_id", "logical_total_bytes", "collect_status") == want


@pytest.mark.parametrize("few", [True, False])
@FEW
@given(rows=history, objects=history)
def test_aligned(spark, few, rows, objects):
    seen = [(i, "t", t, b, b) for i, t, b, _ in objects]
    want = []
    runs = {(p[0], p[1], p[3]) for p in brute_pairs(rows, True)}
    for pair in brute_pairs(rows, True):
        for o in [o for o in seen if o[0] == pair[0] and o[2] == pair[1]]:
            prev = [p for p in seen if p[0] == pair[0] and p[2] == pair[3]]
            want += [(o[0], o[3], p[3]) for p in prev] or [(o[0], o[3], None)]
    assert len(runs) <= len({r[0] for r in rows})
    out = aligned_last_vs_prev(
        snaps(spark, *rows),
        tables(spark, *seen),
        ["schema_name", "table_name"],
        ["total_bytes"],
        few=few,
    )
    got = values(out, "instance_id", "last_total_bytes", "prev_total_bytes")
    assert got == sorted(want, key=str)


@FEW
@given(rows=history)
def test_older_history_never_changes_the_latest(spark, rows):
    older = (1, START - timedelta(days=30), 1, "ok")
    columns = ("instance_id", "stat_time", "logical_total_bytes")
    with_older = latest(snaps(spark, *rows, older), ["instance_id"])
    if any(r[0] == 1 for r in rows):
        want = latest(snaps(spark, *rows), ["instance_id"])
        assert values(with_older, *columns) == values(want, *columns)


@FEW
@given(rows=history)
def test_env_counts_add_up_to_instances(spark, rows):
    a = assets(spark, (1, "MOS"), (2, "RTM"), (3, None), (4, ""))
    s = snaps(spark, *rows)
    counted = reports.r2(a, s).agg(F.sum("instance_count")).first()[0] or 0
    assert counted == reports.r3(a, s).count()


def test_partitioning_changes_nothing(spark):
    rows = [(i % 7, START + timedelta(hours=i % 11), i, "ok" if i % 3 else "failed") for i in
            range(300)]
    s = snaps(spark, *rows)
    ok = F.col("collect_status") == "ok"
    want = values(last_vs_prev(s, ["instance_id"], ["logical_total_bytes"], ok=ok), *PAIR)
    for parts in (1, 13):
        again = s.repartition(parts)
        got = last_vs_prev(again, ["instance_id"], ["logical_total_bytes"], ok=ok)
        assert values(got, *PAIR) == want


@FEW
@given(sizes=st.lists(st.tuples(st.integers(1, 3), st.integers(0, 1 << 45)), min_size=1, max_size=40))
def test_rank_is_the_place_in_the_group(spark, sizes):
    rows = [(i, f"t{n}", START, 0, b) for n, (i, b) in enumerate(sizes)]
    got = values(rank_objects(tables(spark, *rows)), "instance_id", "table_name", "rank_no")
    want = []
    for i in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == i), key=lambda r: (-r[4], r[1]))
        want += [(i, r[1], place) for place, r in enumerate(ordered, 1)]
    assert got == sorted(want, key=str)


def test_dense_numbers_are_stable(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(None).cast("string").alias("e"))
    first = dense_numbers(df, ["k", "e"], "n")
    again = dense_numbers(df.repartition(9), ["k", "e"], "n")
    assert sorted(r.n for r in first.collect()) == list(range(1, 1001))
    assert values(first, "k", "n") == values(again, "k", "n")


@pytest.mark.parametrize("few", [True, False])
@FEW
@given(rows=history)
def test_growth(spark, few, rows):
    want = []
    for key in {r[0] for r in rows}:
        good = [(r[1], r[2]) for r in rows if r[0] == key and r[3] == "ok"]
        if good:
            recent = [g for g in good if g[0] >= max(good)[0] - timedelta(days=1)]
            want.append((key, max(recent)[1] - min(recent)[1]))
    out = trends.growth(snaps(spark, *rows), 1, few=few)
    assert values(out, "instance_id", "growth_bytes") == sorted(want, key=str)


@FEW
@given(rows=history)
def test_daily_grain(spark, rows):
    want = {}
    for r in rows:
        key = (r[0], r[1].date())
        want[key] = max(want.get(key, (r[1], r[2])), (r[1], r[2]))
    out = daily_grain(snaps(spark, *rows), ["instance_id"], tiebreak=["logical_total_bytes"])
    got = values(out, "instance_id", "stat_date", "logical_total_bytes")
    assert got == sorted(((k, d, v[1]) for (k, d), v in want.items()), key=str)
