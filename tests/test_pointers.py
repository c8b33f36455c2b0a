"""Pointer tables: merged from runs in any order, they are those of the whole history, and reports agree with them."""

import random
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from checks.views import view
from tests.rows import assets, day, snaps, tables, values
from tests.test_properties import PAIR, START, brute_pairs
from waterline.functions import is_ok
from waterline.model import DATE_COLUMN, FACTS, POINTER_TIMES
from waterline.operators.pointers import merged, pointers_of
from waterline.operators.snapshots import aligned_last_vs_prev, last_vs_prev, latest
from waterline.plans import reports
from waterline.sources.facts import read_snapshots
from waterline.sources.pointers import (
    append_with_pointers,
    merge_pointers,
    pointer_schema,
    read_pointers,
    rebuild_pointers,
)
from waterline.sources.versions import StaleVersion, read_version, store_version

KEY = ["instance_id"]


def brute(rows, gated):
    out = []
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        counted = sorted({r[1] for r in own if r[3] == "ok" or not gated}, reverse=True)
        out.append((key, max(r[1] for r in own), *(counted + [None, None])[:2]))
    return sorted(out, key=str)


def rows_of(pointers):
    return values(pointers, "instance_id", *POINTER_TIMES)


def histories(seed):
    """Random histories of 80 entities; times recur within one."""
    draw = random.Random(seed)
    return [
        (key, START + timedelta(hours=8 * draw.randint(0, 5)), draw.randint(0, 9), draw.choice(["ok", "ok", "failed"]))
        for key in range(80)
        for _ in range(draw.randint(1, 8))
    ]


@pytest.mark.parametrize("gated", [True, False])
def test_merged_runs_point_as_the_whole_history(spark, gated):
    ok = is_ok(F.col("collect_status")) if gated else None
    rows = histories(7)
    random.Random(8).shuffle(rows)
    full = snaps(spark, *rows).cache()
    # Runs in no order of time, one of them merged twice.
    found = pointers_of(snaps(spark, *rows[:150]), KEY, ok)
    for part in (rows[150:], rows[100:200]):
        found = merged(found, pointers_of(snaps(spark, *part), KEY, ok), KEY)
    found = found.cache()
    assert rows_of(found) == brute(rows, gated) == rows_of(pointers_of(full, KEY, ok))
    ours = last_vs_prev(full, KEY, ["logical_total_bytes"], ok=ok, pointers=found)
    assert values(ours, *PAIR) == brute_pairs(rows, gated)
    assert values(latest(full, KEY, pointers=found), "*") == values(latest(full, KEY), "*")


def test_runs_found_by_pointers(spark):
    runs = snaps(spark, *histories(1)).cache()
    seen = tables(spark, *[(i, "t", t, b, b) for i, t, b, _ in histories(2)]).cache()
    wanted = (["schema_name", "table_name"], ["total_bytes"])
    kept = pointers_of(runs, KEY, is_ok(F.col("collect_status"))).cache()
    assert values(aligned_last_vs_prev(runs, seen, *wanted, pointers=kept), "*") == values(
        aligned_last_vs_prev(runs, seen, *wanted), "*"
    )


def test_unknown_times_and_keys(spark):
    rows = snaps(spark, (1, None, 5, "ok"), (1, day(1), 6, "ok"), (2, None, 7, "ok"), (None, day(2), 8, "ok"))
    kept = pointers_of(rows, KEY)
    assert rows_of(kept) == sorted([(1, day(1), day(1), None), (2, None, None, None), (None, day(2), day(2), None)], key=str)
    assert values(latest(rows, KEY, pointers=kept), "*") == values(latest(rows, KEY), "*")
    assert rows_of(pointers_of(rows.limit(0), KEY, F.lit(True))) == []


def facts(spark, kind, rows):
    return spark.createDataFrame([], FACTS[kind]).unionByName(rows.select(
        *[c for c in rows.columns if c in FACTS[kind].names]), allowMissingColumns=True)


def test_kept_table_is_the_rebuilt_one(spark, tmp_path):
    kind, path, kept = "mysql_instance", str(tmp_path / "facts"), str(tmp_path / "kept")
    runs = [
        [(i, START + timedelta(days=d), i + d, "ok" if (i + d) % 3 else "failed") for i in range(d % 2, 20)]
        for d in (3, 0, 7)
    ]
    assert read_pointers(spark, kind, kept).count() == 0
    for run in runs:
        append_with_pointers(facts(spark, kind, snaps(spark, *run)), kind, path, kept)
    stored = read_snapshots(spark, kind, path)
    once = rows_of(read_pointers(spark, kind, kept))
    assert once == brute([r for run in runs for r in run], True)
    merge_pointers(stored, kind, kept)
    merge_pointers(stored.limit(0), kind, kept)
    assert rows_of(read_pointers(spark, kind, kept)) == once
    rebuild_pointers(stored, kind, kept)
    assert rows_of(read_pointers(spark, kind, kept)) == once


def test_merges_at_once_lose_nothing(spark, tmp_path):
    kind, kept = "mysql_instance", str(tmp_path / "kept")
    first, second = snaps(spark, (1, day(1), 5, "ok")), snaps(spark, (2, day(2), 6, "ok"))
    merge_pointers(first, kind, kept)
    base, held = read_version(spark, kept, pointer_schema(kind))
    merge_pointers(second, kind, kept)
    with pytest.raises(StaleVersion):
        store_version(held, kept, base)
    assert [r[0] for r in rows_of(read_pointers(spark, kind, kept))] == [1, 2]


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Tables stored by month with their pointers, in two runs."""
    folder, kind = tmp_path_factory.mktemp("stored"), "mysql_object"
    path, kept = str(folder / "facts"), str(folder / "kept")
    month = F.date_trunc("month", "stat_time").cast("timestamp_ntz")
    rows = facts(spark, kind, view(spark, sf_dir, "obj").withColumn("stat_time", month))
    for half in (0, 1):
        append_with_pointers(rows.where(F.col("instance_id") % 2 == half), kind, path, kept)
    return read_snapshots(spark, kind, path), read_pointers(spark, kind, kept)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("found", [
    lambda o, p: latest(o, reports.TABLE, pointers=p),
    lambda o, p: last_vs_prev(o, reports.TABLE, ["total_bytes"], pointers=p),
])
def test_no_history_is_scanned_for_times(spark, stored, broadcast, found):
    objects, pointers = stored
    newest = pointers.where(F.col("prev_time") >= "1997-01-01")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = found(objects, newest)
        plan = df._jdf.queryExecution().executedPlan().toString()
        same = found(objects.drop(DATE_COLUMN), newest)
        assert values(df, *same.columns) == values(same, *same.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scans = re.findall(r"FileScan parquet \[[^\n]*", plan)
    of_facts = [s for s in scans if "total_bytes" in s]
    assert of_facts and all("dynamicpruning" in s for s in of_facts)
    # Facts are read for their rows only: no scan of keys and times, no window over them.
    assert all("total_bytes" in s or "newest_time" in s or "_time#" in s for s in scans)
    assert "Window" not in plan


def test_reports_agree_with_pointers(spark, sf_dir):
    given_assets, runs = view(spark, sf_dir, "asset"), view(spark, sf_dir, "snap")
    kept = reports.Pointers(pointers_of(runs, KEY, is_ok(F.col("collect_status"))))
    for report in (reports.r1, reports.r3, reports.r7):
        assert values(report(given_assets, runs, kept=kept), "*") == values(report(given_assets, runs), "*")
    objects = view(spark, sf_dir, "coll_aligned")
    assert values(reports.r10(given_assets, runs, objects, kept=kept), "*") == values(
        reports.r10(given_assets, runs, objects), "*"
    )


def test_report_of_stale_pointers_shows_the_run_before(spark):
    old, new = (1, day(1), 10, "ok"), (1, day(2), 20, "ok")
    kept = reports.Pointers(pointers_of(snaps(spark, old), KEY, is_ok(F.col("collect_status"))))
    shown = reports.r3(assets(spark, (1, "MOS")), snaps(spark, old, new), kept=kept)
    assert values(shown, "last_stat_time", "prev_stat_time") == [(day(1), None)]
