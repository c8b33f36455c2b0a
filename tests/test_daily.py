"""Day points: growth read from them is growth read from the snapshots, whatever the runs they were merged from."""

import random
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.rows import day, snaps, values
from waterline.model import DATE_COLUMN, FACTS
from waterline.operators.daily import day_points, growth_by_days, merged_points
from waterline.operators.pointers import pointers_of
from waterline.functions import is_ok
from waterline.plans.trends import avg_daily_growth, daily_average, growth
from waterline.sources.daily import merge_day_points, read_day_points
from waterline.sources.facts import append_snapshot, read_snapshots

SIZE = "logical_total_bytes"
GROWN = ["instance_id", "first_stat_time", "last_stat_time", "first_bytes", "last_bytes", "growth_bytes"]


def history(seed, entities=60, most=30):
    """Several runs a day over some weeks, times that recur, failed runs; entity 0 has a third of all rows."""
    draw = random.Random(seed)
    keys = [k for k in range(1, entities) for _ in range(draw.randint(1, most))]
    keys += [0] * (len(keys) // 2)
    return [
        (k, day(1) + timedelta(hours=draw.randint(0, 480)), draw.randint(0, 999), draw.choice(["ok", "ok", "failed"]))
        for k in keys
    ]


def dated(snapshots):
    return snapshots.withColumn(DATE_COLUMN, F.to_date("stat_time"))


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("days", [0, 1, 7, 30])
def test_growth_from_points_is_growth_from_snapshots(spark, days, few):
    facts = dated(snaps(spark, *history(days))).cache()
    points = day_points(facts, [SIZE])
    wanted = values(growth(facts, days), *GROWN)
    assert len(wanted) > 40
    assert values(growth_by_days(points, facts, days, few=few), *GROWN) == wanted
    newest = pointers_of(facts, ["instance_id"], is_ok(F.col("collect_status")))
    assert values(growth_by_days(points, facts, days, few=few, pointers=newest), *GROWN) == wanted
    ours = daily_average(growth_by_days(points, facts, days, few=few))
    assert values(ours, *ours.columns) == values(avg_daily_growth(facts, days), *ours.columns)


def test_points_of_parts_merge_in_any_order(spark):
    rows = history(5)
    full = snaps(spark, *rows).cache()
    sizes = [SIZE, "physical_total_bytes"]
    keys = ["instance_id", DATE_COLUMN]
    whole = day_points(full, sizes).cache()
    parts = [day_points(snaps(spark, *rows[a:b]), sizes) for a, b in ((300, 900), (0, 400), (350, 380), (900, None))]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged_points(merged.unionByName(part), keys, sizes)
    assert values(merged, *whole.columns) == values(whole, *whole.columns)
    wanted = {}
    for k, t, b, status in rows:
        if status == "ok":
            wanted.setdefault((k, t.date()), []).append((t, b))
    brute = sorted(((*key, min(v)[0], max(v)[0], min(v)[1], max(v)[1]) for key, v in wanted.items()), key=str)
    assert values(whole, *keys, "first_time", "last_time", f"first_{SIZE}", f"last_{SIZE}") == brute


def test_stored_points_are_repeatable_and_read_by_day(spark, tmp_path):
    kind, facts, points = "mysql_instance", str(tmp_path / "facts"), str(tmp_path / "points")
    rows = snaps(spark, *history(9)).drop("physical_total_bytes", "mongo_version").select(*FACTS[kind].names).cache()
    append_snapshot(rows, kind, facts)
    noon = F.lit(day(10)).cast("timestamp_ntz")
    for part in (rows.where(F.col("stat_time") >= noon), rows.where(F.col("stat_time") < noon), rows, rows.limit(0)):
        merge_day_points(part, kind, points)
    stored = read_day_points(spark, kind, points)
    whole = day_points(rows, [SIZE])
    assert values(stored, *whole.columns) == values(whole, *whole.columns)
    grown = growth_by_days(stored, read_snapshots(spark, kind, facts), 7)
    assert values(grown, *GROWN) == values(growth(rows, 7), *GROWN)
    # Every scan that reads sizes is pruned to the wanted days.
    plan = grown._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in re.findall(r"FileScan.*", plan) if "total_bytes" in s]
    assert scans and all("dynamicpruning" in s.lower() for s in scans)


def test_nothing_good_grows_nothing(spark):
    failed = dated(snaps(spark, (1, day(1), 5, "failed"), (2, None, 5, "ok")))
    assert day_points(failed, [SIZE]).count() == 0
    assert growth_by_days(day_points(failed, [SIZE]), failed, 7).count() == 0
    assert day_points(failed.limit(0), [SIZE]).count() == 0
