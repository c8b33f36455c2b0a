"""The physical plans: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.views import view
from waterline.model import DATE_COLUMN
from waterline.operators.snapshots import last_vs_prev, latest
from waterline.plans import reports
from waterline.sources.facts import append_snapshot, read_snapshots
from waterline.sources.scratch import scratch_path

NEVER = (
    "Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
    "collect_list", "collect_set",
)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan after it ran, with adaptive decisions."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_no_cross_join_no_collected_groups(spark, sf_dir, name):
    plan = planned(QUERIES[name](spark, sf_dir))
    assert [word for word in NEVER if word in plan] == []


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_pairs_read_the_same_days(spark, sf_dir, shuffled_joins):
    """Equal sides, so that the scan and shuffle of the facts are shared; each has the days of last and previous times."""
    plan = planned(QUERIES["j6_stored_object_prev"](spark, sf_dir))
    assert plan.count("Generate explode(array(") >= 2


def test_table_report_fetches_its_rows_once(spark, sf_dir, shuffled_joins):
    """A sort reads its input twice, first to sample it: between it and the join with the facts lies a shuffle."""
    for name in ("r4_stored_object_latest", "r4_object_latest"):
        sorted_rows = planned(QUERIES[name](spark, sf_dir)).split("rangepartitioning")[1]
        assert "REBALANCE" in sorted_rows.split("Join")[0]


def test_rank_changes_read_stored_ranks(spark, sf_dir):
    plan = planned(QUERIES["d9_rank_delta"](spark, sf_dir))
    assert "_place" not in plan and "lineitem" not in plan


def test_latest_combines_before_the_shuffle(spark, sf_dir):
    plan = planned(latest(view(spark, sf_dir, "snap"), ["instance_id"]))
    assert "partial_max" in plan and "Window" not in plan


def test_last_vs_prev_limits_each_key_before_the_shuffle(spark, sf_dir):
    plan = planned(last_vs_prev(view(spark, sf_dir, "obj"), reports.TABLE, ["total_bytes"]))
    # One limit per side of the pair; both must be the same for the shuffle to be shared.
    assert plan.count("row_number(), 2, Partial") == 2
    assert "Window [max" not in plan


def test_last_vs_prev_shares_its_shuffles(spark, sf_dir, shuffled_joins):
    df = last_vs_prev(view(spark, sf_dir, "obj"), reports.TABLE, ["total_bytes"])
    plan = executed(df)
    assert plan.count("ReusedExchange") >= 2
    assert plan.count("FileScan") == 2


def test_few_entities_are_fetched_without_shuffling_facts(spark, sf_dir, shuffled_joins):
    ok = F.col("collect_status") == "ok"
    snapshots = view(spark, sf_dir, "snap")
    plan = planned(last_vs_prev(snapshots, ["instance_id"], ["logical_total_bytes"], ok=ok, few=True))
    assert plan.count("BroadcastHashJoin [instance_id") == 3
    carrying = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Only the search for times and the pairing of found rows shuffle.
    assert not any("stat_time" in line for line in carrying if "logical" in line)


def test_run_reports_read_objects_without_shuffling_them(spark, sf_dir, shuffled_joins):
    """The objects of two runs are picked by broadcast; only they are shuffled to be paired."""
    plan = planned(QUERIES["r10_doc_diff_top10"](spark, sf_dir))
    assert "BroadcastHashJoin [instance_id" in plan


def test_many_assets_are_not_broadcast(spark, sf_dir, monkeypatch, shuffled_joins):
    monkeypatch.setattr("waterline.operators.size.MAX_BROADCAST_ROWS", 10)
    from waterline.operators.size import is_small

    assert not is_small(view(spark, sf_dir, "asset"))
    plan = planned(QUERIES["r3_instance_diff"](spark, sf_dir))
    assert "Broadcast" not in plan
    assert QUERIES["r3_instance_diff"](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] == "r"] + ["d2_growth_14d"])
def test_reports_of_few_and_many_assets_agree(spark, sf_dir, monkeypatch, shuffled_joins, name):
    few = QUERIES[name](spark, sf_dir)
    want = sorted(map(str, few.collect()))
    monkeypatch.setattr("waterline.operators.size.MAX_BROADCAST_ROWS", 10)
    many = QUERIES[name](spark, sf_dir)
    assert many.schema == few.schema
    assert sorted(map(str, many.collect())) == want


def test_facts_are_hashed_on_key_and_time(spark, sf_dir, shuffled_joins):
    plan = planned(latest(view(spark, sf_dir, "snap"), ["instance_id"]))
    fact_side = [
        line for line in plan.splitlines() if "Exchange hashpartitioning(instance_id" in line
    ]
    assert any("stat_time" in line for line in fact_side)


def test_top_k_reports_do_not_sort_everything(spark, sf_dir):
    for name in ("r9_doc_top50", "r10_doc_diff_top10", "o4_top_objects", "d4_object_growth_topn"):
        plan = planned(QUERIES[name](spark, sf_dir))
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


def test_top_k_per_group_is_limited_before_the_shuffle(spark, sf_dir):
    for name in ("d5_schema_top5", "d6_table_top10", "d7_daily_grain"):
        assert "Partial" in planned(QUERIES[name](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    path = scratch_path(spark, "pushed")
    view(spark, sf_dir, "asset").write.parquet(path)
    from waterline.operators.filters import active_assets

    df = active_assets(spark.read.parquet(path), "mysql", "login_path").select("instance_id")
    plan = planned(df)
    assert "EqualTo(type,mysql)" in plan and "IsNotNull(login_path)" in plan
    assert "alias_name" not in plan


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    """Instance snapshots stored by day."""
    path = scratch_path(spark, "stored")
    months = F.date_trunc("month", "stat_time").cast("timestamp_ntz")
    append_snapshot(view(spark, sf_dir, "snap").withColumn("stat_time", months),
                    "mysql_instance", path)
    return read_snapshots(spark, "mysql_instance", path)


def test_dates_select_partitions(spark, stored):
    path = stored.inputFiles()[0].split(DATE_COLUMN)[0]
    some = read_snapshots(spark, "mysql_instance", path, "1997-01-01", "1997-03-31")
    assert "PartitionFilters: [isnotnull(stat_date" in planned(some)
    assert 0 < some.count() < stored.count()
    assert some.select(DATE_COLUMN).distinct().count() == 3


def test_rows_are_fetched_from_the_wanted_days_only(spark, stored):
    ok = F.col("collect_status") == "ok"
    df = last_vs_prev(stored, ["instance_id"], ["logical_total_bytes"], ok=ok, few=True)
    plan = planned(df)
    assert plan.count("dynamicpruning") >= 2
    plain = stored.drop(DATE_COLUMN)
    same = last_vs_prev(plain, ["instance_id"], ["logical_total_bytes"], ok=ok)
    assert sorted(map(str, df.collect())) == sorted(map(str, same.collect()))
    assert latest(stored, ["instance_id"]).count() == latest(plain, ["instance_id"]).count()


def test_many_entities_read_the_wanted_days_only(spark, stored, shuffled_joins):
    """Uncounted entities: only the distinct days of the wanted times are broadcast."""
    plain = stored.drop(DATE_COLUMN)
    for found in (latest, lambda d, k: last_vs_prev(d, k, ["logical_total_bytes"])):
        df = found(stored, ["instance_id"])
        plan = planned(df)
        assert "dynamicpruning" in plan
        assert "BroadcastHashJoin [stat_date" in plan and "BroadcastHashJoin [instance_id" not in plan
        same = found(plain, ["instance_id"])
        assert sorted(map(str, df.select(same.columns).collect())) == sorted(map(str, same.collect()))
