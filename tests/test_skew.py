"""One instance, one time or one name holding a third of all rows."""

import pytest
from pyspark.sql import functions as F

from waterline.operators import ranking
from waterline.operators.ranking import rank_objects
from waterline.operators.rollups import instance_storage_summary
from waterline.operators.snapshots import last_vs_prev, latest

ROWS = 300_000


@pytest.fixture(scope="module")
def hot_key(spark):
    """Instance 0 has a third of the rows, each at a time of its own; the others a few each."""
    instance = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20011 + 1)
    return spark.range(0, ROWS, 1, 16).select(
        instance.alias("instance_id"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("stat_time"),
        F.col("id").alias("logical_total_bytes"),
        F.when(F.col("id") % 5 == 0, "failed").otherwise("ok").alias("collect_status"),
    )




def test_hot_key(spark, hot_key):
    ok = F.col("collect_status") == "ok"
    got = last_vs_prev(hot_key, ["instance_id"], ["logical_total_bytes"], ok=ok)
    row = got.where("instance_id = 0").collect()
    # The newest id of instance 0 is 299997, which is ok; before it 299994 is ok too.
    assert [(r.last_logical_total_bytes, r.prev_logical_total_bytes) for r in row] == [
        (299997, 299994)
    ]
    want = (
        hot_key.toPandas().sort_values("stat_time").groupby("instance_id").tail(1)
        .query("collect_status == 'ok'")
    )
    assert got.count() == len(want)


def test_hot_time(spark):
    """A third of the rows share one instance and one time."""
    df = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("instance_id"),
        F.lit("2026-01-02").cast("timestamp_ntz").alias("stat_time"),
        F.col("id").alias("size"),
    )
    before = spark.createDataFrame([(0, 5)], "instance_id bigint, size bigint").select(
        "instance_id", F.lit("2026-01-01").cast("timestamp_ntz").alias("stat_time"), "size"
    )
    both = df.unionByName(before)
    assert latest(both, ["instance_id"]).where("instance_id = 0").count() == 30_000
    paired = last_vs_prev(both, ["instance_id"], ["size"]).where("instance_id = 0")
    assert paired.count() == 30_000
    assert paired.where("prev_size = 5").count() == 30_000


def test_hot_group_is_ranked_in_parts(spark):
    df = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("instance_id"),
        F.lit("2026-01-02").cast("timestamp_ntz").alias("stat_time"),
        F.lit("s").alias("schema_name"),
        F.concat(F.lit("t"), "id").alias("table_name"),
        (F.pmod(F.xxhash64("id"), F.lit(1 << 40))).alias("total_bytes"),
    )
    ranked = rank_objects(df)
    hot = ranked.where("instance_id = 0")
    top = hot.agg(F.max("rank_no"), F.count_distinct("rank_no"), F.count("*")).first()
    assert tuple(top) == (40_000, 40_000, 40_000)
    ordered = [r.total_bytes for r in hot.orderBy("rank_no").select("total_bytes").collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_hot_instance_sums_before_the_shuffle(spark):
    df = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS instance_id", "'s' AS table_schema",
        "id AS data_length", "1L AS index_length", "'8' AS version",
    )
    out = instance_storage_summary(df)
    assert "partial_sum" in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("instance_id = 0").first().logical_index_bytes == 20_000


def test_equal_sizes_are_ranked_in_parts(spark):
    """300,000 objects of one size in one run: parts by name, of even size."""
    df = spark.range(0, ROWS, 1, 8).select(
        F.lit(1).alias("instance_id"),
        F.lit(5_000_000).cast("bigint").alias("total_bytes"),
        F.lpad(F.hex(F.xxhash64("id")), 16, "0").alias("table_name"),
    )
    keyed = df.withColumn("_band", F.lit(1)).withColumn("_key", F.struct("table_name"))
    sizes = sorted(r["count"] for r in ranking._with_part(keyed, ["instance_id"], 20_000).groupBy("_part").count().collect())
    assert len(sizes) > 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    ranked = rank_objects(df, ["instance_id"], names=["table_name"], part_rows=20_000)
    names = [r["table_name"] for r in ranked.orderBy("rank_no").collect()]
    assert names == sorted(names)
    assert ranked.agg(F.max("rank_no"), F.countDistinct("rank_no")).first() == (ROWS, ROWS)


@pytest.mark.parametrize("most", [200_000, 0])
def test_ranks_do_not_depend_on_parts(spark, monkeypatch, most):
    monkeypatch.setattr(ranking, "_MOST_BROADCAST", most)
    df = spark.range(0, 3_000, 1, 8).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 3).alias("instance_id"),
        F.when(F.col("id") % 13 > 0, F.pmod(F.xxhash64("id"), F.lit(40)) * 100).alias("total_bytes"),
        F.when(F.col("id") % 17 > 0, F.md5(F.col("id").cast("string"))).alias("table_name"),
        "id",
    )
    got = [{(r["id"], r["rank_no"]) for r in rank_objects(df, ["instance_id"], names=["table_name", "id"], part_rows=n).collect()} for n in (16, 50_000)]
    assert got[0] == got[1] and len(got[0]) == 3_000
