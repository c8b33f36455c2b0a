"""Trends over the stored history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions import env_label, fmt_count_diff, is_ok, to_gb
from waterline.model import DATE_COLUMN
from waterline.operators.filters import filter_assets
from waterline.operators.ranking import rank_objects, top_k, top_k_per_group
from waterline.operators.snapshots import daily_grain, last_time, last_vs_prev, latest
from waterline.plans.reports import INSTANCE, TABLE, newest_runs


# About how many parts a growth window is matched in.
_SPANS = 14


def overview(assets: DataFrame, instances: DataFrame) -> DataFrame:
    """Latest capacity of every active instance, whatever its status."""
    return newest_runs(filter_assets(assets), instances).select(
        env_label(F.col("env")).alias("env"),
        "alias_name",
        "instance_name",
        "host",
        "port",
        F.col("stat_time").alias("last_stat_time"),
        to_gb(F.col("logical_total_bytes")).alias("logical_total_gb"),
        F.col("collect_status").alias("last_collect_status"),
    )


def growth(
    instances: DataFrame, days: int, size: str = "logical_total_bytes", few: bool = False
) -> DataFrame:
    """Growth from the earliest good snapshot of the last `days` days to the latest good one.

    The days count back from each instance's own latest good snapshot. Of several rows at one
    time the largest counts as latest and the smallest as earliest. `few` says that the instances
    have been counted and may be broadcast.
    """
    good = instances.where(is_ok(F.col("collect_status"))).select("instance_id", "stat_time", size)
    newest = last_time(good, INSTANCE).withColumnRenamed("stat_time", "_newest")
    newest = newest.withColumn("_since", F.col("_newest") - F.make_dt_interval(F.lit(days)))
    if few:
        recent = good.join(F.broadcast(newest), "instance_id")
    else:
        # Matching a span of days as well as the instance spreads one with very many snapshots.
        width = max(1, days // _SPANS)

        def span(time: str) -> Column:
            return F.floor(F.unix_date(F.to_date(time)) / width)

        covered = F.sequence(span("_since"), span("_newest"))
        wanted = newest.withColumn("_span", F.explode(covered))
        recent = good.withColumn("_span", span("stat_time")).join(wanted, ["instance_id", "_span"])
    point = F.struct("stat_time", size)
    return (
        recent.where(F.col("stat_time") >= F.col("_since"))
        .groupBy("instance_id")
        .agg(F.min(point).alias("first"), F.max(point).alias("last"))
        .select(
            "instance_id",
            F.col("first.stat_time").alias("first_stat_time"),
            F.col("last.stat_time").alias("last_stat_time"),
            F.col(f"first.{size}").alias("first_bytes"),
            F.col(f"last.{size}").alias("last_bytes"),
            (F.col(f"last.{size}") - F.col(f"first.{size}")).alias("growth_bytes"),
        )
    )


def avg_daily_growth(
    instances: DataFrame, days: int = 7, size: str = "logical_total_bytes", few: bool = False
) -> DataFrame:
    """Growth per day; NULL where the window holds a single day."""
    return daily_average(growth(instances, days, size, few))


def daily_average(grown: DataFrame) -> DataFrame:
    """Growth per day of the rows of growth or growth_by_days."""
    between = F.date_diff("last_stat_time", "first_stat_time")
    return grown.select(
        "instance_id",
        "growth_bytes",
        between.alias("days_between"),
        to_gb(F.try_divide("growth_bytes", between)).alias("avg_daily_growth_gb"),
    )


def object_growth(
    objects: DataFrame,
    from_date: date | str,
    to_date: date | str,
    k: int = 20,
    keys: Sequence[str] = TABLE,
    size: str = "total_bytes",
) -> DataFrame:
    """Objects that grew most between two days, by their last snapshot of each day."""
    start, end = F.lit(from_date).cast("date"), F.lit(to_date).cast("date")

    def on(day):
        # A range on the stored column, so that it reaches the scan.
        time = F.col("stat_time")
        opens = day.cast("timestamp_ntz")
        return (time >= opens) & (time < F.date_add(day, 1).cast("timestamp_ntz"))

    wanted = objects.where(on(start) | on(end))
    if DATE_COLUMN in objects.columns:
        wanted = wanted.where(F.col(DATE_COLUMN).isin(start, end))
    day, value = F.col(DATE_COLUMN), F.col(size)
    grown = (
        daily_grain(wanted, keys, tiebreak=[size])
        .groupBy(*keys)
        .agg(
            F.max(F.when(day == start, value)).alias("from_bytes"),
            F.max(F.when(day == end, value)).alias("to_bytes"),
        )
        .where(F.col("from_bytes").isNotNull() & F.col("to_bytes").isNotNull())
        .withColumn("growth_bytes", F.col("to_bytes") - F.col("from_bytes"))
    )
    return top_k(grown, [F.desc("growth_bytes"), *[F.asc(c) for c in keys]], k)


def schema_top(
    objects: DataFrame,
    k: int = 5,
    keys: Sequence[str] = TABLE,
    schema: str = "schema_name",
    size: str = "total_bytes",
    pointers: DataFrame | None = None,
) -> DataFrame:
    """Largest schemas of each instance, from the latest snapshot of each of their tables."""
    current = latest(objects, keys, pointers=pointers)
    sizes = current.groupBy("instance_id", schema).agg(F.sum(size).alias(size))
    return top_k_per_group(sizes, INSTANCE, [F.desc(size), F.asc(schema)], k)


def table_top(
    objects: DataFrame,
    k: int = 10,
    by: str = "size",
    keys: Sequence[str] = TABLE,
    size: str = "total_bytes",
    pointers: DataFrame | None = None,
) -> DataFrame:
    """Largest tables of each instance, or with by='diff' those whose size changed most."""
    names = [F.asc(c) for c in keys[1:]]
    if by == "size":
        current = latest(objects, keys, pointers=pointers).select(*keys, "stat_time", size)
        return top_k_per_group(current, INSTANCE, [F.desc(size), *names], k)
    last, prev = f"last_{size}", f"prev_{size}"
    compared = last_vs_prev(objects, keys, [size], pointers=pointers)
    change = F.coalesce(F.abs(F.col(last) - F.col(prev)), F.lit(0))
    order = [change.desc(), *names, F.desc(last), F.desc(prev)]
    ranked = top_k_per_group(compared, INSTANCE, order, k)
    return ranked.withColumn("diff_bytes", F.col(last) - F.col(prev))


def cap_or_threshold(
    objects: DataFrame,
    n: int = 20,
    min_bytes: int | None = None,
    group: Sequence[str] = ("instance_id", "stat_time"),
    size: str = "total_bytes",
    names: Sequence[str] = ("schema_name", "table_name"),
) -> DataFrame:
    """The n largest objects of each run, and any others of at least min_bytes."""
    kept = F.col("rank_no") <= n
    if min_bytes is not None:
        kept = kept | (F.col(size) >= min_bytes)
    return rank_objects(objects, group, size, names).where(kept)


def rank_delta(objects: DataFrame, keys: Sequence[str] = TABLE) -> DataFrame:
    """Change of each table's rank since its previous snapshot; '-' where there is none."""
    compared = last_vs_prev(objects, keys, ["rank_no"])
    change = fmt_count_diff(F.col("last_rank_no"), F.col("prev_rank_no"))
    return compared.select(
        *keys,
        "last_stat_time",
        "prev_stat_time",
        F.col("last_rank_no"),
        F.col("prev_rank_no"),
        change.alias("rank_delta_fmt"),
    )
