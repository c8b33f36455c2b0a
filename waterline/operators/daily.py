"""First and last good snapshot of each instance and day, and growth read from them.

A day's points are two snapshots, whatever the number of runs on that day, and merge by minimum and maximum: points of
parts of a day, in any order and any number of times, give those of the day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions import is_ok
from waterline.model import DATE_COLUMN
from waterline.operators.size import broadcast_if

_FIRST_DAY = "0001-01-01"


def _first_and_last(sizes: Sequence[str]) -> list[Column]:
    """At the first time the smallest size and at the last time the largest, of rows that hold points."""
    firsts = [F.min(F.struct("first_time", f"first_{c}")).alias(f"_first_{c}") for c in sizes]
    lasts = [F.max(F.struct("last_time", f"last_{c}")).alias(f"_last_{c}") for c in sizes]
    return [F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"), *firsts, *lasts]


def merged_points(points: DataFrame, keys: Sequence[str], sizes: Sequence[str]) -> DataFrame:
    """Points of the same keys as one; combined before the shuffle."""
    found = points.groupBy(*keys).agg(*_first_and_last(sizes))
    values = [
        F.col(f"_{end}_{c}.{end}_{c}").alias(f"{end}_{c}") for c in sizes for end in ("first", "last")
    ]
    return found.select(*keys, "first_time", "last_time", *values)


def points_of(snapshots: DataFrame, sizes: Sequence[str]) -> DataFrame:
    """Each good snapshot as the points of a day that holds nothing else."""
    good = snapshots.where(is_ok(F.col("collect_status")) & F.col("stat_time").isNotNull())
    ends = {"first_time": F.col("stat_time"), "last_time": F.col("stat_time")}
    values = {f"{end}_{c}": F.col(c) for c in sizes for end in ("first", "last")}
    return good.select(
        "instance_id", F.to_date("stat_time").alias(DATE_COLUMN), *[c.alias(n) for n, c in {**ends, **values}.items()]
    )


def day_points(snapshots: DataFrame, sizes: Sequence[str]) -> DataFrame:
    """One row for each instance and day that has a good snapshot."""
    return merged_points(points_of(snapshots, sizes), ["instance_id", DATE_COLUMN], sizes)


def _of_days(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the days that occur in `wanted`; only their partitions are read. The list of days is as long as the history."""
    # Spark prunes partitions only by a side that has a comparison, which it takes to be selective.
    days = wanted.select(DATE_COLUMN).distinct().where(F.col(DATE_COLUMN) >= F.lit(_FIRST_DAY).cast("date"))
    return rows.join(F.broadcast(days), DATE_COLUMN, "left_semi")


def growth_by_days(
    points: DataFrame,
    snapshots: DataFrame,
    days: int,
    size: str = "logical_total_bytes",
    few: bool = False,
    pointers: DataFrame | None = None,
) -> DataFrame:
    """The rows of trends.growth, read from day points; `snapshots` are the facts they were made of, with their day.

    A window opens at a time of day. Where it opens between the two points of its first day, that day of that instance
    is read from the snapshots; every other day gives its points. `pointers` (of the instances) spare reading the newest
    day of each instance from all points. `few` says that the instances have been counted and may be broadcast.
    """
    if pointers is None:
        newest = points.groupBy("instance_id").agg(F.max("last_time").alias("_newest"))
    else:
        newest = pointers.where(F.col("last_time").isNotNull()).select("instance_id", F.col("last_time").alias("_newest"))
    opened = newest.withColumn("_since", F.col("_newest") - F.make_dt_interval(F.lit(days)))
    covered = F.sequence(F.to_date("_since"), F.to_date("_newest"))
    # Matching the day as well as the instance spreads one with a long history.
    wanted = opened.select("instance_id", "_since", F.explode(covered).alias(DATE_COLUMN))
    recent = _of_days(points, wanted).join(broadcast_if(few, wanted), ["instance_id", DATE_COLUMN])
    recent = recent.where(F.col("last_time") >= F.col("_since"))

    whole = recent.where(F.col("first_time") >= F.col("_since"))
    cut = recent.where(F.col("first_time") < F.col("_since")).select("instance_id", DATE_COLUMN, "_since")
    inside = _of_days(snapshots, cut).join(broadcast_if(few, cut), ["instance_id", DATE_COLUMN])
    inside = points_of(inside.where(F.col("stat_time") >= F.col("_since")), [size])

    columns = ["instance_id", "first_time", "last_time", f"first_{size}", f"last_{size}"]
    ends = merged_points(whole.select(*columns).unionByName(inside.select(*columns)), ["instance_id"], [size])
    first, last = F.col(f"first_{size}"), F.col(f"last_{size}")
    return ends.select(
        "instance_id",
        F.col("first_time").alias("first_stat_time"),
        F.col("last_time").alias("last_stat_time"),
        first.alias("first_bytes"),
        last.alias("last_bytes"),
        (last - first).alias("growth_bytes"),
    )
