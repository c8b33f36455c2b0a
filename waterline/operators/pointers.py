"""Pointers: the newest and previous times of each entity, so that no report looks for them in the history.

One row for each entity: its keys, `newest_time` (of any row), `last_time` and `prev_time` (the two newest distinct times
of rows that count). Rows that count are the successful ones where a fact has a status, all rows elsewhere. Two pointers
of an entity merge to those of all its rows, in any order and with rows seen twice, so a table of them is kept by
merging each run into it. NULL times never count; an entity without a counted row has NULL in both last columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.model import POINTER_TIMES
from waterline.operators.snapshots import last_time, recent_times


def pointers_of(
    facts: DataFrame, keys: Sequence[str], ok: Column | None = None, ts: str = "stat_time"
) -> DataFrame:
    """Pointers of some facts; `ok` says which rows count. An entity's rows are never brought into one task."""
    usable = facts if ok is None else facts.where(ok)
    ages = recent_times(usable, keys, ts)
    counted = ages.groupBy(*keys).agg(
        F.max(ts).alias("last_time"), F.max(F.when(F.col("age") == 2, F.col(ts))).alias("prev_time")
    )
    if ok is None:
        return counted.select(*keys, F.col("last_time").alias("newest_time"), "last_time", "prev_time")
    newest = last_time(facts, keys, ts).withColumnRenamed(ts, "newest_time")
    return merged(newest, counted, keys)


def merged(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pointers of the rows of both sides, each with one row for an entity. A time that a side lacks is NULL."""
    both = left.unionByName(right, allowMissingColumns=True)
    # At most two rows of an entity: the older of two last times is a candidate beside both previous ones.
    older = F.when(F.min("last_time") < F.max("last_time"), F.min("last_time"))
    found = both.groupBy(*keys).agg(
        F.max("newest_time").alias("newest_time"),
        F.max("last_time").alias("last_time"),
        F.greatest(F.max("prev_time"), older).alias("prev_time"),
    )
    return found.select(*keys, *POINTER_TIMES)
