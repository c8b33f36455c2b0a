"""Latest and previous snapshots of an entity.

Every operator here works in two steps. First the wanted times of each entity are found on the
narrow key and time columns, with aggregates that combine before the shuffle. Then the rows at
those times are fetched with an equality join on (key, time). No window ever holds the rows of an
entity, so one with very many snapshots is no problem: its facts are hashed on key *and* time and
spread over all tasks, and rows repeated at one time are a skewed join that adaptive execution
splits.

Where the caller has counted the entities (`few=True`, see operators.size) the time table is
broadcast: it has one row per entity and time looked for. Then no fact is shuffled to be filtered,
and stored facts are read from the day partitions that hold a wanted time only. Where the entities
are too many for that, the distinct days of the wanted times still are few (one row per stored day),
so they are broadcast instead: the rest of the history is neither read at full width nor shuffled.

Where the caller keeps `pointers` (see operators.pointers) the first step is reading them: no history
is scanned for its times, and of facts stored by day only the days that hold a wanted time are read.

Rows that share an entity's latest time are all kept, and pair with all rows at its previous time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.functions import is_ok
from waterline.model import DATE_COLUMN
from waterline.operators.size import broadcast_if

_FIRST_DAY = "0001-01-01"


def _at_times(facts: DataFrame, times: DataFrame, ts: str) -> tuple[DataFrame, list[str]]:
    """Times and join key parts that match facts; stored facts add their day.

    The day is their partition, so only the partitions that hold a wanted time are read.
    """
    if DATE_COLUMN in facts.columns:
        return times.withColumn(DATE_COLUMN, F.to_date(ts)), [ts, DATE_COLUMN]
    return times, [ts]


def _of_days(facts: DataFrame, times: DataFrame, few: bool) -> DataFrame:
    """Stored facts of the days that `times` (from _at_times) holds; others as they are."""
    if few or DATE_COLUMN not in facts.columns:
        return facts
    # Spark prunes partitions only by a side that has a comparison, which it takes to be selective.
    days = times.select(DATE_COLUMN).distinct().where(F.col(DATE_COLUMN) >= F.lit(_FIRST_DAY).cast("date"))
    return facts.join(F.broadcast(days), DATE_COLUMN, "left_semi")


def _rows_at(
    facts: DataFrame, times: DataFrame, keys: Sequence[str], ts: str, few: bool, days: DataFrame | None = None
) -> DataFrame:
    """Fact rows whose (key, time) is in `times`; stored facts are read from the days of `days`, by default of the times."""
    times, time_key = _at_times(facts, times, ts)
    facts = _of_days(facts, times if days is None else days, few)
    return facts.join(broadcast_if(few, times), [*keys, *time_key], "left_semi")


def _named(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], prefix: str) -> DataFrame:
    return rows.select(*keys, *[F.col(f).alias(f"{prefix}_{f}") for f in fields])


def collated(
    df: DataFrame, columns: Sequence[str], collation: str = "UNICODE_CI_RTRIM"
) -> DataFrame:
    """Compare the named text columns by a collation, here without case and trailing blanks.

    Names differ by their bytes unless this is applied first.
    """
    return df.withColumns({c: F.collate(c, collation) for c in columns})


def last_time(df: DataFrame, keys: Sequence[str], ts: str = "stat_time") -> DataFrame:
    """Newest time of each entity."""
    return df.groupBy(*keys).agg(F.max(ts).alias(ts))


def _pointed(pointers: DataFrame, keys: Sequence[str], column: str, ts: str) -> DataFrame:
    return pointers.where(F.col(column).isNotNull()).select(*keys, F.col(column).alias(ts))


def latest(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "stat_time",
    few: bool = False,
    pointers: DataFrame | None = None,
) -> DataFrame:
    """All rows at the newest time of their entity."""
    times = last_time(df, keys, ts) if pointers is None else _pointed(pointers, keys, "newest_time", ts)
    return _rows_at(df, times, keys, ts, few)


def latest_ok(
    df: DataFrame,
    keys: Sequence[str] = ("instance_id",),
    ts: str = "stat_time",
    status: str = "collect_status",
    few: bool = False,
    pointers: DataFrame | None = None,
) -> DataFrame:
    """Latest rows that succeeded; an entity whose newest run failed is absent."""
    return latest(df, keys, ts, few, pointers).where(is_ok(F.col(status)))


def recent_times(
    df: DataFrame, keys: Sequence[str], ts: str = "stat_time", count: int = 2
) -> DataFrame:
    """The newest distinct times of each entity, numbered 1 (newest) to `count` in `age`."""
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(ts))
    times = df.select(*keys, ts).distinct()
    return times.withColumn("age", F.row_number().over(newest_first)).where(F.col("age") <= count)


def _two_newest(
    df: DataFrame, usable: DataFrame, keys: Sequence[str], ts: str, gated: bool, few: bool
) -> tuple[DataFrame, DataFrame]:
    """Latest and previous times of each entity, found in its history."""
    times = recent_times(usable, keys, ts)
    # age is 1 or 2. Testing its parity leaves the `age <= 2` limit alone in both branches, so
    # they share one shuffle instead of planning two different ones.
    newest = F.col("age") % 2 == 1
    last_times, prev_times = times.where(newest), times.where(~newest)
    if gated:
        newest_times = broadcast_if(few, last_time(df, keys, ts))
        last_times = last_times.join(newest_times, [*keys, ts], "left_semi")
    return last_times, prev_times


def last_vs_prev(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    ts: str = "stat_time",
    ok: Column | None = None,
    few: bool = False,
    pointers: DataFrame | None = None,
) -> DataFrame:
    """Latest rows of each entity beside its previous ones.

    Gives the keys, last_/prev_ times and last_/prev_ measures; the prev_ columns are NULL where
    there is no previous snapshot. With `ok`, an entity counts only if its newest time has a row
    that satisfies it, and the previous time is the newest older one with such a row; every row
    at that previous time takes part, whether it satisfies `ok` or not. `pointers` must have been
    made of the same rows with the same `ok`.

    The input is read several times (times, last rows, previous rows): give it stored facts, not a
    frame that is costly to compute.
    """
    usable = df if ok is None else df.where(ok)
    days = None
    if pointers is None:
        last_times, prev_times = _two_newest(df, usable, keys, ts, ok is not None, few)
    else:
        # Where newest_time is later than last_time, the newest rows do not count.
        current = pointers.where(F.col("newest_time") == F.col("last_time"))
        last_times = _pointed(current, keys, "last_time", ts)
        prev_times = _pointed(current, keys, "prev_time", ts)
        # Both sides read the same days, so that they share one scan and one shuffle of the facts.
        days = current.select(F.explode(F.array(F.to_date("last_time"), F.to_date("prev_time"))).alias(DATE_COLUMN))
    last = _rows_at(usable, last_times, keys, ts, few, days)
    prev = _rows_at(df, prev_times, keys, ts, few, days)
    return _named(last, keys, [ts, *measures], "last").join(
        _named(prev, keys, [ts, *measures], "prev"), list(keys), "left"
    )


def _repeat(df: DataFrame, copies: str) -> DataFrame:
    """Each row as many times as its `copies` column says, without that column."""
    return df.withColumn(copies, F.explode(F.sequence(F.lit(1), copies))).drop(copies)


def gate_latest_ok(
    df: DataFrame,
    instances: DataFrame,
    distinct: bool = False,
    few: bool = False,
    pointers: DataFrame | None = None,
) -> DataFrame:
    """Rows of instances whose newest run succeeded.

    An instance with several successful rows at its newest time yields its rows that many times;
    `distinct=True` yields them once.
    """
    passed = latest_ok(instances, few=few, pointers=pointers).groupBy("instance_id").agg(F.count("*").alias("_runs"))
    if distinct:
        return df.join(broadcast_if(few, passed), "instance_id", "left_semi")
    return _repeat(df.join(broadcast_if(few, passed), "instance_id"), "_runs")


def aligned_last_vs_prev(
    instances: DataFrame,
    objects: DataFrame,
    object_keys: Sequence[str],
    measures: Sequence[str],
    ts: str = "stat_time",
    status: str = "collect_status",
    few: bool = False,
    pointers: DataFrame | None = None,
) -> DataFrame:
    """Objects seen in their instance's latest good run, beside the same objects in its previous one.

    Objects are anchored on the instance's times: one missing from the latest run is absent.
    Runs repeated at one time repeat their objects. `pointers` are those of the instances.
    """
    last_ts, prev_ts = f"last_{ts}", f"prev_{ts}"
    pairs = last_vs_prev(instances, ["instance_id"], [], ts, is_ok(F.col(status)), few, pointers)
    # One row per instance.
    runs = pairs.groupBy("instance_id", last_ts, prev_ts).agg(F.count("*").alias("_pairs"))
    object_key = ["instance_id", *object_keys]

    last_runs, time_key = _at_times(objects, runs.withColumn(ts, F.col(last_ts)), ts)
    objects_of_days = _of_days(objects, last_runs, few)
    last = objects_of_days.join(broadcast_if(few, last_runs), ["instance_id", *time_key]).select(
        *object_key, last_ts, prev_ts, "_pairs", *[F.col(m).alias(f"last_{m}") for m in measures]
    )
    # Only the previous runs are paired, not the whole object history.
    prev_runs = runs.select("instance_id", F.col(prev_ts).alias(ts))
    prev = _rows_at(objects, prev_runs, ["instance_id"], ts, few)
    prev = _named(prev, object_key, [ts, *measures], "prev")
    return _repeat(last.join(prev, [*object_key, prev_ts], "left"), "_pairs")


def measure_diff(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Add diff_<m> = last_<m> - prev_<m>; NULL where there is no previous value."""
    return df.withColumns({f"diff_{m}": F.col(f"last_{m}") - F.col(f"prev_{m}") for m in measures})


def daily_grain(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "stat_time",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Last snapshot of each entity and day, exactly one row; ties go to the larger tiebreak."""
    newest_first = Window.partitionBy(DATE_COLUMN, *keys).orderBy(
        F.desc(ts), *[F.desc(c) for c in tiebreak]
    )
    return (
        df.withColumn(DATE_COLUMN, F.to_date(ts))
        .withColumn("_place", F.row_number().over(newest_first))
        .where(F.col("_place") == 1)
        .drop("_place")
    )
