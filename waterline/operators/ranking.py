"""Numbering, ordering and top-k.

A place in a sorted group is the count of all rows in better parts plus the place inside the own
part. A part is a band, a range of the first sort column, between two splitters: order statistics of a sample
of the band's full sort keys. Only part counts are ever looked at for a whole group, the rows themselves are
spread over its parts, so one large group is not sorted in one task, whatever its sizes have in common.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.functions import env_label, env_order, to_gb

_BANDS_PER_DOUBLING = 8
#: Rows between two splitters, about; sampled keys for each of them, so that parts are of even size.
PART_ROWS = 50_000
_OVERSAMPLING = 16
#: Splitters that are read and broadcast (for 10⁹ rows, about); more are joined by a salted shuffle.
_MOST_BROADCAST = 20_000
_SALTS = 16


def _splitters(banded: DataFrame, group: Sequence[str], part_rows: int) -> DataFrame:
    """The parts behind the first of bands of more than about part_rows rows: (group, band, part, from key, up to key).

    Sampled by a hash of the key, so equal keys count once: they share a part anyway. The sample of a band
    is a small share of its rows, known beforehand.
    """
    every = max(1, part_rows // _OVERSAMPLING)
    sampled = banded.where(F.pmod(F.xxhash64(*group, "_key"), F.lit(every)) == 0)
    by_key = Window.partitionBy(*group, "_band").orderBy("_key")
    chosen = sampled.select(*group, "_band", "_key").distinct().withColumn("_turn", F.row_number().over(by_key))
    chosen = chosen.where(F.col("_turn") % _OVERSAMPLING == 0)
    return chosen.select(
        *[F.col(g).alias(f"_of_{g}") for g in group],
        F.col("_band").alias("_of_band"),
        (F.col("_turn") / _OVERSAMPLING).cast("int").alias("_part"),
        F.col("_key").alias("_from"),
        F.lead("_key").over(by_key).alias("_to"),
    )


def _with_part(banded: DataFrame, group: Sequence[str], part_rows: int) -> DataFrame:
    """Rows with `_part`: how many splitters of their band are not behind them."""
    parts = _splitters(banded, group, part_rows)
    same = F.col("_band").eqNullSafe(F.col("_of_band"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    inside = (F.col("_from") <= F.col("_key")) & (F.col("_to").isNull() | (F.col("_key") < F.col("_to")))
    # Read once, a bounded number of rows; groups of ordinary size have none.
    few = parts.limit(_MOST_BROADCAST + 1).collect()
    if not few:
        return banded.withColumn("_part", F.lit(0))
    if len(few) <= _MOST_BROADCAST:
        known = banded.sparkSession.createDataFrame(few, parts.schema)
        joined = banded.join(F.broadcast(known), same & inside, "left")
    else:
        copies = parts.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        salted = banded.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(_SALTS)).cast("int"))
        joined = salted.join(copies, same & inside & (F.col("_salt") == F.col("_copy")), "left").drop("_salt", "_copy")
    joined = joined.withColumn("_part", F.coalesce("_part", F.lit(0)))
    return joined.drop("_from", "_to", "_of_band", *[f"_of_{g}" for g in group])


def _number(
    df: DataFrame,
    group: Sequence[str],
    band: Column,
    band_order: Column,
    key: Sequence[Column],
    part_rows: int,
) -> DataFrame:
    """Rows with `_number`, their place in the group by key, ascending."""
    keyed = df.withColumn("_band", band).withColumn("_key", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key)]))
    dealt = _with_part(keyed, group, part_rows).drop("_key")
    counts = dealt.groupBy(*group, "_band", "_part").agg(F.count("*").alias("_rows"))
    better = Window.partitionBy(*group).orderBy(band_order, "_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.select(
        *[F.col(g).alias(f"_of_{g}") for g in group],
        F.col("_band").alias("_of_band"),
        F.col("_part").alias("_of_part"),
        F.coalesce(F.sum("_rows").over(better), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*group, "_band", "_part").orderBy(*key)
    same = F.col("_band").eqNullSafe(F.col("_of_band")) & (F.col("_part") == F.col("_of_part"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return (
        dealt.withColumn("_place", F.row_number().over(inside))
        .join(starts, same)
        .withColumn("_number", F.col("_start") + F.col("_place"))
        .drop("_band", "_part", "_place", *starts.columns)
    )


def rank_objects(
    df: DataFrame,
    group: Sequence[str] = ("instance_id", "stat_time"),
    size: str = "total_bytes",
    names: Sequence[str] = ("schema_name", "table_name"),
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Add rank_no, 1 for the largest object of the group; equal sizes are ranked by name.

    Bands are ranges of the size, an eighth of a doubling each, so they follow the order; those of more than about
    part_rows rows are cut further by sampled splitters. Unknown sizes come last.
    """
    band = F.floor(F.log2(F.col(size) + 1) * _BANDS_PER_DOUBLING)
    key = [-F.col(size), *[F.col(n) for n in names]]
    ranked = _number(df, group, band, F.desc_nulls_last("_band"), key, part_rows)
    return ranked.withColumn("rank_no", F.col("_number").cast("int")).drop("_number")


def dense_numbers(df: DataFrame, keys: Sequence[str], name: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Number rows 1..n by the digest of their unique keys; the same rows get the same numbers."""
    digest = F.md5(
        F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    )
    hashed = df.withColumn("_digest", digest)
    band = F.substring("_digest", 1, 2)
    numbered = _number(hashed, [], band, F.asc("_band"), [F.col("_digest")], part_rows)
    return numbered.withColumn(name, F.col("_number")).drop("_digest", "_number")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of the whole result; planned as a per-task top-k and a merge."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rank_no"
) -> DataFrame:
    """First k rows of each group. Spark applies the limit before the shuffle as well."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(name, place).where(F.col(name) <= k)


# Report orders. Each takes the raw columns of the report before they are formatted.


def order_failed(ts: str = "stat_time") -> list[Column]:
    """Newest first, then environment in declared order, then name."""
    return [F.desc(ts), env_order(F.col("env")).asc(), F.asc("instance_name"), F.asc("instance_id")]


def order_env_diff(diff: str, total: str) -> list[Column]:
    return [F.col(diff).desc_nulls_last(), to_gb(F.col(total)).desc(), F.asc("env")]


def order_by_size(size: str, *names: str) -> list[Column]:
    """Largest GB value first, then shown environment, then names."""
    return [to_gb(F.col(size)).desc(), env_label(F.col("env")).asc(), *[F.asc(n) for n in names]]


def order_objects(size: str, *names: str) -> list[Column]:
    """Largest byte count first."""
    return [F.desc(size), env_label(F.col("env")).asc(), *[F.asc(n) for n in names]]


def order_abs_diff(last: str, prev: str, *names: str) -> list[Column]:
    """Largest change first; no previous value counts as no change."""
    change = F.abs(F.col(last) - F.col(prev))
    # A change that cannot be computed is NULL, and NULL sorts below 0.
    shown = F.when(F.col(prev).isNull(), 0).otherwise(change)
    return [shown.desc_nulls_last(), env_label(F.col("env")).asc(), *[F.asc(n) for n in names]]
