"""The stored pointer table of a fact, kept beside it in versions (see operators.pointers, sources.versions).

A run rewrites one narrow row for each entity, about as many as it appends. The facts are appended first: a run lost in
between leaves older pointers, with which reports show the run before; merging it again, or all facts, mends that. After
days were deleted from the facts the table must be made anew from them (`rebuild_pointers`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.functions import is_ok
from waterline.model import ENTITY_KEYS, FACTS, POINTER_TIMES
from waterline.operators.pointers import merged, pointers_of
from waterline.sources.facts import append_snapshot
from waterline.sources.scratch import scratch_path
from waterline.sources.versions import read_version, store_version, update_version


def pointer_schema(kind: str) -> T.StructType:
    keys = [FACTS[kind][k] for k in ENTITY_KEYS[kind]]
    return T.StructType([*keys, *[T.StructField(t, T.TimestampNTZType()) for t in POINTER_TIMES]])


def _counts(kind: str) -> Column | None:
    return is_ok(F.col("collect_status")) if "collect_status" in FACTS[kind].names else None


def read_pointers(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Pointers as last stored; empty before the first run."""
    return read_version(spark, path, pointer_schema(kind))[1]


def merge_pointers(facts: DataFrame, kind: str, path: str) -> int:
    """Merge the times of some facts into the table; gives its version. Facts merged before change nothing."""
    keys = ENTITY_KEYS[kind]
    new = pointers_of(facts, keys, _counts(kind))
    return update_version(
        facts.sparkSession, path, pointer_schema(kind), lambda held: merged(held, new, keys)
    )


def rebuild_pointers(facts: DataFrame, kind: str, path: str) -> int:
    """Make the table anew from all facts."""
    new = pointers_of(facts, ENTITY_KEYS[kind], _counts(kind))
    fields = pointer_schema(kind).fields
    return store_version(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]), path)


def append_with_pointers(df: DataFrame, kind: str, path: str, pointers_path: str) -> None:
    """Append snapshot rows and merge their times. The rows are computed once, into the shared folder."""
    spark = df.sparkSession
    run = scratch_path(spark, "run")
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACTS[kind].fields]).write.parquet(run)
    rows = spark.read.schema(FACTS[kind]).parquet(run)
    append_snapshot(rows, kind, path)
    merge_pointers(rows, kind, pointers_path)
