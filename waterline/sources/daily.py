"""The stored day points of an instance fact (see operators.daily), Parquet partitioned by day beside the facts.

The facts are appended first: a run lost in between leaves points without it, until it is merged. Merging a run again
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waterline.model import DATE_COLUMN, FACTS, POINT_SIZES
from waterline.operators.daily import day_points, merged_points
from waterline.sources.facts import replace_days


def points_schema(kind: str) -> T.StructType:
    ends = [T.StructField(f"{end}_time", T.TimestampNTZType()) for end in ("first", "last")]
    sizes = [
        T.StructField(f"{end}_{c}", FACTS[kind][c].dataType) for c in POINT_SIZES[kind] for end in ("first", "last")
    ]
    return T.StructType([FACTS[kind]["instance_id"], *ends, *sizes, T.StructField(DATE_COLUMN, T.DateType())])


def read_day_points(spark: SparkSession, kind: str, path: str) -> DataFrame:
    return spark.read.schema(points_schema(kind)).parquet(path)


def merge_day_points(snapshots: DataFrame, kind: str, path: str) -> None:
    """Merge the good snapshots of some runs into the points of the days they fall on."""
    sizes, keys = POINT_SIZES[kind], ["instance_id", DATE_COLUMN]
    new = day_points(snapshots, sizes).select(*points_schema(kind).names)
    replace_days(new, points_schema(kind), path, lambda rows: merged_points(rows, keys, sizes))
