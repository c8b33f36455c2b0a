"""Stored snapshot facts: Parquet partitioned by day, append only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from waterline.functions import is_ok
from waterline.model import ASSETS, DATE_COLUMN, FACTS, TableNames
from waterline.operators.snapshots import daily_grain
from waterline.sources.scratch import scratch_path


def _stored_schema(kind: str) -> T.StructType:
    return T.StructType([*FACTS[kind].fields, T.StructField(DATE_COLUMN, T.DateType())])


def read_snapshots(
    spark: SparkSession,
    kind: str,
    path: str,
    from_date: date | str | None = None,
    to_date: date | str | None = None,
) -> DataFrame:
    """Snapshots of one fact; the dates (both inclusive) select whole partitions."""
    facts = spark.read.schema(_stored_schema(kind)).parquet(path)
    if from_date is not None:
        facts = facts.where(F.col(DATE_COLUMN) >= F.lit(from_date).cast("date"))
    if to_date is not None:
        facts = facts.where(F.col(DATE_COLUMN) <= F.lit(to_date).cast("date"))
    return facts


def _as_stored(df: DataFrame, kind: str) -> DataFrame:
    stored = df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACTS[kind].fields],
        F.to_date("stat_time").alias(DATE_COLUMN),
    )
    # Files of even size per day: Spark splits a large day and merges small ones.
    return stored.hint("rebalance", DATE_COLUMN)


def append_snapshot(df: DataFrame, kind: str, path: str) -> None:
    """Append snapshot rows, failed ones included."""
    _as_stored(df, kind).write.mode("append").partitionBy(DATE_COLUMN).parquet(path)


def append_snapshot_table(df: DataFrame, kind: str, names: TableNames) -> None:
    """Append to a table made by ensure_tables."""
    _as_stored(df, kind).write.insertInto(names.of(kind))


def replace_days(
    new: DataFrame, schema: T.StructType, path: str, merge: Callable[[DataFrame], DataFrame]
) -> None:
    """Replace the stored days that new rows fall on by what `merge` makes of their rows, stored and new.

    Only those days are read and written, each as a whole. The merged days go to the shared folder first, as a job must
    not replace files it reads; two merges of the same day must not run at once.
    """
    spark = new.sparkSession
    rows = new
    try:
        days = new.select(DATE_COLUMN).distinct()
        held = spark.read.schema(schema).parquet(path).join(days, DATE_COLUMN, "left_semi")
        rows = held.select(*new.columns).unionByName(new)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    merged = scratch_path(spark, "days")
    merge(rows).select(*new.columns).write.parquet(merged)
    days = spark.read.schema(schema).parquet(merged).hint("rebalance", DATE_COLUMN)
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE_COLUMN).parquet(path)


def merge_days(
    df: DataFrame, kind: str, path: str, keys: Sequence[str], tiebreak: Sequence[str] = ()
) -> None:
    """Merge snapshots into a table with one row for each entity and day, the last snapshot of the day.

    Only the days that the snapshots fall on are replaced (see replace_days); running the same snapshots again changes
    nothing. Ties of time go to the larger tiebreak.
    """
    new = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACTS[kind].fields])
    new = new.where(F.col("stat_time").isNotNull()).withColumn(DATE_COLUMN, F.to_date("stat_time"))
    replace_days(new, _stored_schema(kind), path, lambda rows: daily_grain(rows, keys, tiebreak=tiebreak))


def of_ok_instances(objects: DataFrame, statuses: DataFrame) -> DataFrame:
    """Object rows of the instances that the run collected without failure."""
    ok = statuses.where(is_ok(F.col("collect_status"))).select("instance_id")
    return objects.join(ok, "instance_id", "left_semi")


def append_objects(objects: DataFrame, statuses: DataFrame, kind: str, path: str) -> None:
    append_snapshot(of_ok_instances(objects, statuses), kind, path)


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_tables(
    spark: SparkSession, names: TableNames = TableNames(), location: str | None = None
) -> None:
    """Create the database and the tables that do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {names.database}")

    def create(kind: str, columns: str, partitioning: str = "") -> None:
        place = f" LOCATION '{location}/{getattr(names, kind)}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {names.of(kind)} ({columns}) "
            f"USING parquet{partitioning}{place}"
        )

    create("assets", _columns(ASSETS))
    for kind in FACTS:
        create(kind, _columns(_stored_schema(kind)), f" PARTITIONED BY ({DATE_COLUMN})")
