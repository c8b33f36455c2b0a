"""Sums and counts per instance, environment and run. All combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions import env_label, is_ok
from waterline.model import SUMMARY_SYSTEM_SCHEMAS
from waterline.operators.filters import user_databases


def _total(value: Column, counted: Column) -> Column:
    return F.coalesce(F.sum(F.when(counted, value)), F.lit(0))


def instance_storage_summary(table_stats: DataFrame) -> DataFrame:
    """Logical sizes of each relational instance in the feed.

    A table with one unknown length is left out of the total, though its known length counts in
    its own sum. System schemas count as presence only: an instance without user tables is zero.
    """
    counted = ~F.col("table_schema").isin(*SUMMARY_SYSTEM_SCHEMAS)
    data, index = F.col("data_length"), F.col("index_length")
    return table_stats.groupBy("instance_id").agg(
        _total(data, counted).alias("logical_data_bytes"),
        _total(index, counted).alias("logical_index_bytes"),
        _total(data + index, counted).alias("logical_total_bytes"),
        F.max("version").alias("mysql_version"),
    )


def document_storage_summary(db_stats: DataFrame) -> DataFrame:
    """Logical and physical sizes of each document instance whose database list was readable."""
    counted = user_databases(F.col("db_name")) & (F.col("ok") == 1)
    data = F.coalesce("data_size", F.lit(0))
    index = F.coalesce("index_size", F.lit(0))
    storage = F.coalesce("storage_size", F.lit(0))
    sums = {
        "logical_data_bytes": data,
        "logical_index_bytes": index,
        "logical_total_bytes": data + index,
        "physical_total_bytes": storage + index,
    }
    # By version first: a greatest text beside the sums would have all entries sorted, not hashed.
    versions = db_stats.groupBy("instance_id", "version").agg(
        F.min(F.coalesce((F.col("list_ok") == 1).cast("int"), F.lit(0))).alias("_listed"),
        *[_total(value, counted).alias(name) for name, value in sums.items()],
    )
    return (
        versions.groupBy("instance_id")
        .agg(
            F.min("_listed").alias("_listed"),
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
            F.coalesce(F.max("version"), F.lit("")).alias("mongo_version"),
        )
        .where(F.col("_listed") == 1)
        .drop("_listed")
    )


def list_ok(db_stats: DataFrame) -> DataFrame:
    """rc 0 where every database list of the instance was readable, else 1."""
    failed = F.coalesce(F.col("list_ok") == 1, F.lit(False)) == F.lit(False)
    return db_stats.groupBy("instance_id").agg(F.max(failed.cast("int")).alias("rc"))


def with_totals(df: DataFrame, data: str, index: str, storage: str) -> DataFrame:
    """Logical total = data + index, physical total = storage + index, missing parts are zero."""
    part = {name: F.coalesce(name, F.lit(0)) for name in (data, index, storage)}
    return df.withColumns(
        {
            "logical_total_bytes": part[data] + part[index],
            "physical_total_bytes": part[storage] + part[index],
        }
    )


def env_rollup_diff(compared: DataFrame, size: str = "logical_total_bytes") -> DataFrame:
    """Sizes per environment, latest and previous, and the summed change.

    The change covers only instances that have a previous snapshot, so it is not the difference
    of the two sums.
    """
    last, prev = F.col(f"last_{size}"), F.col(f"prev_{size}")
    return compared.groupBy(env_label(F.col("env")).alias("env")).agg(
        F.count("*").alias("instance_count"),
        F.sum(last).alias("last_bytes"),
        F.coalesce(F.sum(prev), F.lit(0)).alias("prev_bytes"),
        F.count_if(prev.isNotNull()).alias("compared_count"),
        F.sum(last - prev).alias("diff_bytes"),
    )


def env_rollup(newest: DataFrame) -> DataFrame:
    """Logical and physical sizes per environment, whatever the status of the rows."""
    return newest.groupBy(env_label(F.col("env")).alias("env")).agg(
        F.count("*").alias("instance_count"),
        F.sum("logical_total_bytes").alias("logical_bytes"),
        F.sum("physical_total_bytes").alias("physical_bytes"),
    )


def run_summary(statuses: DataFrame, status: str = "collect_status") -> DataFrame:
    """How many instances of a run succeeded and failed."""
    ok = is_ok(F.col(status))
    return statuses.agg(
        F.count_if(ok).alias("success"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed")
    )
