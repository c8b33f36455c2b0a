"""Outcome of a collection run per instance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions import blank_to_null
from waterline.model import (
    STATUS_FAILED,
    STATUS_OK,
)

# Message texts stored with failed snapshots.
SUMMARY_FAILED = "summary_failed"
TABLES_FAILED = "top_tables_failed"
COLLECTIONS_FAILED = "collection_failed"
ACCESS_FAILED = "decrypt_failed"

_RELATIONAL_MEASURES = ("logical_data_bytes", "logical_index_bytes", "logical_total_bytes")
_DOCUMENT_MEASURES = (*_RELATIONAL_MEASURES, "physical_total_bytes")


def _errors_by_instance(errors: DataFrame) -> DataFrame:
    """One row per instance with the message of each failed part; '' where it has no text."""
    text = F.coalesce("message", F.lit(""))
    return errors.groupBy("instance_id").agg(
        *[
            F.max(F.when(F.col("part") == part, text)).alias(f"_{part}_error")
            for part in ("access", "summary", "objects")
        ]
    )


def _outcome(
    assets: DataFrame, summary: DataFrame, errors: DataFrame, measures: Sequence[str]
) -> DataFrame:
    """One row per asset, with its summary where one arrived and its reported errors."""
    arrived = summary.select(
        "instance_id", "stat_time", *measures, "version", F.lit(True).alias("_arrived")
    )
    return (
        assets.select("instance_id")
        .join(arrived, "instance_id", "left")
        .join(_errors_by_instance(errors), "instance_id", "left")
    )


def _finish(
    df: DataFrame,
    run_ts: str,
    measures: Sequence[str],
    summary_failed: Column,
    error: Column,
) -> DataFrame:
    run_time = F.lit(run_ts).cast("timestamp_ntz")
    no_time = summary_failed | F.col("stat_time").isNull()
    # Sizes that arrived are kept even if another part failed; the rest are zero.
    return df.select(
        F.when(no_time, run_time).otherwise(F.col("stat_time")).alias("stat_time"),
        "instance_id",
        *[F.coalesce(m, F.lit(0)).alias(m) for m in measures],
        "version",
        F.when(no_time | error.isNotNull(), STATUS_FAILED)
        .otherwise(STATUS_OK)
        .alias("collect_status"),
        error.alias("error_msg"),
    )


def derive_status(
    assets: DataFrame, summary: DataFrame, errors: DataFrame, run_ts: str, kind: str = "mysql"
) -> DataFrame:
    """Snapshot rows of a run, one per asset and summary row, whether it succeeded or not.

    `summary` has instance_id, stat_time, the size columns and version; an asset without a row
    failed. `errors` has instance_id, part ('access', 'summary' or 'objects') and message. Failed
    rows without a time of their own get `run_ts`, the time of the run.
    """
    if kind == "mysql":
        return _relational_status(assets, summary, errors, run_ts)
    return _document_status(assets, summary, errors, run_ts)


def _relational_status(
    assets: DataFrame, summary: DataFrame, errors: DataFrame, run_ts: str
) -> DataFrame:
    joined = _outcome(assets, summary, errors, _RELATIONAL_MEASURES)
    summary_failed = F.col("_arrived").isNull() | F.col("_summary_error").isNotNull()

    def told(label: str, message: str) -> Column:
        return F.concat_ws(": ", F.lit(label), F.nullif(message, F.lit("")))

    error = blank_to_null(
        F.concat_ws(
            "; ",
            F.when(summary_failed, told(SUMMARY_FAILED, "_summary_error")),
            F.when(F.col("_objects_error").isNotNull(), told(TABLES_FAILED, "_objects_error")),
        )
    )
    rows = _finish(joined, run_ts, _RELATIONAL_MEASURES, summary_failed, error)
    version = F.nullif("version", F.lit(""))
    return rows.withColumn("version", version).withColumnRenamed("version", "mysql_version")


def _document_status(
    assets: DataFrame, summary: DataFrame, errors: DataFrame, run_ts: str
) -> DataFrame:
    joined = _outcome(assets, summary, errors, _DOCUMENT_MEASURES)
    no_access = F.col("_access_error").isNotNull()
    incomplete = F.col("stat_time").isNull()
    for measure in _DOCUMENT_MEASURES:
        incomplete = incomplete | F.col(measure).isNull()
    summary_failed = (
        no_access | F.col("_arrived").isNull() | F.col("_summary_error").isNotNull() | incomplete
    )
    # Without access nothing else was tried, so nothing else is reported.
    error = blank_to_null(
        F.concat_ws(
            "; ",
            F.when(no_access, ACCESS_FAILED).when(summary_failed, SUMMARY_FAILED),
            F.when(~no_access & F.col("_objects_error").isNotNull(), COLLECTIONS_FAILED),
        )
    )
    rows = _finish(joined, run_ts, _DOCUMENT_MEASURES, summary_failed, error)
    version = F.coalesce("version", F.lit(""))
    return rows.withColumn("version", version).withColumnRenamed("version", "mongo_version")
