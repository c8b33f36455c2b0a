"""Row predicates of the collectors and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions import is_blank
from waterline.model import (
    BIG_OBJECT_BYTES,
    BIG_OBJECT_ROWS,
    DOCUMENT_SYSTEM_DBS,
    SYSTEM_COLLECTION_PREFIX,
)


def filter_assets(
    assets: DataFrame, type: str | None = None, auth_mode: str | None = None
) -> DataFrame:
    """Active assets, optionally of one type and one auth mode."""
    kept = assets.where(F.col("is_active") == 1)
    if type is not None:
        kept = kept.where(F.col("type") == type)
    if auth_mode is not None:
        kept = kept.where(F.col("auth_mode") == auth_mode)
    return kept


def active_assets(assets: DataFrame, type: str, auth_mode: str) -> DataFrame:
    """Assets a collection run covers: active, of the kind, with something to log in with."""
    return filter_assets(assets, type, auth_mode).where(F.col("login_path").isNotNull())


def normalize_asset_types(assets: DataFrame) -> DataFrame:
    """Write the short document type name the long way."""
    kind = F.col("type")
    return assets.withColumn("type", F.when(kind == "mongo", "mongodb").otherwise(kind))


def exclude_schemas(df: DataFrame, names: Sequence[str], schema: str = "table_schema") -> DataFrame:
    return df.where(~F.col(schema).isin(*names))


def base_tables(df: DataFrame) -> DataFrame:
    return df.where(F.col("table_type") == "BASE TABLE")


def big_objects(
    df: DataFrame,
    rows: Column,
    size: Column,
    min_rows: int = BIG_OBJECT_ROWS,
    min_bytes: int = BIG_OBJECT_BYTES,
) -> DataFrame:
    """Objects above either threshold. An unknown row count leaves the size to decide."""
    return df.where((rows > min_rows) | (size > min_bytes))


def user_databases(name: Column) -> Column:
    return ~name.isin(*DOCUMENT_SYSTEM_DBS)


def exclude_system_dbs(
    df: DataFrame, db: str = "db_name", collection: str | None = None
) -> DataFrame:
    kept = df.where(user_databases(F.col(db)))
    if collection is not None:
        kept = kept.where(~F.col(collection).startswith(SYSTEM_COLLECTION_PREFIX))
    return kept


def valid_stats(df: DataFrame, ok: str = "ok") -> DataFrame:
    """Statistics documents that report success; a missing flag is a failure."""
    return df.where(F.col(ok) == 1)


def with_status(df: DataFrame, value: str, status: str = "collect_status") -> DataFrame:
    return df.where(F.col(status) == value)


def drop_blank_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kept = df
    for name in columns:
        kept = kept.where(~is_blank(F.col(name).cast("string")))
    return kept
