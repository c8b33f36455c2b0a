"""The stored asset table, in versions. A load reads the version that its result replaces (see sources.versions)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.model import ASSETS
from waterline.sources import versions
from waterline.sources.versions import StaleVersion as StaleAssets
from waterline.sources.versions import release_claims

__all__ = ["StaleAssets", "read_assets", "read_version", "release_claims", "store_assets", "update_assets"]


def read_assets(spark: SparkSession, path: str) -> DataFrame:
    """The asset table as last stored; empty before the first load."""
    return read_version(spark, path)[1]


def read_version(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """Number and rows of the asset table as last stored; 0 before the first load."""
    return versions.read_version(spark, path, ASSETS)


def store_assets(assets: DataFrame, path: str, base: int | None = None) -> int:
    """Store a whole asset table as the next version; StaleAssets where another load came between."""
    stored = assets.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ASSETS.fields])
    return versions.store_version(stored, path, base)


def update_assets(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], tries: int = 3) -> int:
    """Store what `merge` makes of the newest version, merged again where another load came between."""
    return versions.update_version(spark, path, ASSETS, merge, tries)
