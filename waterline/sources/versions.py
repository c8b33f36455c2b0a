"""Tables stored in whole versions, of which the newest published one counts.

A job writes the version that replaces another one first and then publishes it by one row, so it never overwrites files
that it reads; readers see the old table until then, and a lost job leaves only files that nothing names. Before it
publishes, a job claims its version and then looks at all claims: of jobs that start from the same version at most one
publishes, the others are refused and can merge again with what was stored meanwhile.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

_PUBLISHED = "version bigint, folder string"
_CLAIMS = "version bigint, folder string, held boolean"


class StaleVersion(RuntimeError):
    """Another job has stored, or is storing, a version since the one that a result was made from."""


def _newest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Number and folder of the version that counts; none where nothing was published."""
    try:
        published = spark.read.schema(_PUBLISHED).parquet(f"{path}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = published.agg(F.max(F.struct("version", "folder")).alias("newest")).first()["newest"]
    return newest and (newest["version"], newest["folder"])


def read_version(spark: SparkSession, path: str, schema: T.StructType) -> tuple[int, DataFrame]:
    """Number and rows of the newest version; 0 and no rows before the first one."""
    newest = _newest(spark, path)
    if newest is None:
        return 0, spark.createDataFrame([], schema)
    return newest[0], spark.read.schema(schema).parquet(f"{path}/{newest[1]}")


def _claims(spark: SparkSession, path: str) -> set[tuple[int, str]]:
    """Claims that were not given back, of the newest version on: a row for each job under way."""
    try:
        claims = spark.read.schema(_CLAIMS).parquet(f"{path}/claims")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    newest = _newest(spark, path)
    open_claims = claims.where(F.col("version") > (newest[0] if newest else 0))
    held = open_claims.groupBy("version", "folder").agg(F.bool_and("held").alias("held")).where("held")
    return {(r["version"], r["folder"]) for r in held.collect()}


def _mark(spark: SparkSession, path: str, version: int, folder: str, held: bool) -> None:
    row = spark.createDataFrame([(version, folder, held)], _CLAIMS).coalesce(1)
    row.write.mode("append").parquet(f"{path}/claims")


def release_claims(spark: SparkSession, path: str) -> None:
    """Gives back the claims of jobs that were lost before they published. Not while one runs."""
    for version, folder in _claims(spark, path):
        _mark(spark, path, version, folder, held=False)


def store_version(table: DataFrame, path: str, base: int | None = None) -> int:
    """Store a whole table as the next version and publish it; gives its number. Older versions stay.

    base: the version that the table was made from, by default the newest. StaleVersion if that is not the newest any more
    or another job from it is under way; of two that start together one or both are refused.
    """
    spark = table.sparkSession
    newest = _newest(spark, path)
    current = newest[0] if newest else 0
    base = current if base is None else base
    if base != current:
        raise StaleVersion(f"version {current} was stored since version {base}")
    version = base + 1
    folder = f"version-{version:08d}-{uuid.uuid4().hex}"
    table.write.parquet(f"{path}/{folder}")
    _mark(spark, path, version, folder, held=True)
    now = _newest(spark, path)
    if (now[0] if now else 0) != base or _claims(spark, path) != {(version, folder)}:
        _mark(spark, path, version, folder, held=False)
        raise StaleVersion(f"another job from version {base} is under way")
    row = spark.createDataFrame([(version, folder)], _PUBLISHED).coalesce(1)
    row.write.mode("append").parquet(f"{path}/published")
    return version


def update_version(
    spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame], tries: int = 3
) -> int:
    """Store what `merge` makes of the newest version, merged again where another job came between."""
    for left in reversed(range(tries)):
        base, held = read_version(spark, path, schema)
        try:
            merged = merge(held).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
            return store_version(merged, path, base)
        except StaleVersion:
            if not left:
                raise
            # Jobs that refused each other must not meet again.
            time.sleep(random.uniform(0, 2 ** (tries - left)))
    raise ValueError("tries must be at least one")
