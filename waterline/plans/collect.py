"""Collection: catalog feeds of all instances become snapshot rows in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.functions import object_total
from waterline.model import (
    BIG_OBJECT_BYTES,
    BIG_OBJECT_ROWS,
    DOCUMENT_INSTANCES,
    DOCUMENT_OBJECTS,
    OBJECT_SYSTEM_SCHEMAS,
    RELATIONAL_INSTANCES,
    RELATIONAL_OBJECTS,
)
from waterline.operators.filters import (
    active_assets,
    base_tables,
    big_objects,
    drop_blank_keys,
    exclude_schemas,
    exclude_system_dbs,
    valid_stats,
)
from waterline.operators.ranking import rank_objects
from waterline.operators.rollups import (
    document_storage_summary,
    instance_storage_summary,
    with_totals,
)
from waterline.operators.status import derive_status
from waterline.sources.facts import of_ok_instances

ERRORS_DDL = "instance_id bigint, part string, message string"


def no_errors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ERRORS_DDL)


def _run_time(run_ts: str):
    return F.lit(run_ts).cast("timestamp_ntz")


def collect_instances(
    assets: DataFrame, table_stats: DataFrame, errors: DataFrame, run_ts: str
) -> DataFrame:
    """Relational instance snapshots: one row per active asset, failed where no feed arrived."""
    covered = active_assets(assets, "mysql", "login_path")
    summary = instance_storage_summary(table_stats).withColumn("stat_time", _run_time(run_ts))
    rows = derive_status(
        covered, summary.withColumnRenamed("mysql_version", "version"), errors, run_ts, "mysql"
    )
    return rows.select(*RELATIONAL_INSTANCES.names)


def collect_tables(
    table_stats: DataFrame,
    statuses: DataFrame,
    run_ts: str,
    min_rows: int = BIG_OBJECT_ROWS,
    min_bytes: int = BIG_OBJECT_BYTES,
) -> DataFrame:
    """Big tables of the instances that were collected without failure, ranked by size."""
    tables = base_tables(exclude_schemas(table_stats, OBJECT_SYSTEM_SCHEMAS))
    size = object_total(F.col("data_length"), F.col("index_length"))
    big = big_objects(tables, F.col("table_rows"), size, min_rows, min_bytes).select(
        _run_time(run_ts).alias("stat_time"),
        "instance_id",
        F.col("table_schema").alias("schema_name"),
        "table_name",
        "engine",
        "table_rows",
        F.coalesce("data_length", F.lit(0)).alias("data_bytes"),
        F.coalesce("index_length", F.lit(0)).alias("index_bytes"),
        size.alias("total_bytes"),
    )
    named = drop_blank_keys(of_ok_instances(big, statuses), ["schema_name", "table_name"])
    return rank_objects(named).select(*RELATIONAL_OBJECTS.names)


def collect_doc_instances(
    assets: DataFrame, db_stats: DataFrame, errors: DataFrame, run_ts: str
) -> DataFrame:
    """Document instance snapshots: one row per active asset."""
    covered = active_assets(assets, "mongodb", "mongo_uri_aes")
    summary = document_storage_summary(db_stats).withColumn("stat_time", _run_time(run_ts))
    rows = derive_status(
        covered, summary.withColumnRenamed("mongo_version", "version"), errors, run_ts, "mongodb"
    )
    return rows.select(*DOCUMENT_INSTANCES.names)


def collect_collections(
    coll_stats: DataFrame,
    statuses: DataFrame,
    run_ts: str,
    min_docs: int = BIG_OBJECT_ROWS,
    min_bytes: int = BIG_OBJECT_BYTES,
) -> DataFrame:
    """Big collections of the instances that were collected without failure."""
    seen = valid_stats(exclude_system_dbs(coll_stats, "db_name", "coll_name"))
    sized = with_totals(seen, "size", "total_index_size", "storage_size").select(
        _run_time(run_ts).alias("stat_time"),
        "instance_id",
        "db_name",
        "coll_name",
        F.coalesce("count", F.lit(0)).alias("doc_count"),
        F.coalesce("size", F.lit(0)).alias("data_bytes"),
        F.coalesce("total_index_size", F.lit(0)).alias("index_bytes"),
        "logical_total_bytes",
        "physical_total_bytes",
    )
    big = big_objects(
        sized, F.col("doc_count"), F.col("logical_total_bytes"), min_docs, min_bytes
    )
    named = drop_blank_keys(of_ok_instances(big, statuses), ["db_name", "coll_name"])
    return named.select(*DOCUMENT_OBJECTS.names)
