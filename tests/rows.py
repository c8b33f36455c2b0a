"""Small literal inputs."""

from datetime import datetime

from pyspark.sql import functions as F

GIB = 1024**3

_ASSET = (
    "instance_id bigint, type string, instance_name string, alias_name string, env string, "
    "host string, port int, auth_mode string, login_path string, is_active int"
)
_SNAP = (
    "instance_id bigint, stat_time timestamp_ntz, logical_data_bytes bigint, "
    "logical_index_bytes bigint, logical_total_bytes bigint, physical_total_bytes bigint, "
    "mysql_version string, mongo_version string, collect_status string, error_msg string"
)
_OBJ = (
    "instance_id bigint, schema_name string, table_name string, stat_time timestamp_ntz, "
    "table_rows bigint, data_bytes bigint, index_bytes bigint, total_bytes bigint"
)
_COLL = (
    "instance_id bigint, db_name string, coll_name string, stat_time timestamp_ntz, "
    "doc_count bigint, data_bytes bigint, index_bytes bigint, logical_total_bytes bigint, "
    "physical_total_bytes bigint"
)


def day(n, second=0):
    return datetime(2026, 1, n, 9, 0, second)


def assets(spark, *rows, kind="mysql"):
    """Rows of (instance_id, env)."""
    mode = "login_path" if kind == "mysql" else "mongo_uri_aes"
    full = [(i, kind, f"n{i}", f"a{i}", env, "h", 3306, mode, f"lp{i}", 1) for i, env in rows]
    return spark.createDataFrame(full, _ASSET)


def snaps(spark, *rows):
    """Rows of (instance_id, time, total bytes, status)."""
    full = [(i, t, b, 0, b, b, "8.0", "7.0", s, None if s == "ok" else "e") for i, t, b, s in rows]
    return spark.createDataFrame(full, _SNAP)


def tables(spark, *rows):
    """Rows of (instance_id, table, time, row count, total bytes)."""
    return spark.createDataFrame([(i, "s", n, t, r, b, 0, b) for i, n, t, r, b in rows], _OBJ)


def colls(spark, *rows):
    """Rows of (instance_id, collection, time, documents, total bytes)."""
    return spark.createDataFrame([(i, "d", n, t, r, b, 0, b, b) for i, n, t, r, b in rows], _COLL)


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


def lit(value, kind):
    return F.lit(value).cast(kind)
