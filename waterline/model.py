"""Data model: schemas, table names, value domains and collector thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# They must equal those of the data this library reads and writes.
ASSET_TYPES = ("mysql", "redis", "mongodb")
ENVS = ("MOS", "Purple", "RTM", "MIB2")  # declaration order is also the sort order
AUTH_MODES = ("login_path", "local_secret", "secret_ref", "password", "mongo_uri_aes")
STATUS_OK = "ok"
STATUS_FAILED = "failed"
SUMMARY_SYSTEM_SCHEMAS = ("mysql", "information_schema", "performance_schema", "sys")
OBJECT_SYSTEM_SCHEMAS = SUMMARY_SYSTEM_SCHEMAS + ("mysql_innodb_cluster_metadata",)
DOCUMENT_SYSTEM_DBS = ("admin", "local", "config")
SYSTEM_COLLECTION_PREFIX = "system."
BIG_OBJECT_ROWS = 5_000_000
BIG_OBJECT_BYTES = 50 * 1024**3
RELATIONAL_DEFAULT_PORT = 3306

# Day partition of the stored facts, derived from stat_time.
DATE_COLUMN = "stat_date"


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_long, _int, _string = T.LongType(), T.IntegerType(), T.StringType()
# Snapshot times are wall-clock times without a zone.
_time = T.TimestampNTZType()

ASSETS = _schema(
    ("instance_id", _long, False),
    ("type", _string, False),
    ("instance_name", _string, False),
    ("alias_name", _string, True),
    ("env", _string, True),
    ("host", _string, False),
    ("port", _int, False),
    ("auth_mode", _string, False),
    ("username", _string, True),
    ("login_path", _string, True),
    ("secret_ref", _string, True),
    ("is_active", T.ByteType(), False),
    ("created_at", _time, False),
    ("updated_at", _time, False),
)

RELATIONAL_INSTANCES = _schema(
    ("stat_time", _time, False),
    ("instance_id", _long, False),
    ("logical_data_bytes", _long, False),
    ("logical_index_bytes", _long, False),
    ("logical_total_bytes", _long, False),
    ("mysql_version", _string, True),
    ("collect_status", _string, False),
    ("error_msg", _string, True),
)

RELATIONAL_OBJECTS = _schema(
    ("stat_time", _time, False),
    ("instance_id", _long, False),
    ("schema_name", _string, False),
    ("table_name", _string, False),
    ("engine", _string, True),
    ("table_rows", _long, True),
    ("data_bytes", _long, False),
    ("index_bytes", _long, False),
    ("total_bytes", _long, False),
    ("rank_no", _int, False),
)

DOCUMENT_INSTANCES = _schema(
    ("stat_time", _time, False),
    ("instance_id", _long, False),
    ("logical_data_bytes", _long, False),
    ("logical_index_bytes", _long, False),
    ("logical_total_bytes", _long, False),
    ("physical_total_bytes", _long, False),
    ("mongo_version", _string, False),
    ("collect_status", _string, False),
    ("error_msg", _string, True),
)

DOCUMENT_OBJECTS = _schema(
    ("stat_time", _time, False),
    ("instance_id", _long, False),
    ("db_name", _string, False),
    ("coll_name", _string, False),
    ("doc_count", _long, False),
    ("data_bytes", _long, False),
    ("index_bytes", _long, False),
    ("logical_total_bytes", _long, False),
    ("physical_total_bytes", _long, False),
)

# Fact kinds accepted by the snapshot reader and writers.
FACTS = {
    "mysql_instance": RELATIONAL_INSTANCES,
    "mysql_object": RELATIONAL_OBJECTS,
    "mongo_instance": DOCUMENT_INSTANCES,
    "mongo_object": DOCUMENT_OBJECTS,
}

# What identifies an entity of each fact.
ENTITY_KEYS = {
    "mysql_instance": ("instance_id",),
    "mysql_object": ("instance_id", "schema_name", "table_name"),
    "mongo_instance": ("instance_id",),
    "mongo_object": ("instance_id", "db_name", "coll_name"),
}

# Sizes that the day points of an instance fact keep.
POINT_SIZES = {
    "mysql_instance": ("logical_total_bytes",),
    "mongo_instance": ("logical_total_bytes", "physical_total_bytes"),
}

# Times that a pointer table keeps of each entity, beside its keys.
POINTER_TIMES = ("newest_time", "last_time", "prev_time")

TABLE_STATS = _schema(
    ("instance_id", _long, False),
    ("table_schema", _string, False),
    ("table_name", _string, False),
    ("table_type", _string, False),
    ("engine", _string, True),
    ("table_rows", _long, True),
    ("data_length", _long, True),
    ("index_length", _long, True),
    ("version", _string, True),
)

RELATIONAL_SUMMARY_LINE = _schema(
    ("stat_time", _time, True),
    ("instance_id", _long, True),
    ("logical_data_bytes", _long, True),
    ("logical_index_bytes", _long, True),
    ("logical_total_bytes", _long, True),
    ("mysql_version", _string, True),
)

RELATIONAL_OBJECT_LINE = RELATIONAL_OBJECTS

# Times stay text here: these lines carry ISO times, see functions.normalize_iso_time.
DOCUMENT_OBJECT_LINE = _schema(
    ("stat_time", _string, True),
    ("db_name", _string, True),
    ("coll_name", _string, True),
    ("doc_count", _long, True),
    ("data_bytes", _long, True),
    ("index_bytes", _long, True),
    ("logical_total_bytes", _long, True),
    ("physical_total_bytes", _long, True),
)

RELATIONAL_ASSET_RECORD = _schema(
    ("line_no", _long, False),
    ("instance_name", _string, True),
    ("alias_name", _string, True),
    ("env", _string, True),
    ("host", _string, True),
    ("port", _string, True),
    ("username", _string, True),
    ("password", _string, True),
    ("login_path", _string, True),
)

DOCUMENT_ASSET_RECORD = _schema(
    ("line_no", _long, False),
    ("instance_name", _string, True),
    ("alias_name", _string, True),
    ("env", _string, True),
    ("type", _string, True),
    ("is_active", _string, True),
    ("mongo_uri", _string, True),
)

ASSET_RECORDS = {"mysql": RELATIONAL_ASSET_RECORD, "mongodb": DOCUMENT_ASSET_RECORD}


@dataclass(frozen=True)
class TableNames:
    """Logical to physical names; pass another instance to store the data elsewhere."""

    database: str = "default"
    assets: str = "asset_instance"
    mysql_instance: str = "snap_mysql_instance_storage"
    mysql_object: str = "snap_mysql_table_topn"
    mongo_instance: str = "snap_mongo_instance_storage"
    mongo_object: str = "snap_mongo_collection_topn"

    def of(self, kind: str) -> str:
        return f"{self.database}.{getattr(self, kind)}"
