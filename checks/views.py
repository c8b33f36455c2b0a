"""The given tables seen as this library's data model.

The texts in SHARED run unchanged on Spark and on DuckDB, so both sides start from equal rows.
Base tables appear in braces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("customer", "orders", "supplier", "lineitem")

_ENV = """CASE {key} % 6 WHEN 0 THEN 'MOS' WHEN 1 THEN 'Purple' WHEN 2 THEN 'RTM'
    WHEN 3 THEN 'MIB2' WHEN 4 THEN '' ELSE NULL END"""

SHARED = {
    # Customers as instances of both kinds, with blank and missing environments.
    "asset": """SELECT c_custkey AS instance_id,
    CASE WHEN c_custkey % 4 = 0 THEN 'mongodb' ELSE 'mysql' END AS type,
    c_name AS instance_name, c_mktsegment AS alias_name,
    """
    + _ENV.replace("{key}", "c_nationkey")
    + """ AS env,
    concat('host', cast(c_nationkey AS string)) AS host, 3306 AS port,
    CASE WHEN c_custkey % 28 = 0 THEN 'local_secret' WHEN c_custkey % 4 = 0 THEN 'mongo_uri_aes'
         ELSE 'login_path' END AS auth_mode,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE concat('lp_', c_name) END AS login_path,
    CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END AS is_active
FROM {customer}""",
    # Suppliers as instances, for objects with a history of their own.
    "asset_obj": """SELECT s_suppkey AS instance_id,
    CASE WHEN s_suppkey % 5 = 0 THEN 'mongodb' ELSE 'mysql' END AS type,
    s_name AS instance_name, concat('alias', cast(s_nationkey AS string)) AS alias_name,
    """
    + _ENV.replace("{key}", "s_nationkey")
    + """ AS env,
    concat('host', cast(s_nationkey AS string)) AS host, 3306 AS port,
    CASE WHEN s_suppkey % 5 = 0 THEN 'mongo_uri_aes' ELSE 'login_path' END AS auth_mode,
    concat('lp_', s_name) AS login_path,
    CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 1 END AS is_active
FROM {supplier}""",
    # Orders as instance snapshots; 'P' orders are failed runs.
    "snap": """SELECT o_custkey AS instance_id, o_orderdate AS stat_time,
    cast(round(o_totalprice * 100) AS bigint) * 8000 AS logical_data_bytes,
    cast(round(o_totalprice * 100) AS bigint) * 2000 AS logical_index_bytes,
    cast(round(o_totalprice * 100) AS bigint) * 10000 AS logical_total_bytes,
    cast(round(o_totalprice * 100) AS bigint) * 10000
        + (o_orderkey % 1000) * 1048576 AS physical_total_bytes,
    '8.0' AS mysql_version, '8.0' AS mongo_version,
    CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'ok' END AS collect_status,
    CASE WHEN o_orderstatus = 'P' THEN 'summary_failed' ELSE NULL END AS error_msg
FROM {orders}""",
    # Line items as collections stamped with the time of their instance's run.
    "coll_aligned": """SELECT o_custkey AS instance_id, l_returnflag AS db_name,
    cast(l_linenumber AS string) AS coll_name, o_orderdate AS stat_time,
    cast(l_quantity AS bigint) AS doc_count,
    cast(round(l_extendedprice * 100) AS bigint) * 10000 AS data_bytes,
    cast(l_quantity AS bigint) * 1048576 AS index_bytes,
    cast(round(l_extendedprice * 100) AS bigint) * 10000
        + cast(l_quantity AS bigint) * 1048576 AS logical_total_bytes,
    cast(round(l_extendedprice * 100) AS bigint) * 12000
        + cast(l_quantity AS bigint) * 1048576 AS physical_total_bytes
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # Line items as tables with their own history; some row counts are unknown.
    "obj": """SELECT l_suppkey AS instance_id, l_returnflag AS schema_name,
    cast(l_partkey % 20 AS string) AS table_name, l_shipdate AS stat_time,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_orderkey END AS table_rows,
    cast(round(l_extendedprice * 100) AS bigint) * 10000 AS data_bytes,
    cast(l_quantity AS bigint) * 1073741824 AS index_bytes,
    cast(round(l_extendedprice * 100) AS bigint) * 10000
        + cast(l_quantity AS bigint) * 1073741824 AS total_bytes
FROM {lineitem}""",
    "coll": """SELECT l_suppkey AS instance_id, l_returnflag AS db_name,
    cast(l_partkey % 20 AS string) AS coll_name, l_shipdate AS stat_time,
    l_orderkey AS doc_count,
    cast(round(l_extendedprice * 100) AS bigint) * 10000
        + cast(l_quantity AS bigint) * 1073741824 AS logical_total_bytes,
    cast(round(l_extendedprice * 100) AS bigint) * 12000
        + cast(l_quantity AS bigint) * 1073741824 AS physical_total_bytes
FROM {lineitem}""",
    # Runs of the suppliers, for the gate on the latest one.
    "snap_obj": """SELECT l_suppkey AS instance_id, l_shipdate AS stat_time,
    CASE WHEN l_linestatus = 'F' THEN 'ok' ELSE 'failed' END AS collect_status
FROM {lineitem}""",
    # Catalog feed with system schemas, views and unknown values.
    "table_stats": """SELECT l_suppkey AS instance_id,
    CASE WHEN l_linenumber = 7 THEN 'sys'
         WHEN l_linenumber = 6 THEN 'mysql_innodb_cluster_metadata'
         ELSE l_returnflag END AS table_schema,
    concat('t', cast(l_orderkey AS string), '_', cast(l_linenumber AS string)) AS table_name,
    CASE WHEN l_orderkey % 17 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
    'InnoDB' AS engine,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_partkey * 5000 END AS table_rows,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL
         ELSE cast(round(l_extendedprice * 100) AS bigint) * 10000 END AS data_length,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL
         ELSE cast(l_quantity AS bigint) * 1073741824 END AS index_length,
    '8.0' AS version
FROM {lineitem}""",
    # Errors reported by a run.
    "errors": """SELECT s_suppkey AS instance_id, 'objects' AS part, 'timed out' AS message
FROM {supplier} WHERE s_nationkey = 3 OR s_nationkey = 7
UNION ALL
SELECT s_suppkey AS instance_id, 'summary' AS part, 'access denied' AS message
FROM {supplier} WHERE s_nationkey = 7 OR s_nationkey = 9
UNION ALL
SELECT s_suppkey AS instance_id, 'access' AS part, NULL AS message
FROM {supplier} WHERE s_nationkey = 11""",
    # What the statistics documents hold, flat.
    "db_flat": """SELECT l_suppkey AS instance_id,
    CASE WHEN l_suppkey % 17 = 0 THEN 0 ELSE 1 END AS list_ok,
    CASE WHEN l_linenumber = 7 THEN 'config' ELSE l_returnflag END AS db_name,
    CASE WHEN l_orderkey % 19 = 0 THEN 0 WHEN l_orderkey % 23 = 0 THEN NULL ELSE 1 END AS ok,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL
         ELSE cast(round(l_extendedprice * 100) AS bigint) END AS data_size,
    cast(l_quantity AS bigint) * 1024 AS index_size,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL
         ELSE cast(round(l_extendedprice * 110) AS bigint) END AS storage_size
FROM {lineitem}""",
    "coll_flat": """SELECT l_suppkey AS instance_id,
    CASE WHEN l_suppkey % 17 = 0 THEN 0 ELSE 1 END AS list_ok,
    CASE WHEN l_linenumber = 7 THEN 'config' ELSE l_returnflag END AS db_name,
    CASE WHEN l_linenumber = 6 THEN 'system.views'
         ELSE concat('c', cast(l_orderkey AS string), '_', cast(l_linenumber AS string))
         END AS coll_name,
    CASE WHEN l_orderkey % 19 = 0 THEN 0 WHEN l_orderkey % 23 = 0 THEN NULL ELSE 1 END AS ok,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_partkey * 5000 END AS doc_count,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL
         ELSE cast(round(l_extendedprice * 100) AS bigint) * 10000 END AS size,
    cast(l_quantity AS bigint) * 1073741824 AS total_index_size,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL
         ELSE cast(round(l_extendedprice * 110) AS bigint) * 10000 END AS storage_size
FROM {lineitem}""",
    # Mixed collector output: summary lines, incomplete ones, and noise.
    "output_lines": """SELECT o_custkey AS instance_id, o_orderkey AS line_no,
    CASE WHEN o_orderstatus = 'P' THEN concat('connecting to host ', o_orderpriority)
         ELSE concat(
             concat(replace(cast(o_orderdate AS string), ' ', 'T'), '.125Z'), chr(9),
             CASE WHEN o_orderkey % 9 = 0 THEN ''
                  ELSE cast(cast(round(o_totalprice * 100) AS bigint) AS string) END, chr(9),
             cast(o_orderkey AS string), chr(9),
             cast(o_orderkey * 3 AS string), chr(9),
             cast(o_orderkey * 4 AS string), chr(9), '7.0') END AS line
FROM {orders}""",
    "times_text": """SELECT o_orderkey AS row_id,
    CASE o_orderstatus
        WHEN 'F' THEN concat(replace(cast(o_orderdate AS string), ' ', 'T'), '.250Z')
        WHEN 'O' THEN concat(replace(cast(o_orderdate AS string), ' ', 'T'), 'Z')
        ELSE cast(o_orderdate AS string) END AS raw
FROM {orders}""",
    "uris": """SELECT c_custkey AS row_id, CASE c_nationkey % 7
        WHEN 0 THEN concat('mongodb://u:p@', c_mktsegment, ':27017,second:27018/admin?w=1')
        WHEN 1 THEN concat('mongodb+srv://u:p@', c_mktsegment, '/?retryWrites=true')
        WHEN 2 THEN concat('mongodb://', c_mktsegment, ':', cast(27000 + c_custkey % 100 AS string))
        WHEN 3 THEN concat('mongodb://', c_mktsegment, '?ssl=true')
        WHEN 4 THEN concat('http://', c_mktsegment, ':80/')
        WHEN 5 THEN concat('mongodb://u:p@', c_mktsegment, ':port/db')
        ELSE concat('mongodb://u@', c_mktsegment, ',second:1') END AS uri
FROM {customer}""",
    # Orders as import records: repeated, some naming existing assets, some invalid.
    "records": """SELECT o_orderkey AS line_no, c_name AS instance_name,
    c_mktsegment AS alias_name,
    CASE o_orderpriority WHEN '2-HIGH' THEN 'MOS' WHEN '3-MEDIUM' THEN ''
        WHEN '4-NOT SPECIFIED' THEN 'Unknown'
        ELSE """
    + _ENV.replace("{key}", "c_nationkey")
    + """ END AS env,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat('host', cast(c_nationkey AS string))
        END AS host,
    CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '3306' END AS port,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 'inspector' END AS username,
    'secret' AS password,
    CASE WHEN o_orderkey % 3 = 0 THEN concat('path_', cast(o_orderkey AS string)) ELSE ''
        END AS login_path
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "doc_records": """SELECT o_orderkey AS line_no, c_name AS instance_name,
    CASE WHEN o_orderkey % 2 = 0 THEN concat('"', c_mktsegment, '"') ELSE '' END AS alias_name,
    CASE o_orderpriority WHEN '2-HIGH' THEN 'MOS' WHEN '3-MEDIUM' THEN ''
        WHEN '4-NOT SPECIFIED' THEN 'Unknown'
        ELSE """
    + _ENV.replace("{key}", "c_nationkey")
    + """ END AS env,
    CASE WHEN o_orderkey % 31 = 0 THEN 'redis' WHEN o_orderkey % 3 = 0 THEN 'mongo' ELSE ''
        END AS type,
    CASE WHEN o_orderkey % 4 = 0 THEN '0' WHEN o_orderkey % 4 = 1 THEN '' ELSE '1'
        END AS is_active,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN ''
         WHEN o_orderstatus = 'P' THEN 'http://elsewhere:80'
         ELSE concat('mongodb://u:p@host', cast(c_nationkey AS string), ':3306/db') END AS mongo_uri
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
}

def _number_forms(document: str, fields: str, turn: str) -> str:
    """The JSON text with the numbers of some fields written as doubles, exponents or wrapped 64-bit numbers."""
    found = f"\"({fields})\":(-?[0-9]+)"
    okay = "\"ok\":([0-9.]+)"
    wrapped = '"$1":{{"\\\\$numberLong":"$2"}}'
    return f"""CASE {turn} % 16
        WHEN 1 THEN regexp_replace({document}, '{found}', '"$1":$2.0')
        WHEN 2 THEN regexp_replace({document}, '{found}', '{wrapped}')
        WHEN 3 THEN regexp_replace({document}, '{found}', '"$1":$2e0')
        WHEN 5 THEN regexp_replace({document}, '{okay}', '"ok":{{{{"\\\\$numberDouble":"$1"}}}}')
        WHEN 6 THEN regexp_replace({document}, '{okay}', '"ok":{{{{"\\\\$numberInt":"$1"}}}}')
        ELSE {document} END"""


# Statistics documents as collectors land them: JSON text, here one small document per line item.
# A document lists a user database and a system one.
DOCUMENTS = {
    "db_documents": "SELECT instance_id, "
    + _number_forms("json", "dataSize|storageSize", "(index_size div 1024)")
    + """ AS document FROM (SELECT instance_id, index_size, to_json(named_struct(
    'ok', list_ok, 'version', '7.0', 'databases', array(
        named_struct('name', db_name, 'ok', ok, 'dataSize', data_size,
                     'indexSize', index_size, 'storageSize', storage_size),
        named_struct('name', 'local', 'ok', 1, 'dataSize', index_size,
                     'indexSize', index_size, 'storageSize', index_size)))) AS json
FROM {db_flat})""",
    "coll_documents": "SELECT instance_id, "
    + _number_forms("json", "count|size|totalIndexSize", "(total_index_size div 1073741824)")
    + """ AS document FROM (SELECT instance_id, total_index_size, to_json(named_struct(
    'ok', list_ok, 'databases', array(
        named_struct('name', db_name, 'collections', array(
            named_struct('name', coll_name, 'ok', ok, 'count', doc_count, 'size', size,
                         'totalIndexSize', total_index_size, 'storageSize', storage_size),
            named_struct('name', 'system.profile', 'ok', 1, 'count', doc_count, 'size', size,
                         'totalIndexSize', total_index_size,
                         'storageSize', storage_size)))))) AS json
FROM {coll_flat})""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the Parquet tables of `sf_dir`."""
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in BASE_TABLES}
    if name in SHARED:
        return spark.sql(SHARED[name].format(**tables))
    # A given table may be one row group: dealt out before its rows become text, as landed documents would be. By values,
    # as rows dealt in turn are sorted first, and into more tasks for a session that is set for larger tables.
    tasks = max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sizes = {"db_flat": "index_size", "coll_flat": "total_index_size"}
    flat = {
        v: f"(SELECT /*+ REPARTITION({tasks}, instance_id, {size}) */ * FROM ({SHARED[v].format(**tables)}))"
        for v, size in sizes.items()
    }
    return spark.sql(DOCUMENTS[name].format(**flat))


def with_views(names: list[str], body: str, monthly: bool = False) -> str:
    """SQL for the checking database: the named views as common table expressions, then `body`.

    monthly: the snapshots among them as runs of whole months.
    """
    tables = {t: t for t in BASE_TABLES}
    texts = {name: SHARED[name].format(**tables) for name in names}
    if monthly:
        month = "date_trunc('month', stat_time)::TIMESTAMP AS stat_time"
        texts = {
            name: f"SELECT * REPLACE ({month}) FROM ({text})" if "AS stat_time" in text else text
            for name, text in texts.items()
        }
    parts = [f"{name} AS ({text})" for name, text in texts.items()]
    # A body may go on with its own table expressions after a leading comma.
    return f"WITH {', '.join(parts)}{body}" if body.startswith(",") else (
        f"WITH {', '.join(parts)} {body}"
    )
