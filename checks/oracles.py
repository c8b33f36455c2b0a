"""SQL that computes the same results another way, for the checking database.

The queries find times with aggregates and fetch rows by joins; these texts mark rows with
whole-partition windows and filtered aggregates instead.
"""

from __future__ import annotations

from checks.queries import GROWTH_FROM, GROWTH_TO, MIN_BYTES, MIN_ROWS, RUN_TS, RUNS, STORED
from checks.views import with_views

ORACLES: dict[str, str] = {}
_PARTS: dict[str, tuple[list[str], str]] = {}


def oracle(name: str, views: list[str], body: str) -> None:
    _PARTS[name] = views, body
    ORACLES[name] = with_views(views, body)


# Text helpers


def gb(x: str) -> str:
    return f"round(({x}) / 1073741824::DOUBLE, 2)"


def _signed(diff: str, missing: str, magnitude: str) -> str:
    return (
        f"CASE WHEN {missing} THEN '-' WHEN ({diff}) > 0 THEN '+' || {magnitude} "
        f"WHEN ({diff}) < 0 THEN '-' || {magnitude} ELSE '0' END"
    )


def gb_text(diff: str, missing: str) -> str:
    size = f"CAST(CAST({gb(f'abs({diff})')} AS DECIMAL(20,2)) AS VARCHAR)"
    return _signed(diff, missing, size)


def count_text(diff: str, missing: str) -> str:
    return _signed(diff, missing, f"CAST(abs({diff}) AS VARCHAR)")


def total(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


ENV = "coalesce(nullif(a.env, ''), '-')"


def newest(source: str, keys: str, name: str) -> str:
    return (
        f", {name} AS (SELECT * EXCLUDE (newest_time) FROM (SELECT *, max(stat_time) OVER "
        f"(PARTITION BY {keys}) AS newest_time FROM {source}) WHERE stat_time = newest_time)"
    )


def pairs(source: str, keys: str, name: str, gated: bool) -> str:
    """last (c) and prev (p) rows of each entity as structs, under the given name."""
    same = " AND ".join(f"x.{k} = t.{k}" for k in keys.split(", "))
    older = "stat_time < lt AND collect_status = 'ok'" if gated else "stat_time < lt"
    ok = " AND x.collect_status = 'ok'" if gated else ""
    return f""", {name}_times AS (
    SELECT {keys}, lt, max(stat_time) FILTER (WHERE {older}) AS pt
    FROM (SELECT *, max(stat_time) OVER (PARTITION BY {keys}) AS lt FROM {source})
    GROUP BY ALL),
{name}_last AS (SELECT t.*, x AS c FROM {name}_times t JOIN {source} x
    ON {same} AND x.stat_time = t.lt{ok}),
{name} AS (SELECT t.*, x AS p FROM {name}_last t LEFT JOIN {source} x
    ON {same} AND x.stat_time = t.pt)"""


# Reports

_ASSET = f"{ENV} AS env, a.alias_name, a.instance_name"
_MYSQL = "a.is_active = 1 AND a.type = 'mysql'"
_MONGO = "a.is_active = 1 AND a.type = 'mongodb' AND a.auth_mode = 'mongo_uri_aes'"

oracle(
    "r1_failed_instances",
    ["asset", "snap"],
    newest("snap", "instance_id", "n")
    + f""" SELECT {_ASSET}, a.host, a.port, n.stat_time AS last_stat_time,
    {gb("n.logical_total_bytes")} AS logical_total_gb, n.mysql_version,
    n.collect_status AS last_collect_status, n.error_msg
FROM n JOIN asset a USING (instance_id) WHERE a.is_active = 1 AND n.collect_status = 'failed'""",
)
_R2_DIFF = "(s.c.logical_total_bytes - s.p.logical_total_bytes)"
oracle(
    "r2_env_summary",
    ["asset", "snap"],
    pairs("snap", "instance_id", "s", True)
    + f""", e AS (SELECT {ENV} AS env, count(*) AS n, sum(s.c.logical_total_bytes) AS l,
    sum(s.p.logical_total_bytes) AS p, sum({_R2_DIFF}) AS d
    FROM s JOIN asset a USING (instance_id) WHERE {_MYSQL} GROUP BY 1)
SELECT env, n AS instance_count, {gb("l")} AS last_env_total_gb,
    {gb("coalesce(p, 0)")} AS prev_env_total_gb,
    {gb_text("d", "p IS NULL")} AS diff_env_total_gb_fmt FROM e""",
)


def _sizes(measure: str, shown: str, missing: str | None = None) -> str:
    last, prev = f"s.c.{measure}", f"s.p.{measure}"
    diff = gb_text(f"({last} - {prev})", missing or f"{prev} IS NULL")
    return (
        f"{gb(last)} AS last_{shown}_gb, {gb(prev)} AS prev_{shown}_gb, "
        f"{diff} AS diff_{shown}_gb_fmt"
    )


_TIMES = "s.c.stat_time AS last_stat_time, s.p.stat_time AS prev_stat_time"
_NO_PREV = "s.p.stat_time IS NULL"
_R3_SIZES = ", ".join(
    _sizes(f"logical_{m}_bytes", m, _NO_PREV) for m in ("data", "index", "total")
)


def _instance_pairs(columns: str, condition: str) -> str:
    return (
        pairs("snap", "instance_id", "s", True)
        + f" SELECT {_ASSET}, {columns}, {_TIMES} FROM s JOIN asset a USING (instance_id)"
        + f" WHERE {condition}"
    )


oracle("r3_instance_diff", ["asset", "snap"], _instance_pairs(_R3_SIZES, _MYSQL))
oracle(
    "r3_by_abs_diff", ["asset", "snap"], _instance_pairs(f"a.host, a.port, {_R3_SIZES}", _MYSQL)
)
_R8_SIZES = ", ".join(
    _sizes(f"{m}_total_bytes", f"{m}_total", _NO_PREV) for m in ("logical", "physical")
)
oracle("r8_doc_instance_diff", ["asset", "snap"], _instance_pairs(_R8_SIZES, _MONGO))
oracle(
    "r8_with_endpoint", ["asset", "snap"], _instance_pairs(f"a.host, a.port, {_R8_SIZES}", _MONGO)
)

_TABLE = "instance_id, schema_name, table_name"
_GATE = newest("snap_obj", "instance_id", "runs") + (
    ", good AS (SELECT instance_id FROM runs WHERE collect_status = 'ok')"
)
oracle(
    "r4_object_latest",
    ["asset_obj", "snap_obj", "obj"],
    newest("obj", _TABLE, "n")
    + _GATE
    + f""" SELECT {_ASSET}, n.schema_name, n.table_name, n.table_rows AS last_table_rows,
    {gb("n.data_bytes")} AS last_data_gb, {gb("n.index_bytes")} AS last_index_gb,
    {gb("n.total_bytes")} AS last_total_gb, n.stat_time AS last_stat_time
FROM n JOIN asset_obj a USING (instance_id) JOIN good USING (instance_id) WHERE {_MYSQL}""",
)
_ROWS_DIFF = count_text("(s.c.table_rows - s.p.table_rows)", "s.p.table_rows IS NULL")
_BYTES_DIFF = gb_text("(s.c.total_bytes - s.p.total_bytes)", "s.p.total_bytes IS NULL")


def _table_pairs(columns: str) -> str:
    return (
        pairs("obj", _TABLE, "s", False)
        + _GATE
        + f" SELECT {columns}, s.schema_name, s.table_name, {_TIMES} FROM s"
        + f" JOIN asset_obj a USING (instance_id) JOIN good USING (instance_id) WHERE {_MYSQL}"
    )


_OBJ_VIEWS = ["asset_obj", "snap_obj", "obj"]
oracle(
    "r5_object_diff_rows",
    _OBJ_VIEWS,
    _table_pairs(
        f"""{ENV} AS env, a.alias_name AS instance_name, {_BYTES_DIFF} AS diff_total_fmt,
    {_ROWS_DIFF} AS diff_rows_fmt, {gb("s.c.total_bytes")} AS last_total,
    {gb("s.p.total_bytes")} AS prev_total, s.c.table_rows AS last_rows,
    s.p.table_rows AS prev_rows"""
    ),
)
oracle(
    "r5_object_diff_bytes",
    _OBJ_VIEWS,
    _table_pairs(
        f"""{_ASSET}, {_sizes("total_bytes", "total")}, {_ROWS_DIFF} AS diff_table_rows_fmt,
    s.c.table_rows AS last_table_rows, s.p.table_rows AS prev_table_rows"""
    ),
)
oracle(
    "r5_object_diff_wide",
    _OBJ_VIEWS,
    _table_pairs(
        f"""{_ASSET}, {_sizes("data_bytes", "data")}, {_sizes("index_bytes", "index")},
    {_sizes("total_bytes", "total")}, {_ROWS_DIFF} AS diff_table_rows_fmt,
    s.c.table_rows AS last_table_rows, s.p.table_rows AS prev_table_rows"""
    ),
)


def _doc_latest(condition: str) -> str:
    return (
        newest("snap", "instance_id", "n")
        + f""" SELECT {_ASSET}, n.stat_time AS last_stat_time,
    {gb("n.logical_total_bytes")} AS logical_total_gb,
    {gb("n.physical_total_bytes")} AS physical_total_gb, n.mongo_version,
    n.collect_status AS last_collect_status, n.error_msg
FROM n JOIN asset a USING (instance_id) WHERE {condition}"""
    )


oracle(
    "r6_doc_failed_latest",
    ["asset", "snap"],
    _doc_latest(f"{_MONGO} AND n.collect_status = 'failed'"),
)
oracle("r6_doc_latest_any", ["asset", "snap"], _doc_latest(_MONGO))
oracle(
    "r7_doc_env_summary",
    ["asset", "snap"],
    newest("snap", "instance_id", "n")
    + f""" SELECT {ENV} AS env, count(*) AS instance_count,
    {gb("sum(n.logical_total_bytes)")} AS last_env_logical_total_gb,
    {gb("sum(n.physical_total_bytes)")} AS last_env_physical_total_gb
FROM n JOIN asset a USING (instance_id) WHERE {_MONGO} GROUP BY 1""",
)
_COLL = "instance_id, db_name, coll_name"
oracle(
    "r9_doc_top50",
    ["asset_obj", "coll"],
    newest("coll", _COLL, "n")
    + f""" SELECT {_ASSET}, n.db_name, n.coll_name, n.doc_count,
    {gb("n.logical_total_bytes")} AS logical_total_gb,
    {gb("n.physical_total_bytes")} AS physical_total_gb
FROM n JOIN asset_obj a USING (instance_id) WHERE {_MONGO}
ORDER BY {gb("n.logical_total_bytes")} DESC, n.instance_id, n.db_name, n.coll_name,
    n.logical_total_bytes DESC, n.physical_total_bytes DESC, n.doc_count DESC LIMIT 50""",
)

_ALIGNED = (
    pairs("snap", "instance_id", "i", True)
    + """, s AS (SELECT i.instance_id, i.lt, i.p.stat_time AS pt, x.db_name, x.coll_name, x AS c,
    y AS p FROM i JOIN coll_aligned x ON x.instance_id = i.instance_id AND x.stat_time = i.lt
    LEFT JOIN coll_aligned y ON y.instance_id = i.instance_id AND y.db_name = x.db_name
    AND y.coll_name = x.coll_name AND y.stat_time = i.p.stat_time)"""
)
_R10_MEASURES = (
    "doc_count", "data_bytes", "index_bytes", "logical_total_bytes", "physical_total_bytes"
)
_R10_ORDER = (
    "CASE WHEN s.p.doc_count IS NULL THEN 0 ELSE abs(s.c.doc_count - s.p.doc_count) END DESC, "
    f"{ENV}, a.alias_name, a.instance_name, s.db_name, s.coll_name, s.instance_id, "
    + ", ".join(f"s.{side}.{m} DESC NULLS LAST" for side in "cp" for m in _R10_MEASURES)
)
_NO_DOCS = "s.p.doc_count IS NULL"
_DOCS_DIFF = count_text("(s.c.doc_count - s.p.doc_count)", _NO_DOCS)
_R10_SIZES = {
    shown: _sizes(measure, shown, _NO_DOCS)
    for measure, shown in zip(_R10_MEASURES[1:], ("data", "index", "total", "physical"))
}


def _two(sizes: str) -> str:
    """last_ and prev_ of a _sizes text."""
    return sizes[: sizes.index(", CASE")]


_R10_TAIL = f"""s.c.doc_count AS last_doc_count, s.p.doc_count AS prev_doc_count,
    {_DOCS_DIFF} AS diff_doc_count_fmt, s.db_name, s.coll_name, s.lt AS last_stat_time,
    s.pt AS prev_stat_time
FROM s JOIN asset a USING (instance_id) WHERE {_MONGO} ORDER BY {_R10_ORDER} LIMIT 10"""
_R10_VIEWS = ["asset", "snap", "coll_aligned"]
oracle(
    "r10_doc_diff_top10",
    _R10_VIEWS,
    _ALIGNED
    + f""" SELECT {ENV} AS env, a.alias_name, {_two(_R10_SIZES["data"])},
    {_two(_R10_SIZES["index"])}, {_R10_SIZES["total"]}, {_two(_R10_SIZES["physical"])},
    {_R10_TAIL}""",
)
oracle(
    "r10_doc_diff_wide",
    _R10_VIEWS,
    _ALIGNED
    + f""" SELECT {_ASSET}, {_R10_SIZES["data"]}, {_R10_SIZES["index"]}, {_R10_SIZES["total"]},
    {_two(_R10_SIZES["physical"])}, {_R10_TAIL}""",
)

# Collection

_RUN = f"TIMESTAMP '{RUN_TS}'"
_SYSTEM4 = "('mysql', 'information_schema', 'performance_schema', 'sys')"
_SYSTEM5 = _SYSTEM4[:-1] + ", 'mysql_innodb_cluster_metadata')"
_SUMMARY = f""", summary AS (SELECT instance_id,
    CAST(coalesce(sum(data_length) FILTER (table_schema NOT IN {_SYSTEM4}), 0) AS BIGINT)
        AS logical_data_bytes,
    CAST(coalesce(sum(index_length) FILTER (table_schema NOT IN {_SYSTEM4}), 0) AS BIGINT)
        AS logical_index_bytes,
    CAST(coalesce(sum(data_length + index_length) FILTER (table_schema NOT IN {_SYSTEM4}), 0)
        AS BIGINT) AS logical_total_bytes, max(version) AS mysql_version
    FROM table_stats GROUP BY instance_id)"""
_FAILS = """, fails AS (SELECT instance_id,
    max(CASE WHEN part = 'access' THEN coalesce(message, '') END) AS access_error,
    max(CASE WHEN part = 'summary' THEN coalesce(message, '') END) AS summary_error,
    max(CASE WHEN part = 'objects' THEN coalesce(message, '') END) AS objects_error
    FROM errors GROUP BY instance_id)"""


def _told(label: str, message: str) -> str:
    return f"concat('{label}', CASE WHEN {message} <> '' THEN ': ' || {message} ELSE '' END)"


def _relational_status(assets: str, time: str) -> str:
    """Snapshot rows of a relational run as `statuses`."""
    return (
        _SUMMARY
        + _FAILS
        + f""", told AS (SELECT a.instance_id, s.instance_id IS NULL AS absent, s.*
        EXCLUDE (instance_id), f.objects_error,
        s.instance_id IS NULL OR f.summary_error IS NOT NULL AS no_summary,
        CASE WHEN s.instance_id IS NULL OR f.summary_error IS NOT NULL
            THEN {_told("summary_failed", "f.summary_error")} END AS m1,
        CASE WHEN f.objects_error IS NOT NULL
            THEN {_told("top_tables_failed", "f.objects_error")} END AS m2
    FROM {assets} a LEFT JOIN summary s USING (instance_id) LEFT JOIN fails f USING (instance_id)
    WHERE {_MYSQL} AND a.auth_mode = 'login_path' AND a.login_path IS NOT NULL),
statuses AS (SELECT CASE WHEN no_summary THEN {_RUN} ELSE {time} END AS stat_time, instance_id,
    coalesce(logical_data_bytes, 0) AS logical_data_bytes,
    coalesce(logical_index_bytes, 0) AS logical_index_bytes,
    coalesce(logical_total_bytes, 0) AS logical_total_bytes, mysql_version,
    CASE WHEN m1 IS NULL AND m2 IS NULL THEN 'ok' ELSE 'failed' END AS collect_status,
    nullif(concat_ws('; ', m1, m2), '') AS error_msg FROM told)"""
    )


oracle(
    "c1_instance_summary",
    ["asset", "table_stats", "errors"],
    _relational_status("asset", _RUN) + " SELECT * FROM statuses",
)
oracle(
    "p11_status_relational",
    ["asset_obj", "table_stats", "errors"],
    _relational_status("asset_obj", "TIMESTAMP '1999-01-01 00:00:00'") + " SELECT * FROM statuses",
)
oracle(
    "c2_big_tables_ranked",
    ["asset_obj", "table_stats", "errors"],
    _relational_status("asset_obj", _RUN)
    + f""", big AS (SELECT *, coalesce(data_length, 0) + coalesce(index_length, 0) AS total_bytes
    FROM table_stats WHERE table_type = 'BASE TABLE' AND table_schema NOT IN {_SYSTEM5})
SELECT {_RUN} AS stat_time, instance_id, table_schema AS schema_name, table_name, engine,
    table_rows, coalesce(data_length, 0) AS data_bytes, coalesce(index_length, 0) AS index_bytes,
    total_bytes, CAST(row_number() OVER (PARTITION BY instance_id
        ORDER BY total_bytes DESC, table_schema, table_name) AS INTEGER) AS rank_no
FROM big SEMI JOIN (SELECT instance_id FROM statuses WHERE collect_status = 'ok') USING (instance_id)
WHERE table_rows > {MIN_ROWS} OR total_bytes > {MIN_BYTES}""",
)
_DOC_SUMMARY = """, summary AS (SELECT instance_id,
    CAST(coalesce(sum(coalesce(data_size, 0)) FILTER (good), 0) AS BIGINT) AS logical_data_bytes,
    CAST(coalesce(sum(index_size) FILTER (good), 0) AS BIGINT) AS logical_index_bytes,
    CAST(coalesce(sum(coalesce(data_size, 0) + index_size) FILTER (good), 0) AS BIGINT)
        AS logical_total_bytes,
    CAST(coalesce(sum(coalesce(storage_size, 0) + index_size) FILTER (good), 0) AS BIGINT)
        AS physical_total_bytes, '7.0' AS mongo_version
    FROM (SELECT *, coalesce(ok, 0) = 1 AND db_name <> 'config' AS good FROM db_flat
          WHERE list_ok = 1) GROUP BY instance_id)"""


def _document_status(assets: str, condition: str, time: str) -> str:
    return (
        _FAILS
        + f""", told AS (SELECT a.instance_id, s.* EXCLUDE (instance_id),
        {time} AS given_time, f.access_error IS NOT NULL AS no_access,
        f.objects_error IS NOT NULL AS no_objects,
        s.instance_id IS NULL OR f.summary_error IS NOT NULL OR {time} IS NULL AS no_summary
    FROM {assets} a LEFT JOIN summary s USING (instance_id) LEFT JOIN fails f USING (instance_id)
    WHERE {condition}),
statuses AS (SELECT CASE WHEN no_access OR no_summary THEN {_RUN} ELSE given_time END AS stat_time,
    instance_id, coalesce(logical_data_bytes, 0) AS logical_data_bytes,
    coalesce(logical_index_bytes, 0) AS logical_index_bytes,
    coalesce(logical_total_bytes, 0) AS logical_total_bytes,
    coalesce(physical_total_bytes, 0) AS physical_total_bytes,
    coalesce(mongo_version, '') AS mongo_version,
    CASE WHEN no_access OR no_summary OR no_objects THEN 'failed' ELSE 'ok' END AS collect_status,
    CASE WHEN no_access THEN 'decrypt_failed' ELSE nullif(concat_ws('; ',
        CASE WHEN no_summary THEN 'summary_failed' END,
        CASE WHEN no_objects THEN 'collection_failed' END), '') END AS error_msg FROM told)"""
    )


_ACTIVE_DOC = f"{_MONGO} AND a.login_path IS NOT NULL"
oracle(
    "c3_doc_instance_summary",
    ["asset_obj", "db_flat", "errors"],
    _DOC_SUMMARY + _document_status("asset_obj", _ACTIVE_DOC, _RUN) + " SELECT * FROM statuses",
)
oracle(
    "c4_doc_big_collections",
    ["asset_obj", "db_flat", "coll_flat", "errors"],
    _DOC_SUMMARY
    + _document_status("asset_obj", _ACTIVE_DOC, _RUN)
    + f""", sized AS (SELECT *, coalesce(size, 0) + total_index_size AS logical_total_bytes,
    coalesce(storage_size, 0) + total_index_size AS physical_total_bytes FROM coll_flat
    WHERE list_ok = 1 AND ok = 1 AND db_name <> 'config' AND NOT starts_with(coll_name, 'system.'))
SELECT {_RUN} AS stat_time, instance_id, db_name, coll_name, coalesce(doc_count, 0) AS doc_count,
    coalesce(size, 0) AS data_bytes, total_index_size AS index_bytes, logical_total_bytes,
    physical_total_bytes
FROM sized SEMI JOIN (SELECT instance_id FROM statuses WHERE collect_status = 'ok')
    USING (instance_id)
WHERE coalesce(doc_count, 0) > {MIN_ROWS} OR logical_total_bytes > {MIN_BYTES}""",
)

# Sources and sinks

oracle(
    "s1_table_stats_scan",
    ["table_stats"],
    """SELECT instance_id, table_schema, table_name, table_type, engine, table_rows, data_length,
    index_length, version FROM table_stats""",
)
oracle(
    "s2_db_stats_scan",
    ["db_flat"],
    """SELECT instance_id, CAST(list_ok AS DOUBLE) AS list_ok, '7.0' AS version, db_name,
    CAST(ok AS DOUBLE) AS ok, data_size, index_size, storage_size FROM db_flat
UNION ALL SELECT instance_id, CAST(list_ok AS DOUBLE), '7.0', 'local', 1::DOUBLE, index_size,
    index_size, index_size FROM db_flat""",
)
oracle(
    "s3_coll_stats_scan",
    ["coll_flat"],
    """SELECT instance_id, db_name, coll_name, CAST(ok AS DOUBLE) AS ok, doc_count AS count, size,
    total_index_size, storage_size FROM coll_flat WHERE list_ok = 1
UNION ALL SELECT instance_id, db_name, 'system.profile', 1::DOUBLE, doc_count, size,
    total_index_size, storage_size FROM coll_flat WHERE list_ok = 1""",
)
oracle(
    "s4_active_assets",
    ["asset"],
    f"""SELECT * FROM asset a WHERE {_MYSQL} AND auth_mode = 'login_path'
    AND login_path IS NOT NULL""",
)
_MONTH = "date_trunc('month', stat_time)::TIMESTAMP"
_RUN_RANK = """CAST(row_number() OVER (PARTITION BY instance_id, stat_time ORDER BY total_bytes DESC,
    schema_name, table_name, data_bytes, table_rows NULLS FIRST) AS INTEGER)"""
_RANKED_FACT = f"""stat_time, instance_id, schema_name, table_name, 'InnoDB' AS engine, table_rows,
    data_bytes, index_bytes, total_bytes, {_RUN_RANK} AS rank_no, CAST(stat_time AS DATE) AS stat_date"""
_MONTHLY = f", monthly AS (SELECT * REPLACE ({_MONTH} AS stat_time) FROM {{}})"
_MYSQL_FACT = """stat_time, instance_id, logical_data_bytes, logical_index_bytes,
    logical_total_bytes, mysql_version, collect_status, error_msg,
    CAST(stat_time AS DATE) AS stat_date"""
_RUNS = ", ".join(f"(TIMESTAMP '{t}')" for t in RUNS)
_RUN_ROWS = (
    _relational_status("asset_obj", _RUN)
    + f""", facts AS (SELECT s.* REPLACE (r.stat_time AS stat_time)
    FROM statuses s CROSS JOIN (VALUES {_RUNS}) r(stat_time))"""
)
_RUN_VIEWS = ["asset_obj", "table_stats", "errors"]
oracle(
    "s5_snapshot_scan_dates",
    _RUN_VIEWS,
    _RUN_ROWS
    + f""" SELECT {_MYSQL_FACT} FROM facts
WHERE CAST(stat_time AS DATE) BETWEEN DATE '{RUNS[1][:10]}' AND DATE '{RUNS[2][:10]}'""",
)
oracle(
    "s6_tsv_import",
    ["obj"],
    """SELECT stat_time, instance_id, schema_name, table_name, 'InnoDB' AS engine, table_rows,
    data_bytes, index_bytes, total_bytes, 1 AS rank_no FROM obj""",
)
oracle(
    "s6_summary_lines",
    ["snap"],
    """SELECT stat_time, instance_id, logical_data_bytes, logical_index_bytes,
    CASE WHEN collect_status = 'ok' THEN logical_total_bytes END AS logical_total_bytes,
    CASE WHEN collect_status = 'ok' THEN mysql_version END AS mysql_version FROM snap""",
)
oracle(
    "s6_collection_lines",
    ["coll_aligned"],
    """SELECT stat_time, db_name, coll_name, doc_count, data_bytes, index_bytes, logical_total_bytes,
    physical_total_bytes FROM coll_aligned""",
)
oracle(
    "s7_output_lines",
    ["output_lines"],
    """SELECT instance_id, row_number() OVER (PARTITION BY instance_id ORDER BY line_no) AS line_no, line
FROM output_lines""",
)
_PICKED = """, f AS (SELECT instance_id, string_split(arg_max(line, line_no), chr(9)) AS f
    FROM output_lines WHERE len(string_split(line, chr(9))) >= 6 GROUP BY instance_id),
summary AS (SELECT instance_id,
    CASE WHEN f[2] <> '' THEN CAST(replace(split_part(f[1], '.', 1), 'T', ' ') AS TIMESTAMP) END
        AS stat_time,
    TRY_CAST(f[2] AS BIGINT) AS logical_data_bytes, CAST(f[3] AS BIGINT) AS logical_index_bytes,
    CAST(f[4] AS BIGINT) AS logical_total_bytes, CAST(f[5] AS BIGINT) AS physical_total_bytes,
    f[6] AS version, f[2] <> '' AS complete FROM f)"""
oracle("s7_pick_summary_line", ["output_lines"], _PICKED + " SELECT * FROM summary")
oracle("s7_summary_of_files", ["output_lines"], _PICKED + " SELECT * FROM summary")
oracle(
    "p11_status_document",
    ["asset", "output_lines", "errors"],
    _PICKED.replace("summary AS", "picked AS")
    + """, summary AS (SELECT * EXCLUDE (version, complete, stat_time), stat_time AS line_time,
    version AS mongo_version FROM picked)"""
    + _document_status("asset", "a.is_active = 1", "line_time")
    + " SELECT * FROM statuses",
)
oracle("s8_asset_records", ["records"], "SELECT * FROM records")
oracle("k1_snapshot_append_roundtrip", _RUN_VIEWS, _RUN_ROWS + f" SELECT {_MYSQL_FACT} FROM facts")
oracle(
    "k2_objects_append_roundtrip",
    _RUN_VIEWS,
    _relational_status("asset_obj", _RUN)
    + f""", big AS (SELECT *, coalesce(data_length, 0) + coalesce(index_length, 0) AS total_bytes
    FROM table_stats WHERE table_type = 'BASE TABLE' AND table_schema NOT IN {_SYSTEM5})
SELECT r.stat_time, instance_id, table_schema AS schema_name, table_name, engine,
    table_rows, coalesce(data_length, 0) AS data_bytes, coalesce(index_length, 0) AS index_bytes,
    total_bytes, CAST(row_number() OVER (PARTITION BY instance_id, r.stat_time
        ORDER BY total_bytes DESC, table_schema, table_name) AS INTEGER) AS rank_no,
    CAST(r.stat_time AS DATE) AS stat_date
FROM big SEMI JOIN (SELECT instance_id FROM statuses WHERE collect_status = 'ok') USING (instance_id)
CROSS JOIN (VALUES {_RUNS}) r(stat_time)
WHERE table_rows > {MIN_ROWS} OR total_bytes > {MIN_BYTES}""",
)
oracle("k6_tables_roundtrip", ["obj"], _MONTHLY.format("obj") + f" SELECT {_RANKED_FACT} FROM monthly")
oracle("k3_tsv_export_roundtrip", ["asset", "snap"], _instance_pairs(_R3_SIZES, _MYSQL))

_FILLED = """, filled AS (SELECT line_no, 'mysql' AS type, instance_name, alias_name,
    nullif(env, '') AS env, nullif(host, '') AS host,
    CAST(coalesce(nullif(port, ''), '3306') AS INTEGER) AS port, username,
    nullif(login_path, '') AS login_path FROM records),
judged AS (SELECT *, CASE WHEN host IS NULL OR username IS NULL THEN 'missing_required'
    WHEN env NOT IN ('MOS', 'Purple', 'RTM', 'MIB2') THEN 'invalid_env' END AS reject_reason
    FROM filled)"""
_FLAG = "CASE is_active WHEN '' THEN 1 ELSE CAST(is_active AS INTEGER) END"
_DOC_FILLED = f""", filled AS (SELECT line_no, instance_name,
    nullif(trim(alias_name, '"'), '') AS alias_name, nullif(env, '') AS env,
    nullif(type, '') AS type, {_FLAG} AS is_active, nullif(mongo_uri, '') AS mongo_uri,
    CASE WHEN starts_with(mongo_uri, 'mongodb://')
        THEN regexp_extract(mongo_uri, '@([^:/]*)', 1) WHEN mongo_uri <> '' THEN '' END AS host,
    CASE WHEN starts_with(mongo_uri, 'mongodb://') THEN 3306 ELSE 0 END AS port FROM doc_records),
judged AS (SELECT *, CASE WHEN type <> 'mongo' THEN 'unexpected_type'
    WHEN mongo_uri IS NULL THEN 'missing_uri'
    WHEN env NOT IN ('MOS', 'Purple', 'RTM', 'MIB2') THEN 'invalid_env'
    WHEN host = '' THEN 'invalid_uri' END AS reject_reason FROM filled)"""
_JUDGED = """ SELECT line_no, instance_name, env, host, port, reject_reason FROM judged"""
oracle("f10_asset_validate", ["records"], _FILLED + _JUDGED)
oracle("f10_asset_validate_document", ["doc_records"], _DOC_FILLED + _JUDGED)
oracle(
    "p10_asset_defaults_relational",
    ["records"],
    _FILLED + " SELECT line_no, type, env, host, port, username, login_path FROM filled",
)
oracle(
    "p10_asset_defaults_document",
    ["doc_records"],
    _DOC_FILLED
    + """ SELECT line_no, alias_name, env, type, is_active, host, port FROM filled""",
)


def _new_id(keys: str) -> str:
    digest = "md5(concat_ws('|', {}))".format(
        ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys.split(", "))
    )
    return (
        f"(SELECT max(instance_id) FROM asset) + row_number() OVER (ORDER BY {digest})"
    )


_NATURAL = "type, env, host, port, instance_name"
_MATCH = " AND ".join(
    f"g.{k} IS NOT DISTINCT FROM a.{k}" for k in _NATURAL.split(", ")
)
_FILL = (
    _FILLED
    + f""", g AS (SELECT {_NATURAL}, arg_min(alias_name, line_no) AS alias_name,
    arg_min(username, line_no) AS username, list(login_path ORDER BY line_no) AS paths
    FROM judged WHERE reject_reason IS NULL GROUP BY ALL),
hits AS (SELECT min(a.instance_id) AS instance_id, any_value(g.paths[1]) AS path
    FROM g JOIN asset a ON {_MATCH} GROUP BY {", ".join("g." + k for k in _NATURAL.split(", "))}),
kept AS (SELECT a.*, h.instance_id IS NOT NULL AND a.login_path IS NULL AS changed, h.path
    FROM asset a LEFT JOIN hits h USING (instance_id)),
fresh AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM asset a WHERE {_MATCH}))"""
)
_FILL_VIEWS = ["asset", "records"]
oracle(
    "k4_asset_upsert_fill",
    _FILL_VIEWS,
    _FILL
    + f""" SELECT instance_id, type, instance_name, alias_name, env, host, port, auth_mode,
    'root' AS username, CASE WHEN changed THEN coalesce(path, instance_name) ELSE login_path END
    AS login_path, CAST(is_active AS TINYINT) AS is_active, {_RUN} AS created_at,
    {_RUN} AS updated_at FROM kept
UNION ALL SELECT {_new_id(_NATURAL)}, type, instance_name, alias_name, env, host, port,
    'login_path', username, coalesce(paths[1], CASE WHEN len(paths) > 1
        THEN coalesce(paths[2], instance_name) END), 1::TINYINT, {_RUN}, {_RUN} FROM fresh""",
)
oracle(
    "k4_asset_upsert_fill_on_insert",
    _FILL_VIEWS,
    _FILL
    + f""" SELECT instance_id, instance_name, env,
    CASE WHEN changed THEN coalesce(path, instance_name) ELSE login_path END AS login_path FROM kept
UNION ALL SELECT {_new_id(_NATURAL)}, instance_name, env, coalesce(paths[1], instance_name)
    FROM fresh""",
)
oracle(
    "k5_asset_upsert_overwrite",
    ["asset", "doc_records"],
    _DOC_FILLED
    + f""", g AS (SELECT * REPLACE ('mongodb' AS type) FROM judged WHERE reject_reason IS NULL
    QUALIFY row_number() OVER (PARTITION BY env, host, port, instance_name
        ORDER BY line_no DESC) = 1),
hits AS (SELECT a.instance_id, g AS g FROM g JOIN asset a ON {_MATCH}),
fresh AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM asset a WHERE {_MATCH}))
SELECT a.instance_id, type, instance_name,
    CASE WHEN h.instance_id IS NULL THEN alias_name ELSE h.g.alias_name END AS alias_name,
    env, host, port, CASE WHEN h.instance_id IS NULL THEN auth_mode ELSE 'mongo_uri_aes' END
    AS auth_mode, 'root' AS username,
    CASE WHEN h.instance_id IS NULL THEN login_path ELSE h.g.mongo_uri END AS login_path,
    CAST(CASE WHEN h.instance_id IS NULL THEN is_active ELSE h.g.is_active END AS TINYINT)
    AS is_active, {_RUN} AS created_at, {_RUN} AS updated_at
FROM asset a LEFT JOIN hits h ON h.instance_id = a.instance_id
UNION ALL SELECT {_new_id(_NATURAL)}, type, instance_name, alias_name, env, host, port,
    'mongo_uri_aes', NULL, mongo_uri, CAST(is_active AS TINYINT), {_RUN}, {_RUN} FROM fresh""",
)

# Projections and predicates

oracle(
    "p1_env_label",
    ["asset"],
    """SELECT instance_id, coalesce(nullif(env, ''), '-') AS env, CASE env WHEN 'MOS' THEN 1
    WHEN 'Purple' THEN 2 WHEN 'RTM' THEN 3 WHEN 'MIB2' THEN 4 WHEN '' THEN 0 END AS env_order
FROM asset""",
)
oracle(
    "p2_to_gb",
    ["snap"],
    f"SELECT instance_id, stat_time, {gb('physical_total_bytes')} AS physical_gb FROM snap",
)
oracle(
    "p3_bytes_diff_text",
    ["snap"],
    f"""SELECT instance_id, stat_time, {gb_text("(physical_total_bytes - logical_total_bytes)",
    "collect_status <> 'ok'")} AS diff_gb_fmt FROM snap""",
)
oracle(
    "p4_count_diff_text",
    ["obj"],
    f"""SELECT instance_id, stat_time,
    {count_text("(table_rows - instance_id * 1000)", "instance_id IS NULL")} AS diff_fmt,
    {count_text("(50000 - table_rows)", "table_rows IS NULL")} AS back_fmt FROM obj""",
)


def _pair_columns(keys: str, measures: list[str], diffs: bool = False) -> str:
    columns = [f"s.{k}" for k in keys.split(", ")] + [_TIMES]
    for m in measures:
        columns.append(f"s.c.{m} AS last_{m}, s.p.{m} AS prev_{m}")
        if diffs:
            columns.append(f"s.c.{m} - s.p.{m} AS diff_{m}")
    return " SELECT " + ", ".join(columns) + " FROM s"


oracle(
    "p5_measure_diff",
    ["snap"],
    pairs("snap", "instance_id", "s", True)
    + _pair_columns("instance_id", ["logical_total_bytes", "physical_total_bytes"], True),
)
oracle(
    "p6_document_totals",
    ["coll_flat"],
    """SELECT instance_id, coll_name, coalesce(size, 0) + total_index_size AS logical_total_bytes,
    coalesce(storage_size, 0) + total_index_size AS physical_total_bytes FROM coll_flat""",
)
oracle(
    "p7_object_total",
    ["table_stats"],
    """SELECT instance_id, table_name,
    ifnull(data_length, 0) + ifnull(index_length, 0) AS total_bytes FROM table_stats""",
)
oracle(
    "p8_iso_time",
    ["times_text"],
    """SELECT row_id, strftime(CAST(raw AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS iso_text,
    date_trunc('second', CAST(raw AS TIMESTAMP)) AS iso_time FROM times_text""",
)
oracle(
    "p9_uri_host_port",
    ["uris"],
    r""", m AS (SELECT row_id, starts_with(uri, 'mongodb') AS known,
    split_part(regexp_extract(uri, '^[a-z+]+://(?:[^@/?]*@)?([^/?]*)', 1), ',', 1) AS member
    FROM uris)
SELECT row_id, CASE WHEN known THEN split_part(member, ':', 1) ELSE '' END AS host,
    CASE WHEN known AND contains(member, ':') THEN TRY_CAST(split_part(member, ':', -1) AS INTEGER)
        ELSE 0 END AS port FROM m""",
)
oracle("p9_uri_seal_roundtrip", ["uris"], "SELECT row_id, uri FROM uris")
oracle(
    "p12_report_cells",
    ["asset", "snap"],
    newest("snap", "instance_id", "n")
    + f""", r AS (SELECT a.instance_name, n.stat_time, n.collect_status, n.error_msg
    FROM n JOIN asset a USING (instance_id) WHERE {_MONGO})
SELECT instance_name, stat_time AS last_stat_time, 'last_collect_status' AS column_name,
    collect_status AS cell, collect_status <> 'ok' AS highlight FROM r
UNION ALL SELECT instance_name, stat_time, 'error_msg', error_msg, false FROM r""",
)
_P12_DIFFS = {
    m: gb_text(f"(s.c.logical_{m}_bytes - s.p.logical_{m}_bytes)", _NO_PREV)
    for m in ("total", "data")
}
oracle(
    "p12_diff_cells",
    ["asset", "snap"],
    pairs("snap", "instance_id", "s", True)
    + ", cells AS ("
    + " UNION ALL ".join(
        f"""SELECT a.instance_name, s.c.stat_time AS last_stat_time,
    'diff_{m}_gb_fmt' AS column_name, {text} AS cell
FROM s JOIN asset a USING (instance_id) WHERE {_MYSQL}"""
        for m, text in _P12_DIFFS.items()
    )
    + """) SELECT *, starts_with(cell, '+') OR starts_with(cell, '-') AS highlight FROM cells""",
)
oracle("f1_filter_assets", ["asset"], f"SELECT * FROM asset a WHERE {_MONGO}")
oracle(
    "f2_exclude_schemas",
    ["table_stats"],
    f"""SELECT instance_id, table_name, 'summary' AS rule FROM table_stats
WHERE table_schema NOT IN {_SYSTEM4}
UNION ALL SELECT instance_id, table_name, 'objects' FROM table_stats
WHERE table_schema NOT IN {_SYSTEM5}""",
)
oracle(
    "f3_base_tables",
    ["table_stats"],
    "SELECT instance_id, table_name FROM table_stats WHERE table_type = 'BASE TABLE'",
)
oracle(
    "f4_big_objects",
    ["table_stats"],
    """SELECT instance_id, table_name, table_rows FROM table_stats WHERE table_rows > 5000000
OR coalesce(data_length, 0) + coalesce(index_length, 0) > 53687091200""",
)
oracle(
    "f5_exclude_system_dbs",
    ["coll_flat"],
    """SELECT instance_id, db_name, coll_name FROM coll_flat
WHERE db_name NOT IN ('admin', 'local', 'config') AND coll_name NOT LIKE 'system.%'""",
)
oracle(
    "f6_valid_stats",
    ["db_flat"],
    """SELECT instance_id, db_name, data_size FROM db_flat WHERE ok = 1
UNION ALL SELECT instance_id, 'local', index_size FROM db_flat""",
)
oracle(
    "f7_list_ok",
    ["db_flat"],
    """SELECT instance_id, CAST(max(CASE WHEN list_ok = 1 THEN 0 ELSE 1 END) AS INTEGER) AS rc
FROM db_flat GROUP BY instance_id""",
)
oracle("f8_with_status", ["snap"], "SELECT * FROM snap WHERE collect_status = 'failed'")
oracle(
    "f9_drop_blank_keys",
    ["records"],
    """SELECT line_no, host, login_path FROM records WHERE trim(host) <> ''
AND trim(login_path) <> ''""",
)
oracle(
    "f11_strip_text",
    ["output_lines", "doc_records"],
    """SELECT line_no AS row_id, replace(replace(line, chr(9), ''), ':', '') AS text
FROM output_lines
UNION ALL SELECT line_no, CASE WHEN alias_name LIKE '"%"' THEN alias_name[2:-2] ELSE alias_name END
FROM doc_records""",
)

# Joins, aggregates, ranks and orders

oracle(
    "j1_latest_ties",
    ["snap"],
    newest("snap", "instance_id", "n")
    + " SELECT instance_id, stat_time, logical_total_bytes, collect_status FROM n",
)
oracle(
    "j2_latest_ok",
    ["snap"],
    newest("snap", "instance_id", "n")
    + " SELECT instance_id, stat_time, logical_total_bytes FROM n WHERE collect_status = 'ok'",
)
oracle(
    "j3_prev_ok",
    ["snap"],
    pairs("snap", "instance_id", "s", True)
    + _pair_columns("instance_id", ["logical_total_bytes"]),
)
oracle(
    "j4_with_asset",
    ["asset", "snap"],
    """SELECT s.instance_id, s.stat_time, a.env, a.instance_name, a.host, a.port
FROM snap s JOIN asset a USING (instance_id) WHERE a.is_active = 1""",
)
oracle("j5_object_latest", ["obj"], newest("obj", _TABLE, "n") + " SELECT * FROM n")
oracle(
    "j6_object_prev",
    ["obj"],
    pairs("obj", _TABLE, "s", False) + _pair_columns(_TABLE, ["table_rows", "total_bytes"]),
)
for _name, _join in (("j7_gate_inner", "JOIN"), ("j7_gate_semi", "SEMI JOIN")):
    oracle(
        _name,
        ["obj", "snap_obj"],
        newest("obj", _TABLE, "n")
        + _GATE
        + f" SELECT {_TABLE}, total_bytes FROM n {_join} good USING (instance_id)",
    )
oracle(
    "j8_aligned_last_vs_prev",
    ["snap", "coll_aligned"],
    _ALIGNED
    + """ SELECT instance_id, db_name, coll_name, lt AS last_stat_time, pt AS prev_stat_time,
    s.c.doc_count AS last_doc_count, s.p.doc_count AS prev_doc_count,
    s.c.logical_total_bytes AS last_logical_total_bytes,
    s.p.logical_total_bytes AS prev_logical_total_bytes FROM s""",
)
oracle("a1_instance_storage", ["table_stats"], _SUMMARY + " SELECT * FROM summary")
oracle("a2_document_storage", ["db_flat"], _DOC_SUMMARY + " SELECT * FROM summary")
oracle(
    "a3_last_time",
    ["snap"],
    "SELECT instance_id, max(stat_time) AS stat_time FROM snap GROUP BY instance_id",
)
oracle(
    "a6_run_summary",
    ["snap"],
    """SELECT count(*) FILTER (collect_status = 'ok') AS success,
    count(*) FILTER (collect_status <> 'ok') AS failed FROM snap""",
)
_RANK = """CAST(row_number() OVER (PARTITION BY instance_id ORDER BY total_bytes DESC,
    schema_name, table_name, data_bytes, table_rows NULLS FIRST, stat_time) AS INTEGER)"""
oracle(
    "w1_rank_objects",
    ["obj"],
    f"SELECT {_TABLE}, total_bytes, {_RANK} AS rank_no FROM obj",
)
oracle(
    "w1_rank_runs",
    ["obj"],
    _MONTHLY.format("obj") + f" SELECT {_TABLE}, stat_time, total_bytes, {_RUN_RANK} AS rank_no FROM monthly",
)
_SHOWN_ENV = "coalesce(nullif(a.env, ''), '-')"
_PLACE = "CASE a.env WHEN 'MOS' THEN 1 WHEN 'Purple' THEN 2 WHEN 'RTM' THEN 3 WHEN 'MIB2' THEN 4 ELSE 0 END"
_OBJECT = "o.schema_name, o.table_name, o.stat_time, o.table_rows"
_BY_OBJECT = (
    "o.instance_id NULLS FIRST, o.schema_name NULLS FIRST, o.table_name NULLS FIRST, "
    "o.stat_time NULLS FIRST, o.table_rows NULLS FIRST"
)

oracle(
    "o1_failed_order",
    ["asset", "snap"],
    f"""SELECT * EXCLUDE (place) FROM (SELECT DISTINCT a.instance_id, a.env, a.instance_name, s.stat_time,
        CASE WHEN a.env IS NULL THEN NULL ELSE {_PLACE} END AS place
    FROM asset a JOIN snap s USING (instance_id) WHERE s.collect_status = 'failed')
ORDER BY stat_time DESC NULLS LAST, place NULLS FIRST, instance_name NULLS FIRST, instance_id LIMIT 100""",
)
oracle(
    "o2_env_diff_order",
    ["asset", "snap"],
    f"""SELECT * FROM (SELECT a.instance_id, a.env, sum(s.logical_total_bytes)::BIGINT AS total,
        (sum(s.logical_total_bytes) - sum(CASE WHEN s.collect_status = 'failed' THEN s.logical_total_bytes END))::BIGINT
            AS diff
    FROM asset a JOIN snap s USING (instance_id) GROUP BY a.instance_id, a.env)
ORDER BY diff DESC NULLS LAST, {gb("total")} DESC NULLS LAST, env NULLS FIRST LIMIT 1000""",
)
oracle(
    "o3_size_order",
    ["asset", "snap"],
    f"""SELECT a.instance_id, a.env, a.instance_name, s.stat_time, s.logical_total_bytes
FROM asset a JOIN snap s USING (instance_id)
ORDER BY {gb("s.logical_total_bytes")} DESC NULLS LAST, {_SHOWN_ENV}, a.instance_name NULLS FIRST,
    s.stat_time NULLS FIRST, s.logical_total_bytes LIMIT 3000""",
)
oracle(
    "o4_top_objects",
    ["asset_obj", "obj"],
    f"""SELECT o.instance_id, a.env, {_OBJECT}, o.total_bytes FROM asset_obj a JOIN obj o USING (instance_id)
ORDER BY o.total_bytes DESC NULLS LAST, {_SHOWN_ENV}, {_BY_OBJECT} LIMIT 50""",
)
oracle(
    "o5_abs_diff_order",
    ["asset", "snap"],
    f"""SELECT a.instance_id, a.env, a.instance_name, s.stat_time, s.logical_total_bytes AS last,
    CASE WHEN s.collect_status = 'ok' THEN s.logical_data_bytes END AS prev
FROM asset a JOIN snap s USING (instance_id)
ORDER BY CASE WHEN s.collect_status = 'ok' THEN abs(s.logical_total_bytes - s.logical_data_bytes) ELSE 0 END
    DESC NULLS LAST, {_SHOWN_ENV}, a.instance_name NULLS FIRST, s.stat_time NULLS FIRST, s.logical_total_bytes
LIMIT 14800""",
)
oracle(
    "o6_object_abs_diff_order",
    ["asset_obj", "obj"],
    f"""SELECT o.instance_id, a.env, {_OBJECT}, o.total_bytes, o.data_bytes
FROM asset_obj a JOIN obj o USING (instance_id)
ORDER BY CASE WHEN o.data_bytes IS NULL THEN 0 ELSE abs(o.total_bytes - o.data_bytes) END DESC NULLS LAST,
    {_SHOWN_ENV}, {_BY_OBJECT} LIMIT 300""",
)

# Trends

oracle(
    "d1_overview",
    ["asset", "snap"],
    newest("snap", "instance_id", "n")
    + f""" SELECT {_ASSET}, a.host, a.port, n.stat_time AS last_stat_time,
    {gb("n.logical_total_bytes")} AS logical_total_gb, n.collect_status AS last_collect_status
FROM n JOIN asset a USING (instance_id) WHERE a.is_active = 1""",
)


def _growth(days: int) -> str:
    return f""", good AS (SELECT *, max(stat_time) OVER (PARTITION BY instance_id) AS newest
    FROM snap WHERE collect_status = 'ok'),
spans AS (SELECT *, min(stat_time) OVER (PARTITION BY instance_id) AS oldest FROM good
    WHERE stat_time >= newest - INTERVAL {days} DAY),
grown AS (SELECT instance_id, oldest AS first_stat_time, newest AS last_stat_time,
    min(logical_total_bytes) FILTER (stat_time = oldest) AS first_bytes,
    max(logical_total_bytes) FILTER (stat_time = newest) AS last_bytes,
    max(logical_total_bytes) FILTER (stat_time = newest)
        - min(logical_total_bytes) FILTER (stat_time = oldest) AS growth_bytes
    FROM spans GROUP BY instance_id, oldest, newest)"""


oracle("d2_growth_7d", ["snap"], _growth(7) + " SELECT * FROM grown")
_DENSE = """, dense AS (SELECT * REPLACE (TIMESTAMP '1992-01-01' + INTERVAL 8 HOUR
    * ((year(stat_time) - 1992) * 12 + month(stat_time) - 1) AS stat_time) FROM snap)"""
oracle("d2_stored_growth_7d", ["snap"], _DENSE + _growth(7).replace("FROM snap", "FROM dense") + " SELECT * FROM grown")
oracle("d2_growth_14d", ["snap"], _growth(14) + " SELECT * FROM grown")
for _name, _days in (("d3_avg_daily_growth", 7), ("d3_avg_daily_growth_year", 365)):
    _between = "CAST(date_diff('day', first_stat_time, last_stat_time) AS INTEGER)"
    oracle(
        _name,
        ["snap"],
        _growth(_days)
        + f""" SELECT instance_id, growth_bytes, {_between} AS days_between,
    {gb(f"growth_bytes::DOUBLE / nullif({_between}, 0)")} + 0.0::DOUBLE AS avg_daily_growth_gb
FROM grown""",
    )
oracle(
    "d4_object_growth_topn",
    ["obj"],
    f""", d AS (SELECT instance_id, schema_name, table_name, CAST(stat_time AS DATE) AS day,
    arg_max(total_bytes, (stat_time, total_bytes)) AS size FROM
    (SELECT * REPLACE (date_trunc('month', stat_time) AS stat_time) FROM obj) GROUP BY ALL)
SELECT f.instance_id, f.schema_name, f.table_name, f.size AS from_bytes, t.size AS to_bytes,
    t.size - f.size AS growth_bytes
FROM d f JOIN d t USING (instance_id, schema_name, table_name)
WHERE f.day = DATE '{GROWTH_FROM}' AND t.day = DATE '{GROWTH_TO}'
ORDER BY growth_bytes DESC, f.instance_id, f.schema_name, f.table_name LIMIT 20""",
)
oracle(
    "d5_schema_top5",
    ["obj"],
    newest("obj", _TABLE, "n")
    + f""" SELECT instance_id, schema_name, {total("total_bytes")} AS total_bytes,
    CAST(row_number() OVER (PARTITION BY instance_id ORDER BY sum(total_bytes) DESC, schema_name)
        AS INTEGER) AS rank_no
FROM n GROUP BY instance_id, schema_name QUALIFY rank_no <= 5""",
)
oracle(
    "d6_table_top10",
    ["obj"],
    newest("obj", _TABLE, "n")
    + f""" SELECT {_TABLE}, stat_time, total_bytes, CAST(row_number() OVER (
    PARTITION BY instance_id ORDER BY total_bytes DESC, schema_name, table_name) AS INTEGER)
    AS rank_no FROM n QUALIFY rank_no <= 10""",
)
oracle(
    "d6_table_diff_top10",
    ["obj"],
    pairs("obj", _TABLE, "s", False)
    + f""", d AS ({_pair_columns(_TABLE, ["total_bytes"], True)})
SELECT * RENAME (diff_total_bytes AS diff_bytes), CAST(row_number() OVER (PARTITION BY instance_id
    ORDER BY coalesce(abs(diff_total_bytes), 0) DESC, schema_name, table_name,
    last_total_bytes DESC, prev_total_bytes DESC NULLS LAST) AS INTEGER) AS rank_no
FROM d QUALIFY rank_no <= 10""",
)
oracle(
    "d7_daily_grain",
    ["obj"],
    """SELECT CAST(stat_time AS DATE) AS stat_date, instance_id, schema_name,
    max(stat_time) AS stat_time, arg_max(total_bytes, (stat_time, total_bytes)) AS total_bytes
FROM obj GROUP BY 1, 2, 3""",
)
oracle(
    "d7_daily_table",
    ["obj"],
    _MONTHLY.format("obj")
    + """ SELECT CAST(stat_time AS DATE) AS stat_date, instance_id, schema_name,
    max(stat_time) AS stat_time, arg_max(total_bytes, (stat_time, total_bytes)) AS total_bytes
FROM monthly GROUP BY 1, 2, 3""",
)
oracle(
    "d8_cap_or_threshold",
    ["obj"],
    f"""SELECT {_TABLE}, total_bytes, {_RANK} AS rank_no FROM obj
QUALIFY rank_no <= 20 OR total_bytes >= {MIN_BYTES}""",
)
oracle(
    "d9_rank_delta",
    ["obj"],
    _MONTHLY.format("obj")
    + f""", ranked AS (SELECT {_TABLE}, stat_time, {_RUN_RANK} AS rank_no FROM monthly),
newest AS (SELECT {_TABLE}, max(stat_time) AS lt FROM ranked GROUP BY ALL),
older AS (SELECT {_TABLE}, max(stat_time) AS pt FROM ranked JOIN newest USING ({_TABLE}) WHERE stat_time < lt GROUP BY ALL),
l AS (SELECT {_TABLE}, stat_time, rank_no FROM ranked JOIN newest USING ({_TABLE}) WHERE stat_time = lt),
p AS (SELECT {_TABLE}, stat_time, rank_no FROM ranked JOIN older USING ({_TABLE}) WHERE stat_time = pt)
SELECT {_TABLE}, l.stat_time AS last_stat_time, p.stat_time AS prev_stat_time, l.rank_no AS last_rank_no, p.rank_no AS prev_rank_no,
    {count_text("(l.rank_no - p.rank_no)", "p.rank_no IS NULL")} AS rank_delta_fmt FROM l LEFT JOIN p USING ({_TABLE})""",
)

# The same reports on stored facts, whose snapshots are monthly runs.
for _name, _like in STORED.items():
    ORACLES[_name] = with_views(*_PARTS[_like], monthly=True)
