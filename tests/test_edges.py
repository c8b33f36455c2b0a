"""Cases the generated tables do not guarantee, with expected values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tests.rows import GIB, assets, colls, day, lit, one, snaps, tables, values
from waterline.functions import (
    env_label,
    fmt_bytes_diff,
    fmt_count_diff,
    normalize_iso_text,
    normalize_iso_time,
    open_uri,
    seal_uri,
    strip_breaks,
    strip_quotes,
    to_gb,
    uri_host_port,
)
from waterline.model import BIG_OBJECT_BYTES, BIG_OBJECT_ROWS
from waterline.operators.assets import load_assets, upsert_assets_fill, validate_assets
from waterline.operators.filters import active_assets, big_objects, normalize_asset_types
from waterline.operators.rollups import instance_storage_summary
from waterline.operators.snapshots import collated
from waterline.operators.status import derive_status
from waterline.plans import collect, reports

KEY, IV = "ab" * 32, "cd" * 16


def test_tied_latest_pairs_with_tied_previous(spark):
    s = snaps(spark, *[(1, day(t), b, "ok") for t, b in ((2, 5), (2, 6), (1, 1), (1, 2), (1, 3))])
    out = reports.r3(assets(spark, (1, "MOS")), s)
    assert out.count() == 6


def test_tied_ok_and_failed_latest(spark):
    s = snaps(spark, (1, day(2), 5, "ok"), (1, day(2), 0, "failed"))
    a = assets(spark, (1, "MOS"))
    assert reports.r3(a, s).count() == 1
    assert values(reports.r1(a, s), "last_collect_status") == [("failed",)]


def test_failed_latest_hides_older_ok(spark):
    s = snaps(spark, (1, day(1), 7 * GIB, "ok"), (1, day(2), 0, "failed"))
    a = assets(spark, (1, "MOS"))
    assert reports.r3(a, s).count() == 0
    assert reports.r1(a, s).count() == 1
    docs = assets(spark, (1, "MOS"), kind="mongodb")
    columns = ("env", "instance_count", "last_env_logical_total_gb")
    assert values(reports.r7(docs, s), *columns) == [("MOS", 1, 0.0)]


def test_ok_and_failed_at_previous_time_both_pair(spark):
    s = snaps(spark, (1, day(2), 5, "ok"), (1, day(1), 3, "ok"), (1, day(1), 0, "failed"))
    assert reports.r3(assets(spark, (1, "MOS")), s).count() == 2


def test_failed_runs_between_are_skipped(spark):
    rows = [(1, day(9), 5, "ok"), (1, day(1), 3, "ok")]
    rows += [(1, day(n), 0, "failed") for n in range(2, 9)]
    out = reports.r3(assets(spark, (1, "MOS")), snaps(spark, *rows))
    assert values(out, "prev_stat_time") == [(day(1),)]


def test_single_snapshot_has_no_difference(spark):
    out = reports.r3(assets(spark, (1, "MOS")), snaps(spark, (1, day(1), GIB, "ok")))
    assert values(out, "prev_stat_time", "prev_total_gb", "diff_total_gb_fmt") == [(None, None, "-")]


@pytest.mark.parametrize(
    "last, prev, text",
    [
        (GIB, GIB, "0"),
        (GIB + 1, GIB, "+0.00"),
        (GIB - 1, GIB, "-0.00"),
        (3 * GIB, GIB, "+2.00"),
        (GIB, 3 * GIB + GIB // 2, "-2.50"),
        (GIB, None, "-"),
        (None, GIB, "0"),
    ],
)
def test_bytes_diff_text(spark, last, prev, text):
    assert one(spark, fmt_bytes_diff(lit(last, "bigint"), lit(prev, "bigint"))) == text


@pytest.mark.parametrize(
    "last, prev, text", [(5, 3, "+2"), (3, 5, "-2"), (4, 4, "0"), (4, None, "-"), (None, 4, "0")]
)
def test_count_diff_text(spark, last, prev, text):
    assert one(spark, fmt_count_diff(lit(last, "bigint"), lit(prev, "bigint"))) == text


@pytest.mark.parametrize("size, gb", [(134217728, 0.13), (0, 0.0), (GIB, 1.0), (None, None)])
def test_to_gb_rounds_half_up(spark, size, gb):
    assert one(spark, to_gb(lit(size, "bigint"))) == gb


def test_environment_difference_covers_instances_with_previous_only(spark):
    a = assets(spark, (1, "MOS"), (2, "MOS"), (3, "RTM"), (4, None), (5, ""))
    s = snaps(
        spark,
        (1, day(1), GIB, "ok"),
        (1, day(2), 3 * GIB, "ok"),
        (2, day(2), 10 * GIB, "ok"),
        (3, day(2), GIB, "ok"),
        (4, day(2), GIB, "ok"),
        (5, day(2), 2 * GIB, "ok"),
    )
    out = [tuple(r) for r in reports.r2(a, s).collect()]
    # Largest change first; environments without one follow by size.
    assert out == [
        ("MOS", 2, 13.0, 1.0, "+2.00"),
        ("-", 2, 3.0, 0.0, "-"),
        ("RTM", 1, 1.0, 0.0, "-"),
    ]


def test_env_label(spark):
    assert [one(spark, env_label(lit(e, "string"))) for e in (None, "", "RTM")] == ["-", "-", "RTM"]


def test_failed_report_sorts_by_declared_environment(spark):
    a = assets(spark, (1, "MIB2"), (2, "MOS"), (3, "Purple"), (4, None))
    s = snaps(spark, *[(i, day(1), 0, "failed") for i in (1, 2, 3, 4)])
    assert [r.env for r in reports.r1(a, s).collect()] == ["-", "MOS", "Purple", "MIB2"]


def test_table_missing_from_latest_run_stays(spark):
    a = assets(spark, (1, "MOS"))
    s = snaps(spark, (1, day(1), 1, "ok"), (1, day(2), 1, "ok"))
    t = tables(spark, (1, "gone", day(1), 5, GIB), (1, "kept", day(1), 1, 1), (1, "kept", day(2), 2, 2))
    out = values(reports.r4(a, s, t), "table_name", "last_stat_time")
    assert out == [("gone", day(1)), ("kept", day(2))]


def test_collection_missing_from_latest_run_is_absent(spark):
    a = assets(spark, (1, "MOS"), kind="mongodb")
    s = snaps(spark, (1, day(1), 1, "ok"), (1, day(2), 1, "ok"))
    c = colls(spark, (1, "gone", day(1), 5, 5), (1, "kept", day(1), 1, 1), (1, "kept", day(2), 4, 2))
    out = reports.r10(a, s, c)
    assert values(out, "coll_name", "diff_doc_count_fmt") == [("kept", "+3")]
    assert values(reports.r9(a, c), "coll_name") == [("gone",), ("kept",)]


def test_collection_time_off_by_a_second_is_absent(spark):
    a = assets(spark, (1, "MOS"), kind="mongodb")
    out = reports.r10(a, snaps(spark, (1, day(1), 1, "ok")), colls(spark, (1, "c", day(1, 1), 1, 1)))
    assert out.count() == 0


def test_unknown_current_row_count(spark):
    a = assets(spark, (1, "MOS"))
    t = tables(spark, (1, "t", day(1), 5, 1), (1, "t", day(2), None, 1))
    out = reports.r5(a, snaps(spark, (1, day(2), 1, "ok")), t)
    assert values(out, "diff_rows_fmt", "last_rows", "prev_rows") == [("0", None, 5)]


def test_row_change_order_puts_unknown_change_last(spark):
    a = assets(spark, (1, "MOS"))
    t = tables(
        spark,
        *[(1, "unknown", day(1), 5, 1), (1, "unknown", day(2), None, 1)],
        (1, "new", day(2), 9, 1),
        *[(1, "less", day(1), 9, 1), (1, "less", day(2), 2, 1)],
    )
    out = reports.r5(a, snaps(spark, (1, day(2), 1, "ok")), t)
    assert [r.table_name for r in out.collect()] == ["less", "new", "unknown"]


def test_unknown_lengths(spark):
    stats = spark.createDataFrame(
        [(1, "s", "a", 1, None, "8"), (1, "s", "b", 2, 3, "8"), (1, "sys", "c", 100, 100, "8")],
        "instance_id bigint, table_schema string, table_name string, data_length bigint, "
        "index_length bigint, version string",
    )
    row = instance_storage_summary(stats).first()
    assert (row.logical_data_bytes, row.logical_index_bytes, row.logical_total_bytes) == (3, 3, 5)


@pytest.mark.parametrize(
    "rows, size, kept",
    [
        (BIG_OBJECT_ROWS, 0, False),
        (BIG_OBJECT_ROWS + 1, 0, True),
        (0, BIG_OBJECT_BYTES, False),
        (0, BIG_OBJECT_BYTES + 1, True),
        (None, BIG_OBJECT_BYTES + 1, True),
        (None, 0, False),
    ],
)
def test_big_object_thresholds_are_strict(spark, rows, size, kept):
    df = spark.createDataFrame([(rows, size)], "r bigint, b bigint")
    assert big_objects(df, F.col("r"), F.col("b")).count() == int(kept)


def test_short_document_type_is_normalised(spark):
    a = assets(spark, (1, "MOS"), kind="mongo").withColumn("auth_mode", F.lit("mongo_uri_aes"))
    assert active_assets(normalize_asset_types(a), "mongodb", "mongo_uri_aes").count() == 1


@pytest.mark.parametrize(
    "uri, host, port",
    [
        ("mongodb://u:p@h1:27017,h2:27018/db?x=1", "h1", 27017),
        ("mongodb+srv://u:p@cluster/db", "cluster", 0),
        ("mongodb://h", "h", 0),
        ("mongodb://h:1", "h", 1),
        ("mongodb://h?ssl=true", "h", 0),
        ("mongodb://u:p@h", "h", 0),
        ("mongodb://h:", "h", 0),
        ("mongodb://h:x/db", "h", None),
        ("http://h:80", "", 0),
        ("mongodb://", "", 0),
    ],
)
def test_uri_shapes(spark, uri, host, port):
    got_host, got_port = uri_host_port(lit(uri, "string"))
    assert (one(spark, got_host), one(spark, got_port)) == (host, port)


def test_uri_seal(spark):
    uri = "mongodb://u:p@host:1/db"
    sealed = one(spark, seal_uri(lit(uri, "string"), KEY, IV))
    assert "host" not in sealed and len(sealed) == 44  # two blocks in base64
    # As `openssl enc -aes-256-cbc -base64` gives it for this key and IV.
    key, iv = "00112233445566778899aabbccddeeff" * 2, "0f0e0d0c0b0a09080706050403020100"
    known = "e0XVW++czxvrkHouF40c0ONcbcypL/iFsRPZI4MadDo="
    assert one(spark, seal_uri(lit(uri, "string"), key, iv)) == known
    assert one(spark, open_uri(lit(known, "string"), key, iv)) == uri
    assert one(spark, open_uri(lit(sealed[:20] + "\n" + sealed[20:], "string"), KEY, IV)) == uri
    assert one(spark, open_uri(lit("no ciphertext", "string"), KEY, IV)) is None


@pytest.mark.parametrize(
    "raw, text",
    [
        ("2026-01-02T03:04:05.678Z", "2026-01-02 03:04:05"),
        ("2026-01-02T03:04:05Z", "2026-01-02 03:04:05"),
        ("2026-01-02 03:04:05", "2026-01-02 03:04:05"),
        ("", ""),
        (None, None),
    ],
)
def test_iso_text(spark, raw, text):
    assert one(spark, normalize_iso_text(lit(raw, "string"))) == text


def test_iso_time_of_noise_is_null(spark):
    assert one(spark, normalize_iso_time(lit("Today", "string"))) is None


def test_strip(spark):
    assert one(spark, strip_breaks(lit("a\r\nb\n", "string"))) == "ab"
    shapes = {'"a b"': "a b", "'a'": "a", "\"a'": "\"a'", '"': '"', '""': "", "a": "a"}
    assert {s: one(spark, strip_quotes(lit(s, "string"))) for s in shapes} == shapes


_RECORD = (
    "line_no bigint, instance_name string, alias_name string, env string, host string, "
    "port string, username string, password string, login_path string"
)


def _records(spark, *rows):
    return spark.createDataFrame(rows, _RECORD)


def test_import_rejects(spark):
    records = _records(
        spark,
        (1, "ok", "", "", "h", "", "u", "p", ""),
        (2, "nohost", "", "", "", "", "u", "p", ""),
        (3, "badenv", "", "Test", "h", "", "u", "p", ""),
        (4, "", "", "", "h", "", "u", "p", ""),
        (5, "badport", "", "MOS", "h", "x", "u", "p", ""),
    )
    accepted, rejected = validate_assets(records, "mysql")
    assert values(accepted, "instance_name", "port", "env") == [("ok", 3306, None)]
    assert values(rejected, "instance_name", "reject_reason") == [
        ("badenv", "invalid_env"),
        ("badport", "invalid_port"),
        ("nohost", "missing_required"),
    ]
    assert "password" not in accepted.columns + rejected.columns


def _table(spark, assets_df):
    time = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    return assets_df.withColumns(
        {"username": F.lit("u"), "secret_ref": F.lit(None).cast("string"), "created_at": time,
         "updated_at": time}
    )


def test_fill_rule(spark):
    known = _table(spark, assets(spark, (7, None), (8, "MOS"))).withColumn(
        "login_path", F.when(F.col("instance_id") == 8, "keep")
    )
    records = _records(
        spark,
        (1, "n7", "new", "", "h", "3306", "u", "p", ""),
        (2, "n8", "new", "MOS", "h", "3306", "u", "p", "other"),
        (3, "fresh", "x", "", "h", "", "u", "p", ""),
        (4, "twice", "first", "", "h", "", "u", "p", ""),
        (5, "twice", "second", "", "h", "", "u", "p", "later"),
    )
    merged, _ = load_assets(known, records, "mysql", "2026-01-01 00:00:00")
    got = {r.instance_name: (r.alias_name, r.login_path) for r in merged.collect()}
    assert got == {
        "n7": ("a7", "n7"),
        "n8": ("a8", "keep"),
        "fresh": ("x", None),
        "twice": ("first", "later"),
    }
    ids = sorted(r.instance_id for r in merged.collect())
    assert ids == [7, 8, 9, 10]

    at_once = upsert_assets_fill(
        known, validate_assets(records, "mysql")[0], "2026-01-01 00:00:00", fill_on_insert=True
    )
    assert {r.instance_name: r.login_path for r in at_once.collect()}["fresh"] == "fresh"

    # A second run fills what the first one left open, and adds nothing.
    again, _ = load_assets(merged, records, "mysql", "2026-01-02 00:00:00")
    assert {r.instance_name: r.login_path for r in again.collect()} == {
        "n7": "n7", "n8": "keep", "fresh": "fresh", "twice": "later"
    }


def test_import_is_evaluated_once(spark):
    """Known assets with NULL environment match; twins fill the older one; the import's rows are made once."""
    held = assets(spark, (1, None), (2, "RTM")).withColumns(
        {
            "instance_name": F.lit("n"),
            "login_path": F.lit(None).cast("string"),
            "username": F.lit("u"),
            "secret_ref": F.lit(None).cast("string"),
            "created_at": F.lit("2026-01-01").cast("timestamp_ntz"),
            "updated_at": F.lit("2026-01-01").cast("timestamp_ntz"),
        }
    )
    twins = held.unionByName(held.withColumn("instance_id", F.col("instance_id") + 10))
    evaluated = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            evaluated.add(len(frame))
            yield frame

    rows = [(1, "mysql", "n", "a", None, "h", 3306, "u", "new"), (2, "mysql", "x", "a", "RTM", "h", 1, "u", None)]
    schema = "line_no long, type string, instance_name string, alias_name string, env string, host string, port int, username string, login_path string"
    incoming = spark.createDataFrame(rows, schema).mapInPandas(counted, schema)
    merged = upsert_assets_fill(twins, incoming, "2026-02-01 00:00:00")
    got = values(merged, "instance_id", "instance_name", "login_path")
    assert got == [(1, "n", "new"), (11, "n", None), (12, "n", None), (13, "x", None), (2, "n", None)]
    assert evaluated.value == len(rows)


def test_overwrite_rule(spark):
    known = _table(spark, assets(spark, (7, "MOS"), kind="mongo"))
    records = spark.createDataFrame(
        [
            (1, "n7", "x", "MOS", "", "1", "mongodb://u:p@h:3306"),
            (2, "n7", "'last'", "MOS", "mongo", "0", "mongodb://u:q@h:3306"),
            (3, "no", "", "", "redis", "", "mongodb://h"),
            (4, "no", "", "", "", "", ""),
            (5, "no", "", "", "", "", "http://h"),
            (6, "", "", "", "", "", "mongodb://h"),
            (7, "new", "", "", "", "", "mongodb://h"),
        ],
        "line_no bigint, instance_name string, alias_name string, env string, type string, "
        "is_active string, mongo_uri string",
    )
    merged, rejected = load_assets(known, records, "mongodb", "2026-01-01 00:00:00", KEY, IV)
    opened = merged.withColumn("uri", open_uri(F.col("login_path"), KEY, IV))
    columns = ("instance_id", "type", "instance_name", "alias_name", "port", "is_active", "uri")
    assert values(opened, *columns) == [
        (7, "mongodb", "n7", "last", 3306, 0, "mongodb://u:q@h:3306"),
        (8, "mongodb", "new", None, 0, 1, "mongodb://h"),
    ]
    assert values(rejected, "line_no", "reject_reason") == [
        (3, "unexpected_type"),
        (4, "missing_uri"),
        (5, "invalid_uri"),
    ]


_ERRORS = "instance_id bigint, part string, message string"


def test_relational_status(spark):
    a = assets(spark, *[(i, "MOS") for i in range(1, 6)])
    summary = spark.createDataFrame(
        [(1, day(1), 1, 2, 3, "8"), (2, day(1), 1, 2, 3, "8"), (4, None, 1, 2, 3, "")],
        "instance_id bigint, stat_time timestamp_ntz, logical_data_bytes bigint, "
        "logical_index_bytes bigint, logical_total_bytes bigint, version string",
    )
    errors = spark.createDataFrame(
        [(2, "objects", "boom"), (3, "objects", "x" * 300), (3, "summary", "no route")], _ERRORS
    )
    out = derive_status(a, summary, errors, "2026-01-09 00:00:00", "mysql").orderBy("instance_id")
    rows = [(r.collect_status, r.logical_total_bytes, r.stat_time.day, r.error_msg) for r in
            out.collect()]
    assert rows[0] == ("ok", 3, 1, None)
    assert rows[1] == ("failed", 3, 1, "top_tables_failed: boom")
    assert rows[2][:3] == ("failed", 0, 9) and rows[2][3].endswith("x" * 300)
    assert rows[2][3].startswith("summary_failed: no route; top_tables_failed: xxx")
    assert rows[3] == ("failed", 3, 9, None)  # a summary without a time, but no message
    assert rows[4] == ("failed", 0, 9, "summary_failed")


def test_missing_feed_does_not_fail_others(spark):
    a = assets(spark, (1, "MOS"), (2, "MOS"), (3, "MOS"))
    stats = spark.createDataFrame(
        [(1, "s", "t", "BASE TABLE", "e", 1, 10, 5, "8"), (3, "sys", "t", "VIEW", "e", 1, 10, 5, "8")],
        "instance_id bigint, table_schema string, table_name string, table_type string, "
        "engine string, table_rows bigint, data_length bigint, index_length bigint, version string",
    )
    out = collect.collect_instances(a, stats, collect.no_errors(spark), "2026-01-09 00:00:00")
    assert values(out, "instance_id", "logical_total_bytes", "collect_status") == [
        (1, 15, "ok"),
        (2, 0, "failed"),
        (3, 0, "ok"),
    ]
    big = collect.collect_tables(stats, out, "2026-01-09 00:00:00", 0, 0)
    assert values(big, "instance_id", "table_name", "total_bytes", "rank_no") == [(1, "t", 15, 1)]


def test_names_compare_by_bytes_unless_collated(spark):
    a, s = assets(spark, (1, "MOS")), snaps(spark, (1, day(2), 1, "ok"))
    t = tables(spark, (1, "Orders", day(1), 1, 1), (1, "orders ", day(2), 4, 1))
    assert values(reports.r5(a, s, t), "diff_rows_fmt") == [("-",), ("-",)]
    same = collated(t, ["schema_name", "table_name"])
    assert values(reports.r5(a, s, same), "table_name", "diff_rows_fmt") == [("orders ", "+3")]
    assert reports.r4(a, s, same).count() == 1
