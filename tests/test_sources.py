"""Files in and out."""

import os

from pyspark.sql import functions as F

from checks import queries
from checks.views import view
from tests.rows import GIB, assets, day, snaps, tables, values
import pytest
from waterline.operators.assets import validate_assets
from waterline.operators.rollups import document_storage_summary
from waterline.sources.feeds import read_coll_stats, read_db_stats
from waterline.model import ASSETS, FACTS, RELATIONAL_SUMMARY_LINE, TableNames
from waterline.operators.ranking import rank_objects
from waterline.operators.rollups import document_storage_summary, list_ok, run_summary
from waterline.plans import collect, reports
from waterline.sources.assets import StaleAssets, read_assets, read_version, release_claims, store_assets, update_assets
from waterline.sources.facts import (
    merge_days,
    append_objects,
    append_snapshot,
    append_snapshot_table,
    ensure_tables,
    read_snapshots,
)
from waterline.sources.feeds import (
    pick_summary_line,
    read_asset_records,
    read_coll_stats,
    read_collector_tsv,
    read_db_stats,
    pack_output,
    read_output_lines,
)
from waterline.sources.reports import export_tsv, report_cells
from waterline.sources.scratch import scratch_path


def lines_of(folder):
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    return [line for p in parts for line in open(os.path.join(folder, p)).read().splitlines()]


def test_tsv_export(spark, tmp_path):
    report = spark.createDataFrame(
        [("a\tb\nc", 12345678901.5, None, day(1), " x "), ("", 0.0, "q\"uote", None, "")],
        "name string, size_gb double, note string, at timestamp_ntz, pad string",
    )
    path = export_tsv(report, str(tmp_path), "report", single_file=True)
    assert lines_of(path) == [
        "name\tsize_gb\tnote\tat\tpad",
        "a b c\t12345678901.50\tNULL\t2026-01-01 09:00:00\t x ",
        '\t0.00\tq"uote\tNULL\t',
    ]
    # Exporting again replaces the file.
    export_tsv(report.limit(0), str(tmp_path), "report", single_file=True)
    assert len(lines_of(path)) <= 1


def test_every_export_has_its_report(spark, tmp_path):
    a, s = assets(spark, (1, "MOS")), snaps(spark, (1, day(1), GIB, "ok"))
    t = tables(spark, (1, "t", day(1), 1, 1))
    for name, report in reports.RELATIONAL_EXPORTS.items():
        path = export_tsv(report(a, s, t), str(tmp_path), name, single_file=True)
        assert len(lines_of(path)) == (1 if name == "q1_failed_instances" else 2)
    assert len(reports.DOCUMENT_EXPORTS) == 5


def test_collector_tsv(spark, tmp_path):
    file = tmp_path / "summary.tsv"
    file.write_text(
        "2026-01-01 09:00:00\t1\t10\t5\t15\t8.0.36\n2026-01-01 09:00:00\t2\t0\t0\tNULL\tNULL\n"
        '2026-01-01 09:00:00\t3\t0\t0\t1\t"8\\0\n'
    )
    out = read_collector_tsv(spark, str(file), RELATIONAL_SUMMARY_LINE)
    assert values(out, "instance_id", "stat_time", "logical_total_bytes", "mysql_version") == [
        (1, day(1), 15, "8.0.36"),
        (2, day(1), None, None),
        (3, day(1), 1, '"8\\0'),
    ]


def test_output_lines_are_numbered_whatever_the_splits(spark, tmp_path):
    texts = {1: "a\r\nb\n\nc\n", 2: "", 3: "no end", 4: "\n", 5: "x\n" * 5000, 6: "\tq\r\n\r\n"}
    for instance, text in texts.items():
        folder = tmp_path / f"instance_id={instance}"
        folder.mkdir()
        (folder / "out.tsv").write_text(text, newline="")
    (tmp_path / "other.tsv").write_text("nobody's\n")
    wanted = [(None, 1, "nobody's")]
    for instance, text in texts.items():
        lines = text.replace("\r\n", "\n").removesuffix("\n").split("\n") if text else []
        wanted += [(instance, n, line) for n, line in enumerate(lines, 1)]
    for most in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            got = read_output_lines(spark, str(tmp_path))
            assert values(got, "instance_id", "line_no", "line") == sorted(wanted, key=str)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(Exception, match="too large"):
        read_output_lines(spark, str(tmp_path), max_bytes=5000).collect()


def test_packed_output_gives_the_lines_of_files(spark, tmp_path):
    texts = {1: "a\r\nb\n\nc\n", 2: "", 3: "no end", 4: "\n", 5: "x\n" * 5000, 6: "\tq\r\n\r\n"}
    for instance, text in texts.items():
        (tmp_path / "files" / f"instance_id={instance}").mkdir(parents=True)
        (tmp_path / "files" / f"instance_id={instance}" / "out.tsv").write_text(text, newline="")
    rows = [(f"instance_id={i}/out.tsv", text) for i, text in texts.items()]
    pack_output(spark.createDataFrame(rows, "file string, text string"), str(tmp_path / "packed"))
    columns = ("instance_id", "line_no", "line")
    got = read_output_lines(spark, str(tmp_path / "packed"), packed=True)
    assert values(got, *columns) == values(read_output_lines(spark, str(tmp_path / "files")), *columns)
    with pytest.raises(Exception, match="too large"):
        read_output_lines(spark, str(tmp_path / "packed"), max_bytes=5000, packed=True).collect()


def test_output_of_many_instances_lands_in_few_files(spark, tmp_path, monkeypatch):
    rows = [(i, i, 1 + i % 3, "F") for i in range(1, 400)] + [(900, None, 1, "P")]
    columns = "o_orderkey bigint, o_custkey bigint, day int, o_orderstatus string"
    orders = spark.createDataFrame(rows, columns).selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "make_timestamp_ntz(1995, 1, day, 0, 0, 0) AS o_orderdate",
        "10.5D AS o_totalprice", "'1-URGENT' AS o_orderpriority",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    folder = queries._write_output(spark, str(tmp_path))
    landed = [f for _, _, names in os.walk(folder.removeprefix("file:")) for f in names if not f.startswith((".", "_"))]
    assert len(landed) < 50
    lines = read_output_lines(spark, folder, packed=True)
    assert lines.select("instance_id").distinct().count() == 400
    assert lines.where("instance_id IS NULL").count() == 1


def test_summary_line_in_noise(spark):
    good = "2026-01-01T09:00:00.1Z\t1\t2\t3\t4\t7.0"
    lines = spark.createDataFrame(
        [
            (1, 1, "2026-01-01T08:00:00.1Z\t9\t9\t9\t9\t7.0"), (1, 2, good), (1, 3, "bye"),
            (2, 1, "only noise"), (2, 2, "a\tb"),
            (3, 1, "2026-01-01T09:00:00.1Z\t1\t\t3\t4\t"),
        ],
        "instance_id bigint, line_no bigint, line string",
    )
    out = pick_summary_line(lines)
    assert values(out, "instance_id", "stat_time", "logical_data_bytes", "complete") == [
        (1, day(1), 1, True),
        (3, None, 1, False),
    ]


def test_statistics_are_neither_dealt_by_sorting_nor_sorted_for_sums(spark, sf_dir):
    plan = view(spark, sf_dir, "db_documents")._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan
    sums = document_storage_summary(read_db_stats(view(spark, sf_dir, "db_documents")))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[instance_id" in plan.split("v#")[0]


def test_storage_of_documents_of_several_versions(spark):
    entry = '{"name":"d","ok":1,"dataSize":5,"indexSize":2,"storageSize":9}'
    texts = [
        (1, '{"ok":1,"version":"6.0","databases":[%s]}' % entry), (1, '{"ok":1,"version":"7.0","databases":[%s]}' % entry),
        (1, '{"ok":1,"databases":[]}'), (2, '{"ok":1,"databases":[%s]}' % entry), (3, '{"ok":1,"version":"7.0"}'),
        (4, '{"ok":1,"version":"7.0","databases":[%s]}' % entry), (4, '{"ok":false}'),
    ]
    stats = read_db_stats(spark.createDataFrame(texts, "instance_id bigint, document string"))
    got = values(document_storage_summary(stats), "instance_id", "logical_data_bytes", "physical_total_bytes", "mongo_version")
    assert got == [(1, 10, 22, "7.0"), (2, 5, 11, ""), (3, 0, 0, "7.0")]


def test_statistics_documents(spark):
    documents = spark.createDataFrame(
        [
            (1, '{"ok":1,"version":"7.0","databases":[{"name":"d","ok":1.0,"dataSize":5,"indexSize":2,'
                '"storageSize":9,"more":{"x":1}},{"name":"e","ok":0,"dataSize":100},'
                '{"name":"f","dataSize":100},{"name":"admin","ok":1,"dataSize":100}]}'),
            (2, '{"ok":1,"databases":[]}'),
            (3, '{"ok":0}'),
            (4, "connection refused"),
        ],
        "instance_id bigint, document string",
    )
    stats = read_db_stats(documents)
    assert values(list_ok(stats), "instance_id", "rc") == [(1, 0), (2, 0), (3, 1), (4, 1)]
    columns = ("instance_id", "logical_total_bytes", "physical_total_bytes", "mongo_version")
    assert values(document_storage_summary(stats), *columns) == [(1, 7, 11, "7.0"), (2, 0, 0, "")]

    a = assets(spark, *[(i, "MOS") for i in (1, 2, 3, 4)], kind="mongodb")
    out = collect.collect_doc_instances(a, stats, collect.no_errors(spark), "2026-01-09 00:00:00")
    assert values(out, "instance_id", "collect_status", "error_msg") == [
        (1, "ok", None), (2, "ok", None), (3, "failed", "summary_failed"),
        (4, "failed", "summary_failed"),
    ]
    assert tuple(run_summary(out).first()) == (2, 2)

    collections = spark.createDataFrame(
        [
            (1, '{"ok":1,"databases":[{"name":"d","collections":[{"name":"c","ok":1,"count":3,'
                '"size":10,"totalIndexSize":1,"storageSize":4},{"name":"system.x","ok":1,"size":99},'
                '{"name":"bad","ok":0,"size":99}]},{"name":"local","collections":'
                '[{"name":"l","ok":1,"size":99}]}]}'),
            (3, '{"ok":1,"databases":[{"name":"d","collections":[{"name":"c","ok":1,"size":99}]}]}'),
        ],
        "instance_id bigint, document string",
    )
    big = collect.collect_collections(read_coll_stats(collections), out, "2026-01-09 00:00:00", 0, 0)
    assert values(big, "instance_id", "coll_name", "logical_total_bytes", "physical_total_bytes") == [
        (1, "c", 11, 5)
    ]


def test_asset_records(spark, tmp_path):
    file = tmp_path / "assets.csv"
    file.write_text(
        "line_no,instance_name,alias_name,env,host,port,username,password,login_path\n"
        "4,a,,MOS,h,3307,u,p,\n,b,,,h,,u,p,lp\n"
    )
    out = read_asset_records(spark, str(file), "mysql", "csv")
    assert values(out, "instance_name", "port", "login_path") == [("a", "3307", None), ("b", None, "lp")]
    accepted, rejected = validate_assets(out, "mysql")
    assert values(accepted, "instance_name") == [("a",)]
    assert values(rejected, "instance_name", "reject_reason") == [("b", "missing_line_no")]


@pytest.mark.parametrize(
    ("token", "number"),
    [
        ("1024", 1024),
        ("1024.0", 1024),
        ("2.5e9", 2_500_000_000),
        ('{"$numberLong":"99"}', 99),
        ('{"$numberDouble":"7.0"}', 7),
        ("null", 0),
        ('"much"', None),
        ("true", None),
        ("1e40", None),
    ],
)
def test_number_forms_of_statistics(spark, token, number):
    """None: the entry is not ok and counts for nothing."""
    entry = '{"name":"%s","ok":1,"dataSize":%s,"indexSize":5,"storageSize":1}'
    text = '{"ok":1,"version":"7.0","databases":[%s,%s]}' % (entry % ("a", token), entry % ("b", "10"))
    stats = read_db_stats(spark.createDataFrame([(1, text)], "instance_id bigint, document string"))
    row = document_storage_summary(stats).first()
    want = (10, 5) if number is None else (number + 10, 10)
    assert (row.logical_data_bytes, row.logical_index_bytes) == want
    text = '{"ok":1,"databases":[{"name":"a","collections":[{"name":"c","ok":1,"count":%s}]}]}' % token
    found = read_coll_stats(spark.createDataFrame([(1, text)], "instance_id bigint, document string")).first()
    assert (found["ok"], found["count"]) == ((0.0, None) if number is None else (1.0, number or None))


def test_append_keeps_what_is_there(spark):
    path = scratch_path(spark, "append")
    append_snapshot(snaps(spark, (1, day(1), 1, "ok")), "mysql_instance", path)
    append_snapshot(snaps(spark, (1, day(1), 1, "ok"), (2, day(2), 0, "failed")), "mysql_instance", path)
    out = read_snapshots(spark, "mysql_instance", path)
    assert out.count() == 3
    assert sorted(d for d in os.listdir(path) if d.startswith("stat_date")) == [
        "stat_date=2026-01-01", "stat_date=2026-01-02"
    ]
    assert read_snapshots(spark, "mysql_instance", path, from_date="2026-01-02").count() == 1


def test_objects_of_failed_instances_are_not_stored(spark):
    path = scratch_path(spark, "objects")
    t = rank_objects(tables(spark, (1, "t", day(1), 1, 1), (2, "t", day(1), 1, 1)))
    status = snaps(spark, (1, day(1), 1, "ok"), (2, day(1), 1, "failed"))
    append_objects(t.withColumn("engine", F.lit("e")), status, "mysql_object", path)
    assert values(read_snapshots(spark, "mysql_object", path), "instance_id") == [(1,)]


def test_tables_are_created_once(spark, tmp_path):
    names = TableNames(database="waterline_test", assets="my_assets")
    ensure_tables(spark, names, str(tmp_path))
    append_snapshot_table(snaps(spark, (1, day(1), 5, "ok")), "mysql_instance", names)
    ensure_tables(spark, names, str(tmp_path))
    stored = spark.table(names.of("mysql_instance"))
    assert values(stored, "instance_id", "stat_time", "stat_date") == [(1, day(1), day(1).date())]
    assert spark.table("waterline_test.my_assets").count() == 0
    out = reports.r3(assets(spark, (1, "MOS")), stored)
    assert out.count() == 1
    spark.sql("DROP DATABASE waterline_test CASCADE")


def test_assets_are_stored_in_versions(spark):
    path = scratch_path(spark, "assets")
    assert read_assets(spark, path).count() == 0
    first = assets(spark, (1, "MOS"), (2, "RTM")).withColumns(
        {f.name: F.lit(None) for f in ASSETS.fields if f.name in ("username", "secret_ref", "created_at", "updated_at")}
    )
    assert store_assets(first, path) == 1
    before = read_assets(spark, path)
    # The next version is made from the one it replaces.
    assert store_assets(before.withColumn("env", F.lit("MIB2")), path) == 2
    assert values(read_assets(spark, path), "instance_id", "env") == [(1, "MIB2"), (2, "MIB2")]
    assert values(before, "instance_id", "env") == [(1, "MOS"), (2, "RTM")]
    # Files that were never published count for nothing.
    before.limit(1).write.parquet(f"{path}/version-00000009-lost")
    assert read_assets(spark, path).count() == 2


def test_cells(spark):
    report = spark.createDataFrame(
        [(1, "+1.00", "ok"), (2, "-", "failed"), (3, "0", None), (4, "x", "")],
        "id int, diff_fmt string, last_status string",
    )
    out = report_cells(report, ["id"])
    marked = values(out.where("highlight"), "id", "column_name", "cell")
    # A lone minus starts with a sign, so it is marked too.
    assert marked == [(1, "diff_fmt", "+1.00"), (2, "diff_fmt", "-"), (2, "last_status", "failed")]
    assert out.count() == 8


def test_interleaved_loads_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "assets")
    none = spark.createDataFrame([], ASSETS)
    assert store_assets(none, path) == 1

    def with_one(held, instance):
        row = spark.createDataFrame([(instance,)], "instance_id bigint")
        return held.unionByName(row, allowMissingColumns=True)

    # Both start from version 1; the second must not replace what the first stored.
    base, held = read_version(spark, path)
    assert store_assets(with_one(held, 7), path, base) == 2
    with pytest.raises(StaleAssets):
        store_assets(with_one(held, 8), path, base)
    assert update_assets(spark, path, lambda x: with_one(x, 8)) == 3
    assert sorted(r["instance_id"] for r in read_assets(spark, path).collect()) == [7, 8]

    # A load that comes in while another merges.
    seen = []

    def slow(x):
        if not seen:
            seen.append(update_assets(spark, path, lambda y: with_one(y, 9)))
        return with_one(x, 10)

    assert update_assets(spark, path, slow) == 5 and seen == [4]
    assert sorted(r["instance_id"] for r in read_assets(spark, path).collect()) == [7, 8, 9, 10]


def test_claim_of_a_lost_load(spark, tmp_path):
    path = str(tmp_path / "assets")
    none = spark.createDataFrame([], ASSETS)
    store_assets(none, path)
    lost = spark.createDataFrame([(2, "gone", True)], "version bigint, folder string, held boolean")
    lost.write.mode("append").parquet(f"{path}/claims")
    with pytest.raises(StaleAssets):
        store_assets(none, path)
    release_claims(spark, path)
    assert store_assets(none, path) == 2


@pytest.mark.parametrize("single", [True, False])
def test_exported_lines_are_in_order(spark, tmp_path, single):
    report = spark.range(0, 5_000, 1, 8).select(F.pmod(F.xxhash64("id"), F.lit(700)).alias("size"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = export_tsv(report, str(tmp_path), "ordered", single, [F.desc("size"), F.asc("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    lines = [x.split("\t") for p in parts for x in open(os.path.join(path, p)).read().splitlines()[1:]]
    got = [(int(a), int(b)) for a, b in lines]
    assert len(parts) == 1 if single else len(parts) > 1
    assert got == sorted(((r["size"], r["id"]) for r in report.collect()), key=lambda r: (-r[0], r[1]))


def test_days_are_merged_and_repeatable(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(0, 600).select(
        (F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("stat_time"),
        (F.col("id") % 7).alias("instance_id"),
        F.col("id").alias("logical_total_bytes"),
        F.lit("ok").alias("collect_status"),
    )
    full = spark.createDataFrame([], FACTS["mysql_instance"]).unionByName(rows, allowMissingColumns=True)
    merge_days(full.where("logical_total_bytes < 300"), "mysql_instance", path, ["instance_id"])
    merge_days(full, "mysql_instance", path, ["instance_id"])
    once = sorted(map(str, read_snapshots(spark, "mysql_instance", path).collect()))
    merge_days(full.where("logical_total_bytes between 100 and 200"), "mysql_instance", path, ["instance_id"])
    merge_days(full.limit(0), "mysql_instance", path, ["instance_id"])
    assert sorted(map(str, read_snapshots(spark, "mysql_instance", path).collect())) == once
    assert len(once) == 25 * 7
