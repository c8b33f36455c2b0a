"""Runs queries beside their check SQL and reports differences."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from waterline.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


_SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "tinyint": "TINYINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark: SparkSession, sf_dir: str, query, sql: str, connection=None) -> list[str]:
    """Differences between a query and its check, none if they agree."""
    connection = connection or connect(sf_dir)
    result = query(spark, sf_dir)
    got_names, got = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    cursor = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    want_names, want = _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    problems = [
        f"type of {name}: {kind} != {types[name]}"
        for name, kind in result.dtypes
        if _SAME_TYPES.get(kind, kind) != types[name]
    ]
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        wrong = [(g, w) for g, w in zip(got, want) if g != w][:2]
        problems.append(f"values differ: {wrong}")
    if not got:
        problems.append("no rows")
    return problems


def main() -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        configure(SparkSession.builder.master("local[8]"), shuffle_partitions=8)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.autoBroadcastJoinThreshold", os.environ.get("CHECK_BROADCAST", "10MB"))
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_ZONE", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        if name not in ORACLES:
            print(f"{name}: no check SQL")
            continue
        try:
            problems = compare(spark, sf_dir, QUERIES[name], ORACLES[name], connection)
        except Exception as error:  # a broken query must not hide the others
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        failed += bool(problems)
        print(f"{name}: {'ok' if not problems else problems} {time.time() - start:.1f}s", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
