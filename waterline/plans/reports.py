"""The reports. Column names are the exported contract; sizes are GiB with two decimals."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions import (
    env_label,
    fmt_bytes_diff,
    fmt_count_diff,
    fmt_signed_gb,
    is_ok,
    to_gb,
)
from waterline.model import STATUS_FAILED
from waterline.operators.filters import filter_assets, with_status
from waterline.operators.ranking import (
    order_abs_diff,
    order_by_size,
    order_env_diff,
    order_failed,
    order_objects,
    top_k,
)
from waterline.operators.rollups import env_rollup, env_rollup_diff
from waterline.operators.size import broadcast_if, is_small
from waterline.operators.snapshots import (
    aligned_last_vs_prev,
    gate_latest_ok,
    last_vs_prev,
    latest,
)

INSTANCE = ("instance_id",)
TABLE = ("instance_id", "schema_name", "table_name")
COLLECTION = ("instance_id", "db_name", "coll_name")

_ASSET_COLUMNS = ("env", "alias_name", "instance_name", "host", "port")


class Pointers(NamedTuple):
    """Kept pointers of the facts that a report reads (operators.pointers); None: found in the history."""

    instances: DataFrame | None = None
    objects: DataFrame | None = None

    def of_assets(self, assets: DataFrame, few: bool) -> Pointers:
        """Those of the given assets."""
        return Pointers(*[p if p is None else of_assets(p, assets, few) for p in self])


NOT_KEPT = Pointers()


def with_asset(df: DataFrame, assets: DataFrame, few: bool = False) -> DataFrame:
    """Add the asset's labels; rows of unknown instances are dropped."""
    labels = assets.select("instance_id", *_ASSET_COLUMNS)
    return df.join(broadcast_if(few, labels), "instance_id")


def of_assets(df: DataFrame, assets: DataFrame, few: bool) -> DataFrame:
    """Rows of the given assets. Applied to facts first, it bounds their instances by the assets."""
    return df.join(broadcast_if(few, assets.select("instance_id")), "instance_id", "left_semi")


def _relational(assets: DataFrame) -> DataFrame:
    return filter_assets(assets, "mysql")


def _document(assets: DataFrame) -> DataFrame:
    return filter_assets(assets, "mongodb", "mongo_uri_aes")


def _env() -> Column:
    return env_label(F.col("env")).alias("env")


def _sizes(measure: str, shown: str, missing: Column | None = None) -> list[Column]:
    """last_, prev_ and diff_ columns of one byte measure."""
    last, prev = F.col(f"last_{measure}"), F.col(f"prev_{measure}")
    return [
        to_gb(last).alias(f"last_{shown}_gb"),
        to_gb(prev).alias(f"prev_{shown}_gb"),
        fmt_bytes_diff(last, prev, missing).alias(f"diff_{shown}_gb_fmt"),
    ]


def newest_runs(assets: DataFrame, instances: DataFrame, kept: Pointers = NOT_KEPT) -> DataFrame:
    """Latest snapshots of the assets with their labels."""
    few = is_small(assets)
    times = kept.of_assets(assets, few).instances
    newest = latest(of_assets(instances, assets, few), INSTANCE, few=few, pointers=times)
    return with_asset(newest, assets, few)


def _instances_last_vs_prev(
    assets: DataFrame, instances: DataFrame, *measures: str, kept: Pointers = NOT_KEPT
) -> DataFrame:
    """Latest and previous snapshots of the assets with their labels."""
    few = is_small(assets)
    known = of_assets(instances, assets, few)
    times = kept.of_assets(assets, few).instances
    ok = is_ok(F.col("collect_status"))
    compared = last_vs_prev(known, INSTANCE, measures, ok=ok, few=few, pointers=times)
    return with_asset(compared, assets, few)


def _settled(rows: DataFrame) -> DataFrame:
    """The few rows picked from many, shuffled once before a sort.

    A sort reads its input twice, first to sample it. This way that is not the facts.
    """
    return rows.hint("rebalance", "instance_id")


# Relational instances and tables


def r1(assets: DataFrame, instances: DataFrame, kept: Pointers = NOT_KEPT) -> DataFrame:
    """Instances whose latest snapshot failed. Assets of any type count."""
    failed = with_status(newest_runs(filter_assets(assets), instances, kept), STATUS_FAILED)
    return _settled(failed).orderBy(*order_failed()).select(
        _env(),
        "alias_name",
        "instance_name",
        "host",
        "port",
        F.col("stat_time").alias("last_stat_time"),
        to_gb(F.col("logical_total_bytes")).alias("logical_total_gb"),
        "mysql_version",
        F.col("collect_status").alias("last_collect_status"),
        "error_msg",
    )


def r2(assets: DataFrame, instances: DataFrame, kept: Pointers = NOT_KEPT) -> DataFrame:
    """Environment summary, latest against previous."""
    compared = _instances_last_vs_prev(_relational(assets), instances, "logical_total_bytes", kept=kept)
    envs = env_rollup_diff(compared)
    change = fmt_signed_gb(F.col("diff_bytes"), F.col("compared_count") == 0)
    return envs.orderBy(*order_env_diff("diff_bytes", "last_bytes")).select(
        "env",
        "instance_count",
        to_gb(F.col("last_bytes")).alias("last_env_total_gb"),
        to_gb(F.col("prev_bytes")).alias("prev_env_total_gb"),
        change.alias("diff_env_total_gb_fmt"),
    )


def r3(
    assets: DataFrame,
    instances: DataFrame,
    endpoint: bool = False,
    order: str = "size",
    kept: Pointers = NOT_KEPT,
) -> DataFrame:
    """Instances, latest against previous. `order` is 'size' or 'abs_diff'."""
    measures = ("logical_data_bytes", "logical_index_bytes", "logical_total_bytes")
    compared = _instances_last_vs_prev(_relational(assets), instances, *measures, kept=kept)
    names = ("instance_name", "instance_id")
    by_change = order_abs_diff("last_logical_total_bytes", "prev_logical_total_bytes", *names)
    by_size = order_by_size("last_logical_total_bytes", *names)
    no_prev = F.col("prev_stat_time").isNull()
    sizes = [
        column
        for measure, shown in zip(measures, ("data", "index", "total"))
        for column in _sizes(measure, shown, no_prev)
    ]
    return compared.orderBy(*(by_change if order == "abs_diff" else by_size)).select(
        _env(),
        "alias_name",
        "instance_name",
        *(["host", "port"] if endpoint else []),
        *sizes,
        "last_stat_time",
        "prev_stat_time",
    )


def _gated(
    objects: DataFrame, reported: DataFrame, instances: DataFrame, few: bool, kept: Pointers
) -> DataFrame:
    """Objects of instances whose newest run succeeded, with their labels."""
    runs = of_assets(instances, reported, few)
    passed = gate_latest_ok(objects, runs, few=few, pointers=kept.instances)
    return with_asset(passed, reported, few)


def r4(
    assets: DataFrame, instances: DataFrame, objects: DataFrame, kept: Pointers = NOT_KEPT
) -> DataFrame:
    """Tables at their own latest snapshot, of instances whose latest run succeeded."""
    reported = _relational(assets)
    few = is_small(reported)
    kept = kept.of_assets(reported, few)
    current = latest(of_assets(objects, reported, few), TABLE, pointers=kept.objects)
    names = ("alias_name", "instance_name", "schema_name", "table_name", "instance_id")
    return (
        _settled(_gated(current, reported, instances, few, kept))
        .orderBy(*order_objects("total_bytes", *names))
        .select(
            _env(),
            "alias_name",
            "instance_name",
            "schema_name",
            "table_name",
            F.col("table_rows").alias("last_table_rows"),
            to_gb(F.col("data_bytes")).alias("last_data_gb"),
            to_gb(F.col("index_bytes")).alias("last_index_gb"),
            to_gb(F.col("total_bytes")).alias("last_total_gb"),
            F.col("stat_time").alias("last_stat_time"),
        )
    )


def _tables_last_vs_prev(
    assets: DataFrame, instances: DataFrame, objects: DataFrame, kept: Pointers, *measures: str
) -> DataFrame:
    reported = _relational(assets)
    few = is_small(reported)
    kept = kept.of_assets(reported, few)
    compared = last_vs_prev(of_assets(objects, reported, few), TABLE, measures, pointers=kept.objects)
    return _gated(compared, reported, instances, few, kept)


def r5(
    assets: DataFrame, instances: DataFrame, objects: DataFrame, kept: Pointers = NOT_KEPT
) -> DataFrame:
    """Tables, latest against previous, largest change of the row count first."""
    compared = _tables_last_vs_prev(assets, instances, objects, kept, "table_rows", "total_bytes")
    names = ("alias_name", "instance_name", "schema_name", "table_name", "instance_id")
    last, prev = F.col("last_total_bytes"), F.col("prev_total_bytes")
    rows, prev_rows = F.col("last_table_rows"), F.col("prev_table_rows")
    return compared.orderBy(*order_abs_diff("last_table_rows", "prev_table_rows", *names)).select(
        _env(),
        F.col("alias_name").alias("instance_name"),
        "schema_name",
        "table_name",
        fmt_bytes_diff(last, prev).alias("diff_total_fmt"),
        fmt_count_diff(rows, prev_rows).alias("diff_rows_fmt"),
        to_gb(last).alias("last_total"),
        to_gb(prev).alias("prev_total"),
        rows.alias("last_rows"),
        prev_rows.alias("prev_rows"),
        "last_stat_time",
        "prev_stat_time",
    )


def r5_bytes(
    assets: DataFrame, instances: DataFrame, objects: DataFrame, kept: Pointers = NOT_KEPT
) -> DataFrame:
    """Tables, latest against previous, largest change of the size first."""
    compared = _tables_last_vs_prev(assets, instances, objects, kept, "table_rows", "total_bytes")
    names = ("alias_name", "instance_name", "schema_name", "table_name", "instance_id")
    last, prev = F.col("last_total_bytes"), F.col("prev_total_bytes")
    rows, prev_rows = F.col("last_table_rows"), F.col("prev_table_rows")
    return compared.orderBy(*order_abs_diff("last_total_bytes", "prev_total_bytes", *names)).select(
        _env(),
        "alias_name",
        "instance_name",
        "schema_name",
        "table_name",
        "last_stat_time",
        "prev_stat_time",
        fmt_bytes_diff(last, prev).alias("diff_total_gb_fmt"),
        fmt_count_diff(rows, prev_rows).alias("diff_table_rows_fmt"),
        to_gb(last).alias("last_total_gb"),
        to_gb(prev).alias("prev_total_gb"),
        "last_table_rows",
        "prev_table_rows",
    )


def r5_wide(
    assets: DataFrame, instances: DataFrame, objects: DataFrame, kept: Pointers = NOT_KEPT
) -> DataFrame:
    """Tables with the changes of all sizes, largest table first."""
    compared = _tables_last_vs_prev(
        assets, instances, objects, kept, "table_rows", "data_bytes", "index_bytes", "total_bytes"
    )
    names = ("alias_name", "schema_name", "table_name", "instance_id")
    rows, prev_rows = F.col("last_table_rows"), F.col("prev_table_rows")
    return compared.orderBy(*order_objects("last_total_bytes", *names)).select(
        _env(),
        "alias_name",
        "instance_name",
        "schema_name",
        "table_name",
        "last_stat_time",
        "prev_stat_time",
        "last_table_rows",
        "prev_table_rows",
        fmt_count_diff(rows, prev_rows).alias("diff_table_rows_fmt"),
        *_sizes("data_bytes", "data"),
        *_sizes("index_bytes", "index"),
        *_sizes("total_bytes", "total"),
    )


# Document instances and collections


def r6(
    assets: DataFrame,
    instances: DataFrame,
    status: str | None = STATUS_FAILED,
    kept: Pointers = NOT_KEPT,
) -> DataFrame:
    """Latest snapshots of document instances, failed ones by default; status=None gives all."""
    newest = newest_runs(_document(assets), instances, kept)
    if status is not None:
        newest = with_status(newest, status)
    return _settled(newest).orderBy(*order_failed()).select(
        _env(),
        "alias_name",
        "instance_name",
        F.col("stat_time").alias("last_stat_time"),
        to_gb(F.col("logical_total_bytes")).alias("logical_total_gb"),
        to_gb(F.col("physical_total_bytes")).alias("physical_total_gb"),
        "mongo_version",
        F.col("collect_status").alias("last_collect_status"),
        "error_msg",
    )


def r7(assets: DataFrame, instances: DataFrame, kept: Pointers = NOT_KEPT) -> DataFrame:
    """Environment summary of document instances; failed latest snapshots count too."""
    envs = env_rollup(newest_runs(_document(assets), instances, kept))
    return envs.orderBy(*order_by_size("logical_bytes")).select(
        "env",
        "instance_count",
        to_gb(F.col("logical_bytes")).alias("last_env_logical_total_gb"),
        to_gb(F.col("physical_bytes")).alias("last_env_physical_total_gb"),
    )


def r8(
    assets: DataFrame, instances: DataFrame, endpoint: bool = False, kept: Pointers = NOT_KEPT
) -> DataFrame:
    """Document instances, latest against previous."""
    measures = ("logical_total_bytes", "physical_total_bytes")
    compared = _instances_last_vs_prev(_document(assets), instances, *measures, kept=kept)
    no_prev = F.col("prev_stat_time").isNull()
    order = order_by_size("last_logical_total_bytes", "instance_name", "instance_id")
    return compared.orderBy(*order).select(
        _env(),
        "alias_name",
        "instance_name",
        *(["host", "port"] if endpoint else []),
        *_sizes("logical_total_bytes", "logical_total", no_prev),
        *_sizes("physical_total_bytes", "physical_total", no_prev),
        "last_stat_time",
        "prev_stat_time",
    )


def r9(
    assets: DataFrame, objects: DataFrame, k: int = 50, kept: Pointers = NOT_KEPT
) -> DataFrame:
    """Largest collections at their own latest snapshot."""
    reported = _document(assets)
    few = is_small(reported)
    times = kept.of_assets(reported, few).objects
    newest = latest(of_assets(objects, reported, few), COLLECTION, pointers=times)
    current = with_asset(newest, reported, few)
    order = [
        to_gb(F.col("logical_total_bytes")).desc(),
        *[F.asc(c) for c in COLLECTION],
        F.desc("logical_total_bytes"),
        F.desc("physical_total_bytes"),
        F.desc("doc_count"),
    ]
    return top_k(current, order, k).select(
        _env(),
        "alias_name",
        "instance_name",
        "db_name",
        "coll_name",
        "doc_count",
        to_gb(F.col("logical_total_bytes")).alias("logical_total_gb"),
        to_gb(F.col("physical_total_bytes")).alias("physical_total_gb"),
    )


_COLLECTION_MEASURES = (
    "doc_count",
    "data_bytes",
    "index_bytes",
    "logical_total_bytes",
    "physical_total_bytes",
)


def _collections_last_vs_prev(
    assets: DataFrame, instances: DataFrame, objects: DataFrame, k: int, kept: Pointers
) -> DataFrame:
    reported = _document(assets)
    few = is_small(reported)
    runs = of_assets(instances, reported, few)
    times = kept.of_assets(reported, few).instances
    compared = aligned_last_vs_prev(
        runs, objects, COLLECTION[1:], _COLLECTION_MEASURES, few=few, pointers=times
    )
    joined = with_asset(compared, reported, few)
    names = ("alias_name", "instance_name", "db_name", "coll_name", "instance_id")
    rest = [F.desc(f"{side}_{m}") for side in ("last", "prev") for m in _COLLECTION_MEASURES]
    order = [*order_abs_diff("last_doc_count", "prev_doc_count", *names), *rest]
    return top_k(joined, order, k)


def r10(
    assets: DataFrame,
    instances: DataFrame,
    objects: DataFrame,
    k: int = 10,
    kept: Pointers = NOT_KEPT,
) -> DataFrame:
    """Collections of the latest run against the previous run, largest change of documents."""
    top = _collections_last_vs_prev(assets, instances, objects, k, kept)
    no_prev = F.col("prev_doc_count").isNull()
    sizes = [
        column
        for measure, shown in zip(_COLLECTION_MEASURES[1:], ("data", "index", "total", "physical"))
        for column in _sizes(measure, shown, no_prev)[:2]
    ]
    docs, prev_docs = F.col("last_doc_count"), F.col("prev_doc_count")
    total, prev_total = F.col("last_logical_total_bytes"), F.col("prev_logical_total_bytes")
    return top.select(
        _env(),
        "alias_name",
        "db_name",
        "coll_name",
        fmt_bytes_diff(total, prev_total, no_prev).alias("diff_total_gb_fmt"),
        fmt_count_diff(docs, prev_docs, no_prev).alias("diff_doc_count_fmt"),
        "last_doc_count",
        "prev_doc_count",
        *sizes,
        "last_stat_time",
        "prev_stat_time",
    )


def r10_wide(
    assets: DataFrame,
    instances: DataFrame,
    objects: DataFrame,
    k: int = 10,
    kept: Pointers = NOT_KEPT,
) -> DataFrame:
    """Same rows with the changes of every size."""
    top = _collections_last_vs_prev(assets, instances, objects, k, kept)
    no_prev = F.col("prev_doc_count").isNull()
    docs, prev_docs = F.col("last_doc_count"), F.col("prev_doc_count")
    return top.select(
        _env(),
        "alias_name",
        "instance_name",
        "db_name",
        "coll_name",
        "last_stat_time",
        "prev_stat_time",
        "last_doc_count",
        "prev_doc_count",
        fmt_count_diff(docs, prev_docs, no_prev).alias("diff_doc_count_fmt"),
        *_sizes("data_bytes", "data", no_prev),
        *_sizes("index_bytes", "index", no_prev),
        *_sizes("logical_total_bytes", "total", no_prev),
        *_sizes("physical_total_bytes", "physical", no_prev)[:2],
    )


# Names of the exported report files.
RELATIONAL_EXPORTS = {
    "q1_failed_instances": lambda assets, instances, objects: r1(assets, instances),
    "q2_env_summary": lambda assets, instances, objects: r2(assets, instances),
    "q3_instance_last_vs_prev": lambda assets, instances, objects: r3(assets, instances),
    "q4_table_last": r4,
    "q5_table_diff": r5,
}
DOCUMENT_EXPORTS = {
    "q1_instance_latest": lambda assets, instances, objects: r6(assets, instances),
    "q2_env_summary": lambda assets, instances, objects: r7(assets, instances),
    "q3_instance_last_vs_prev": lambda assets, instances, objects: r8(assets, instances),
    "q4_collection_latest_topn": lambda assets, instances, objects: r9(assets, objects),
    "q5_collection_diff": r10,
}
