"""Validation of asset import records and the two rules for merging them into the asset table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.functions import blank_to_null, is_blank, seal_uri, strip_quotes, uri_host_port
from waterline.model import ASSETS, ENVS, RELATIONAL_DEFAULT_PORT
from waterline.operators.filters import normalize_asset_types
from waterline.operators.ranking import dense_numbers
from waterline.sources.scratch import scratch_path

# What makes two assets the same one. The environment may be NULL and then matches NULL.
NATURAL_KEY = ("type", "env", "host", "port", "instance_name")


def fill_asset_defaults(records: DataFrame, kind: str) -> DataFrame:
    """Blank fields to NULL and the defaults of the kind; ports and flags become numbers."""
    if kind == "mysql":
        text = records.withColumns(
            {c: blank_to_null(F.col(c)) for c in records.columns if c not in ("line_no", "port")}
        )
        port = F.coalesce(blank_to_null(F.col("port")), F.lit(str(RELATIONAL_DEFAULT_PORT)))
        return text.withColumns({"type": F.lit("mysql"), "port": port.try_cast("int")})

    text = records.withColumns(
        {c: blank_to_null(strip_quotes(F.col(c))) for c in records.columns if c != "line_no"}
    )
    host, port = uri_host_port(F.col("mongo_uri"))
    flag = F.coalesce("is_active", F.lit("1"))
    active = F.coalesce(flag.try_cast("tinyint"), flag.try_cast("boolean").cast("tinyint"))
    return text.withColumns({"host": host, "port": port, "is_active": active})


def _reject_reason(kind: str) -> Column:
    bad_env = F.col("env").isNotNull() & ~F.col("env").isin(*ENVS)
    if kind == "mysql":
        incomplete = F.lit(False)
        for name in ("host", "username", "password"):
            incomplete = incomplete | F.col(name).isNull()
        return (
            F.when(F.col("line_no").isNull(), "missing_line_no")
            .when(incomplete, "missing_required")
            .when(bad_env, "invalid_env")
            .when(F.col("port").isNull(), "invalid_port")
        )
    return (
        F.when(F.col("line_no").isNull(), "missing_line_no")
        .when(F.col("type") != "mongo", "unexpected_type")
        .when(F.col("mongo_uri").isNull(), "missing_uri")
        .when(bad_env, "invalid_env")
        .when(is_blank(F.col("host")), "invalid_uri")
        .when(F.col("port").isNull(), "invalid_port")
        .when(F.col("is_active").isNull(), "invalid_flag")
    )


def validate_assets(records: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Accepted records with defaults filled in, and rejected ones with their reject_reason.

    Records without an instance name are dropped. Passwords never leave this step.
    """
    filled = fill_asset_defaults(records, kind).where(F.col("instance_name").isNotNull())
    judged = filled.withColumn("reject_reason", _reject_reason(kind))
    if kind == "mysql":
        judged = judged.drop("password")
    else:
        judged = judged.withColumn("type", F.lit("mongodb"))
    accepted = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, judged.where(F.col("reject_reason").isNotNull())


def _found(assets: DataFrame, incoming: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Incoming records, one for each natural key, with the lowest instance_id of the assets they name; NULL for new ones.

    Table and import are grouped in one pass, whose result goes to the shared folder: fills, inserts and the numbers
    of new assets read it there, and the import is evaluated once.
    """
    absent = [F.lit(None).cast(incoming.schema[c].dataType).alias(c) for c in fields]
    held = assets.select(*NATURAL_KEY, "instance_id", *absent, F.lit(False).alias("_given"))
    new = incoming.select(
        *NATURAL_KEY, F.lit(None).cast("bigint").alias("instance_id"), *fields, F.lit(True).alias("_given")
    )
    # Grouping takes NULL as equal to NULL.
    grouped = held.unionByName(new).groupBy(*NATURAL_KEY).agg(
        F.min("instance_id").alias("instance_id"),
        *[F.max(c).alias(c) for c in fields],
        F.bool_or("_given").alias("_given"),
    )
    found = grouped.where("_given").drop("_given")
    spark = assets.sparkSession
    path = scratch_path(spark, "asset-import")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _matches(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """instance_id and incoming values of every asset that an incoming record names."""
    return found.where(F.col("instance_id").isNotNull()).select(
        "instance_id", *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("matched")
    )


def _insert(
    assets: DataFrame, found: DataFrame, run_ts: str, values: dict[str, Column]
) -> DataFrame:
    """New asset rows for the incoming records that name no existing asset."""
    fresh = found.where(F.col("instance_id").isNull()).drop("instance_id")
    # A one-row subquery, evaluated once when the result runs.
    highest = assets.agg(F.coalesce(F.max("instance_id"), F.lit(0))).scalar()
    numbered = dense_numbers(fresh, NATURAL_KEY, "_new_number")
    time = F.lit(run_ts).cast("timestamp_ntz")
    given = {
        "instance_id": highest + F.col("_new_number"),
        "created_at": time,
        "updated_at": time,
        **values,
    }
    return numbered.select(
        *[
            given.get(
                f.name,
                F.col(f.name) if f.name in numbered.columns else F.lit(None),
            )
            .cast(f.dataType)
            .alias(f.name)
            for f in ASSETS.fields
        ]
    )


def _with_asset_schema(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ASSETS.fields])


def upsert_assets_fill(
    assets: DataFrame, incoming: DataFrame, run_ts: str, fill_on_insert: bool = False
) -> DataFrame:
    """Relational rule: insert unknown assets, and only fill a blank login_path of known ones.

    Records count in line_no order, so a repeated record finds the asset its first copy made. A
    new asset keeps a missing login_path unless a second copy or `fill_on_insert` supplies one.
    """
    order = Window.partitionBy(*NATURAL_KEY).orderBy("line_no")
    first_two = incoming.withColumn("_copy", F.row_number().over(order)).where(F.col("_copy") <= 2)
    is_first = F.col("_copy") == 1
    merged = first_two.groupBy(*NATURAL_KEY).agg(
        F.max(F.when(is_first, F.col("alias_name"))).alias("alias_name"),
        F.max(F.when(is_first, F.col("username"))).alias("username"),
        F.max(F.when(is_first, F.col("login_path"))).alias("login_path"),
        F.max(F.when(~is_first, F.coalesce("login_path", "instance_name"))).alias("repeated_path"),
    )

    found = _found(assets, merged, ["alias_name", "username", "login_path", "repeated_path"])
    matched = _matches(found, ["login_path"])
    fills = F.col("matched") & blank_to_null(F.col("login_path")).isNull()
    filled = F.coalesce(fills, F.lit(False))
    kept = assets.join(matched, "instance_id", "left").withColumns(
        {
            "login_path": F.when(
                filled, F.coalesce("new_login_path", "instance_name")
            ).otherwise(F.col("login_path")),
            "updated_at": F.when(filled, F.lit(run_ts).cast("timestamp_ntz")).otherwise(
                F.col("updated_at")
            ),
        }
    )
    path = F.coalesce("login_path", "instance_name" if fill_on_insert else "repeated_path")
    added = _insert(
        assets,
        found,
        run_ts,
        {"auth_mode": F.lit("login_path"), "login_path": path, "is_active": F.lit(1)},
    )
    return _with_asset_schema(kept).unionByName(added)


def upsert_assets_overwrite(assets: DataFrame, incoming: DataFrame, run_ts: str) -> DataFrame:
    """Document rule: insert unknown assets, and overwrite what is known of the others.

    `incoming` carries its sealed URI in login_path. The last copy of a repeated record wins.
    """
    assets = normalize_asset_types(assets)
    fields = ("alias_name", "login_path", "is_active")
    latest = incoming.groupBy(*NATURAL_KEY).agg(
        F.max_by(F.struct(*fields), "line_no").alias("_record")
    )
    latest = latest.select(*NATURAL_KEY, "_record.*")
    found = _found(assets, latest, fields).withColumn("auth_mode", F.lit("mongo_uri_aes"))

    overwritten = (*fields, "auth_mode")
    matched = _matches(found, overwritten)
    hit = F.coalesce("matched", F.lit(False))
    kept = assets.join(matched, "instance_id", "left").withColumns(
        {
            **{c: F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)) for c in overwritten},
            "updated_at": F.when(hit, F.lit(run_ts).cast("timestamp_ntz")).otherwise(
                F.col("updated_at")
            ),
        }
    )
    return _with_asset_schema(kept).unionByName(_insert(assets, found, run_ts, {}))


def load_assets(
    assets: DataFrame,
    records: DataFrame,
    kind: str,
    run_ts: str,
    key_hex: str | None = None,
    iv_hex: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Merge import records by the rule of their kind; gives the new asset table and the rejects.

    Document assets store their URI sealed, so they need the key and IV.
    """
    accepted, rejected = validate_assets(records, kind)
    if kind == "mysql":
        return upsert_assets_fill(assets, accepted, run_ts), rejected
    if key_hex is None or iv_hex is None:
        raise ValueError("document assets need key_hex and iv_hex to seal their URIs")
    sealed = accepted.withColumn("login_path", seal_uri(F.col("mongo_uri"), key_hex, iv_hex))
    return upsert_assets_overwrite(assets, sealed.drop("mongo_uri"), run_ts), rejected
