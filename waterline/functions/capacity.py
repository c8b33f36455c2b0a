"""Sizes, differences and labels shown in the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waterline.model import ENVS, STATUS_OK


def env_label(env: Column) -> Column:
    """Environment as shown: NULL and '' become '-'."""
    return F.coalesce(F.nullif(env, F.lit("")), F.lit("-"))


def env_order(env: Column) -> Column:
    """Position of the environment in its declared domain; NULL sorts first."""
    position = F.array_position(F.array(*[F.lit(e) for e in ENVS]), env)
    return position.cast("int")


def is_ok(status: Column) -> Column:
    return status == STATUS_OK


def to_gb(size: Column) -> Column:
    """Bytes as GiB, two decimals, half up."""
    return F.round(size / F.lit(float(1024**3)), 2)


def object_total(data: Column, index: Column) -> Column:
    """Data plus index bytes of one object, a missing side counts as zero."""
    return F.coalesce(data, F.lit(0)) + F.coalesce(index, F.lit(0))


def _signed(diff: Column, missing: Column, magnitude: Column) -> Column:
    # The sign comes from the raw difference, so a tiny change is never a plain 0.
    sign = F.when(diff > 0, "+").when(diff < 0, "-")
    return F.when(missing, "-").otherwise(F.coalesce(F.concat(sign, magnitude), F.lit("0")))


def fmt_signed_gb(diff: Column, missing: Column) -> Column:
    """Byte difference as text: '-' if there is nothing to compare, else '+x', '-x' or '0'."""
    return _signed(diff, missing, to_gb(F.abs(diff)).cast("decimal(20,2)").cast("string"))


def fmt_signed_count(diff: Column, missing: Column) -> Column:
    return _signed(diff, missing, F.abs(diff).cast("string"))


def fmt_bytes_diff(last: Column, prev: Column, missing: Column | None = None) -> Column:
    return fmt_signed_gb(last - prev, prev.isNull() if missing is None else missing)


def fmt_count_diff(last: Column, prev: Column, missing: Column | None = None) -> Column:
    return fmt_signed_count(last - prev, prev.isNull() if missing is None else missing)
