"""Column expressions. All are built-in Spark functions, there is no Python UDF."""

from waterline.functions.capacity import (
    env_label,
    env_order,
    fmt_bytes_diff,
    fmt_count_diff,
    fmt_signed_count,
    fmt_signed_gb,
    is_ok,
    object_total,
    to_gb,
)
from waterline.functions.text import (
    blank_to_null,
    is_blank,
    normalize_iso_text,
    normalize_iso_time,
    open_uri,
    seal_uri,
    strip_breaks,
    strip_quotes,
    uri_host_port,
)

__all__ = [
    "blank_to_null",
    "env_label",
    "env_order",
    "fmt_bytes_diff",
    "fmt_count_diff",
    "fmt_signed_count",
    "fmt_signed_gb",
    "is_blank",
    "is_ok",
    "normalize_iso_text",
    "normalize_iso_time",
    "object_total",
    "open_uri",
    "seal_uri",
    "strip_breaks",
    "strip_quotes",
    "to_gb",
    "uri_host_port",
]
