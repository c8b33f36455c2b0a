"""Clean-up of text fields that arrive from collectors and import files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def blank_to_null(c: Column) -> Column:
    """Text without surrounding blanks, NULL if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def normalize_iso_text(c: Column) -> Column:
    """'2026-01-02T03:04:05.678Z' to '2026-01-02 03:04:05'; other text passes unchanged."""
    plain = F.regexp_replace(c, "^([^T]*)T", "$1 ")
    plain = F.regexp_replace(plain, r"(?s)\..*$", "")
    plain = F.regexp_replace(plain, "Z$", "")
    return F.when(F.contains(c, F.lit("T")), plain).otherwise(c)


def normalize_iso_time(c: Column) -> Column:
    """Same as a timestamp; text that is no time gives NULL."""
    return normalize_iso_text(c).try_cast("timestamp_ntz")


def strip_breaks(c: Column) -> Column:
    return F.regexp_replace(c, r"[\r\n]", "")


def strip_quotes(c: Column) -> Column:
    """Drop one pair of matching quotes around the text."""
    return F.regexp_replace(c, r"""(?s)^(["'])(.*)\1$""", "$2")


# Scheme and credentials of a URI. The credentials end at the first @ and are never given back.
_URI_START = r"^mongodb(?:\+srv)?://(?:[^@]*@)?+"


def uri_host_port(uri: Column) -> tuple[Column, Column]:
    """Host and port of the first member of a document-database URI.

    Host is '' for any other scheme. Port is 0 when the URI names none and NULL when it is not a
    number. Each is one pattern over the URI, so the columns stay small in filters and joins.
    """
    host = F.regexp_extract(uri, _URI_START + r"([^:/?,]*)", 1)
    port = F.regexp_extract(uri, _URI_START + r"[^/?,]*:([^:/?,]*)", 1)
    return host, F.coalesce(F.nullif(port, F.lit("")), F.lit("0")).try_cast("int")


_IV_BYTES = 16


def seal_uri(uri: Column, key_hex: str, iv_hex: str) -> Column:
    """Base64 AES-256-CBC ciphertext of a connection URI, as stored in login_path."""
    sealed = F.aes_encrypt(
        uri.cast("binary"),
        F.unhex(F.lit(key_hex)),
        F.lit("CBC"),
        F.lit("PKCS"),
        F.unhex(F.lit(iv_hex)),
    )
    # Spark puts the IV in front of the ciphertext; the stored form is the ciphertext alone.
    return F.base64(F.substring(sealed, _IV_BYTES + 1, 1 << 30))


def open_uri(sealed: Column, key_hex: str, iv_hex: str) -> Column:
    """Inverse of seal_uri; NULL when the text cannot be decrypted."""
    cleaned = F.regexp_replace(sealed, r"[\r\n\t ]", "")
    body = F.concat(F.unhex(F.lit(iv_hex)), F.try_to_binary(cleaned, F.lit("base64")))
    plain = F.try_aes_decrypt(body, F.unhex(F.lit(key_hex)), F.lit("CBC"), F.lit("PKCS"))
    return F.nullif(plain.cast("string"), F.lit(""))
