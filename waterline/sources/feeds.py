"""Inputs of a collection run: catalog statistics, collector text and asset records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.functions import is_blank, normalize_iso_time
from waterline.model import ASSET_RECORDS, TABLE_STATS


def read_table_stats(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Catalog rows of all relational instances, landed as files."""
    return spark.read.schema(TABLE_STATS).format(format).load(path)


_WRAPPERS = ("$numberLong", "$numberInt", "$numberDouble")


def _read(entry: str, field: str, kind: str) -> Column:
    """A field of a VARIANT, plain or wrapped ({"$numberLong": "99"}); NULL where it is not of the kind."""
    paths = [f"$.{field}", *[f"$.{field}['{w}']" for w in _WRAPPERS]]
    return F.coalesce(*[F.try_variant_get(F.col(entry), path, kind) for path in paths])


def flag(entry: str, field: str = "ok") -> Column:
    """A success flag of a statistics document as a double, whatever its form: 1, 1.0, true or {"$numberDouble": "1.0"}."""
    return _read(entry, field, "double")


def whole_number(entry: str, field: str) -> Column:
    """A number of a statistics document as a bigint, whatever its form: 1024, 1024.0, 2.5e9, "99" or {"$numberLong": "99"}.

    A fraction is cut off. NULL where the field is no number or no 64-bit one.
    """
    plain, given = [F.try_variant_get(F.col(entry), f"$.{field}", kind) for kind in ("bigint", "string")]
    other = F.coalesce(_read(entry, field, "bigint"), _read(entry, field, "double").try_cast("bigint"))
    # A field that is not there is not looked for in other forms.
    return F.coalesce(plain, F.when(given.isNotNull(), other))


def _with_numbers(entries: DataFrame, entry: str, fields: dict[str, str]) -> DataFrame:
    """Statistics entries with `ok` and their numbers. One that holds something else than numbers is not ok."""
    numbers = {name: whole_number(entry, field) for name, field in fields.items()}
    bad = F.lit(False)
    for name, field in fields.items():
        given = F.try_variant_get(F.col(entry), f"$.{field}", "string")
        bad = bad | (F.col(name).isNull() & given.isNotNull())
    ok = F.when(bad, F.lit(0.0)).otherwise(flag(entry))
    # Two steps, so that each number is read once.
    return entries.withColumns(numbers).withColumn("ok", ok)


_DB_NUMBERS = {"data_size": "dataSize", "index_size": "indexSize", "storage_size": "storageSize"}
_COLL_NUMBERS = {
    "count": "count",
    "size": "size",
    "total_index_size": "totalIndexSize",
    "storage_size": "storageSize",
}


def _parsed(documents: DataFrame, document: str, numbers: dict[str, str]) -> DataFrame:
    """Each document as a VARIANT `v`, parsed once; NULL where the text is no JSON.

    A boolean would read as 0 or 1, so one in place of a number becomes a text, which is none. Inside a JSON text quotes
    are escaped, so a quoted name before a colon is a field's.
    """
    text, names = F.col(document), "|".join(numbers.values())
    told = F.regexp_replace(text, rf'"({names})"(\s*:\s*)(true|false)\b', '"$1"$2"$3"')
    text = F.when(text.contains("true") | text.contains("false"), told).otherwise(text)
    # Unpacked by a generator: a column used by several expressions would be parsed for each of them.
    return documents.select("instance_id", F.explode(F.array(F.try_parse_json(text))).alias("v"))


def _entries(entry: str, field: str) -> Column:
    """The members of a list; NULL where the field is no list."""
    return F.try_variant_get(F.col(entry), f"$.{field}", "array<variant>")


def read_db_stats(documents: DataFrame, document: str = "document") -> DataFrame:
    """Database statistics from (instance_id, JSON text) rows, one row per listed database.

    A document without databases still gives one row, so that its instance is known.
    """
    entries = _parsed(documents, document, _DB_NUMBERS).select(
        "instance_id",
        flag("v").alias("list_ok"),
        F.try_variant_get("v", "$.version", "string").alias("version"),
        F.explode_outer(_entries("v", "databases")).alias("s"),
    )
    name = F.try_variant_get("s", "$.name", "string").alias("db_name")
    return _with_numbers(entries, "s", _DB_NUMBERS).select("instance_id", "list_ok", "version", name, "ok", *_DB_NUMBERS)


def read_coll_stats(documents: DataFrame, document: str = "document") -> DataFrame:
    """Collection statistics from (instance_id, JSON text) rows, one row per collection.

    Documents whose database list was not readable give no rows.
    """
    databases = _parsed(documents, document, _COLL_NUMBERS).where(flag("v") == 1)
    databases = databases.select("instance_id", F.explode(_entries("v", "databases")).alias("d"))
    entries = databases.select(
        "instance_id",
        F.try_variant_get("d", "$.name", "string").alias("db_name"),
        F.explode(_entries("d", "collections")).alias("c"),
    )
    name = F.try_variant_get("c", "$.name", "string").alias("coll_name")
    return _with_numbers(entries, "c", _COLL_NUMBERS).select("instance_id", "db_name", name, "ok", *_COLL_NUMBERS)


def read_collector_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headerless tab-separated collector output; the word NULL is a missing value."""
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("quote", "")
        .option("escape", "")
        .option("nullValue", "NULL")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


# Collector output is a few lines an instance; a file is read in one piece up to this size.
MAX_OUTPUT_BYTES = 64 * 1024**2


def pack_output(files: DataFrame, path: str) -> None:
    """Land collector output of very many instances packed: a row (file, text) for each, in Parquet files of ordinary size."""
    files.select(F.col("file").cast("string"), F.col("text").cast("string")).write.parquet(path)


def read_output_lines(
    spark: SparkSession,
    path: str,
    instance: str = r"instance_id=(\d+)/",
    max_bytes: int = MAX_OUTPUT_BYTES,
    packed: bool = False,
) -> DataFrame:
    """Lines of collector output files with their number in the file, from 1, whatever the splits of the scan.

    `instance` is a regular expression whose first group is the instance id in a file's path; a file without one gives
    NULL. An instance with several files has each of their numbers: `file` tells them apart. Lines end with LF or CR LF;
    an empty file has none. Files are read whole, so one of more than max_bytes fails the job.
    A folder of one small file for each of very many instances takes longer to list and open than to read: `packed` reads
    the files as pack_output lands them, by the same rules.
    """
    if packed:
        whole = spark.read.schema("file string, text string").parquet(path)
        size, file, value = F.octet_length("text"), F.col("file"), F.col("text")
    else:
        whole = spark.read.schema("value string").text(path, wholetext=True, recursiveFileLookup=True)
        size, file, value = F.col("_metadata.file_size"), F.col("_metadata.file_path"), F.col("value")
    too_large = F.raise_error(F.concat(F.lit("collector output too large to number its lines: "), file))
    files = whole.select(file.alias("file"), F.when(size <= max_bytes, value).otherwise(too_large).alias("text"))
    # The end of the last line opens no further one.
    text = F.regexp_replace("text", r"\r?\n\z", "")
    lines = files.where(F.col("text") != "").select("file", F.posexplode(F.split(text, r"\r?\n")))
    found = F.regexp_extract("file", instance, 1).try_cast("bigint")
    return lines.select(
        "file", found.alias("instance_id"), (F.col("pos") + 1).cast("bigint").alias("line_no"), F.col("col").alias("line")
    )


_SUMMARY_FIELDS = (
    "logical_data_bytes",
    "logical_index_bytes",
    "logical_total_bytes",
    "physical_total_bytes",
)


def pick_summary_line(
    lines: DataFrame, line_no: str = "line_no", line: str = "line"
) -> DataFrame:
    """The summary in noisy collector output: the last line of six fields or more per instance.

    Gives its fields and whether all required ones are present; instances whose output has no
    such line are absent.
    """
    enough = F.size(F.split(line, "\t")) >= 6
    last = lines.where(enough).groupBy("instance_id").agg(F.max_by(line, line_no).alias("_line"))
    field = F.split("_line", "\t")
    picked = last.select(
        "instance_id",
        field[0].alias("_time"),
        *[field[i].alias(name) for i, name in enumerate(_SUMMARY_FIELDS, start=1)],
        field[5].alias("version"),
    )
    complete = ~is_blank(F.col("_time"))
    for name in _SUMMARY_FIELDS:
        complete = complete & ~is_blank(F.col(name))
    return picked.select(
        "instance_id",
        F.when(complete, normalize_iso_time(F.col("_time"))).alias("stat_time"),
        *[F.col(name).try_cast("bigint").alias(name) for name in _SUMMARY_FIELDS],
        "version",
        complete.alias("complete"),
    )


def read_asset_records(
    spark: SparkSession, path: str, kind: str, format: str = "json"
) -> DataFrame:
    """Asset import records as JSON lines or CSV with a header.

    line_no orders repeated records. Those without one are rejected by validate_assets: their place would depend on
    how the files are split.
    """
    schema = ASSET_RECORDS[kind]
    reader = spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    return reader.format(format).option("header", True).load(path)
