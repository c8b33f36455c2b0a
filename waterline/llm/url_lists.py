"""URL filter by dated lists: an as-of join of captures with the entries active when they were fetched.

Dated entries of a key become validity intervals, each up to the key's next entry. A capture is looked up under its host,
its parent domains and its path prefixes by an equality join on key and span of time; the interval is checked after that.
The longest listed key decides; between lists of the same key, allowing beats blocking. Hosts compare in lower case, paths as written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waterline.llm.store import materialize

#: Days of a span. An interval is filed under each span it touches up to the last capture.
SPAN_DAYS = 64
MOST_BROADCAST = 200_000
#: Different numbers of labels or path segments in the lists.
MOST_SHAPES = 10_000
SALTS = 16


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if the text is no URL with a host."""
    host = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def entry_key(key: Column) -> Column:
    """A listed key: host in lower case, without slashes at the end. Paths keep their case."""
    key = F.regexp_replace(F.trim(key), "/+$", "")
    host = F.substring_index(key, "/", 1)
    return F.concat(F.lower(host), F.substring(key, F.char_length(host) + 1, F.char_length(key)))


def keys_of(url: Column, labels: list[int], segments: list[int]) -> Column:
    """Keys an entry may name: the host and parent domains of so many labels, and the host with so many path segments.

    Only numbers that occur in a list are worth looking up; all prefixes of a long path would take its length squared.
    """
    host = host_of(url)
    label = F.split(host, r"\.")
    path = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    segment = F.filter(F.split(path, "/"), lambda s: s != "")

    def upto(numbers: list[int], most: Column) -> Column:
        return F.filter(F.array(*map(F.lit, numbers)).cast("array<int>"), lambda n: n <= most)

    domains = F.transform(upto(labels, F.size(label)), lambda n: F.array_join(F.slice(label, F.size(label) - n + 1, n), "."))
    prefixes = F.transform(
        upto(segments, F.size(segment)), lambda n: F.concat_ws("/", host, F.array_join(F.slice(segment, F.lit(1), n), "/"))
    )
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, prefixes)))


def _shapes(keys: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of labels of the hosts listed, and of path segments of the prefixes listed."""
    parts = F.size(F.split("key", "/")) - 1
    shape = F.when(parts == 0, F.size(F.split("key", r"\."))).otherwise(-parts)
    found = [r["shape"] for r in keys.select(shape.alias("shape")).distinct().limit(MOST_SHAPES + 1).collect()]
    if len(found) > MOST_SHAPES:
        raise ValueError(f"the lists hold keys of more than {MOST_SHAPES} different numbers of labels or segments")
    return sorted(n for n in found if n > 0), sorted(-n for n in found if n < 0)


def intervals(entries: DataFrame) -> DataFrame:
    """Validity of dated entries (list, action, key, entry_date, active): rows (list, action, key, valid_from, valid_to).

    An entry holds from its date until the key's next entry in the same list; the last one has no end (null). Of entries
    of one date an active one wins, and of those a blocking one. Entries without key or date, and states that
    are not active, give no interval. Actions are `allow` and `block`; anything else counts as `block`.
    """
    clean = entries.where("key is not null and entry_date is not null").select(
        F.coalesce("list", F.lit("")).alias("list"),
        entry_key(F.col("key")).alias("key"),
        F.col("entry_date").cast("date").alias("valid_from"),
        F.struct(
            F.coalesce(F.col("active"), F.lit(False)).alias("active"),
            F.when(F.lower("action") == "allow", "allow").otherwise("block").alias("action"),
        ).alias("state"),
    )
    # One row for each date of a key; "block" is the larger action.
    days = clean.groupBy("list", "key", "valid_from").agg(F.max("state").alias("state"))
    following = F.lead("valid_from").over(Window.partitionBy("list", "key").orderBy("valid_from"))
    return days.withColumn("valid_to", following).where("state.active").select(
        "list", F.col("state.action").alias("action"), "key", "valid_from", "valid_to"
    )


def _span(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01")) / SPAN_DAYS).cast("int")


def judge(captures: DataFrame, entries: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """All rows of captures (url, fetched, ...) with verdict, listed_key, listed_by, valid_from and valid_to.

    verdict: `allow` or `block` by the entry that decides, `none` without one, `no_url` where the URL has no host,
    `no_date` where the fetch time is null. Equally specific allowing entries: the first list by name. Repeated rows stay.
    Columns with the names of the results are replaced. Empty captures give no rows; empty lists give `none`.
    """
    results = ("verdict", "listed_key", "listed_by", "valid_from", "valid_to")
    captures = captures.drop(*results)
    asked = captures.select(F.col("url").alias("__url"), F.col("fetched").cast("date").alias("__day")).distinct()
    asked = asked.where("__url is not null and __day is not null")
    edge = captures.agg(F.min(F.col("fetched").cast("date")).alias("a"), F.max(F.col("fetched").cast("date")).alias("b")).first()
    valid = intervals(entries).withColumn("last", F.least(F.date_sub("valid_to", 1), F.lit(edge["b"]).cast("date")))
    valid = valid.withColumn("first", F.greatest("valid_from", F.lit(edge["a"]).cast("date"))).where("first <= last")
    filed = valid.withColumn("span", F.explode(F.sequence(_span(F.col("first")), _span(F.col("last")))))
    filed = materialize(filed.drop("first", "last"), "list-intervals")
    keys = keys_of(F.col("__url"), *_shapes(filed))
    looked_up = asked.withColumn("__key", F.explode(keys)).withColumn("__span", _span(F.col("__day")))
    at = (F.col("__key") == F.col("key")) & (F.col("__span") == F.col("span"))
    if filed.count() <= most_broadcast:
        filed = F.broadcast(filed)
    else:
        # A host may have a third of all captures: both sides are salted.
        filed = filed.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        looked_up = looked_up.withColumn("__salt", F.pmod(F.xxhash64("__url", "__day"), F.lit(SALTS)).cast("int"))
        at = at & (F.col("__salt") == F.col("__copy"))
    inside = (F.col("valid_from") <= F.col("__day")) & (F.col("valid_to").isNull() | (F.col("__day") < F.col("valid_to")))
    hits = looked_up.join(filed, at & inside)
    # The longest key, then allowing, then the first list by name.
    rank = F.struct(-F.char_length("key"), "action", "list", "key", "valid_from", "valid_to")
    decided = hits.groupBy("__url", "__day").agg(F.min(rank).alias("__entry"))
    joined = captures.join(
        decided, (F.col("url") == F.col("__url")) & (F.col("fetched").cast("date") == F.col("__day")), "left"
    )
    verdict = (
        F.when(host_of(F.col("url")).isNull(), "no_url")
        .when(F.col("fetched").isNull(), "no_date")
        .otherwise(F.coalesce("__entry.action", F.lit("none")))
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in captures.columns],
        verdict.alias("verdict"),
        F.col("__entry.key").alias("listed_key"),
        F.col("__entry.list").alias("listed_by"),
        F.col("__entry.valid_from").alias("valid_from"),
        F.col("__entry.valid_to").alias("valid_to"),
    )


def _number(name: Column, use: str) -> Column:
    """0 to 4095, from a hash of a name."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(use), name).cast("binary")), 1, 3), 16, 10).cast("int")


def _day(number: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), number)


def dated_lists(pages: DataFrame) -> DataFrame:
    """Dated entries on the hosts, domains and sections that occur in pages: when each was listed and taken off again is
    a hash of its name. A quarter of the keys is listed; every other one of those is listed again later."""
    host = host_of(F.col("url"))
    section = F.regexp_extract("url", r"://[^/?#]*/([^/?#]+)", 1)
    named = [
        ("hosts", "block", host),
        ("domains", "block", F.regexp_replace(host, r"^[^.]+\.", "")),
        ("sections", "allow", F.concat_ws("/", host, F.nullif(section, F.lit("")))),
    ]
    kinds = [F.struct(F.lit(x).alias("list"), F.lit(y).alias("action"), z.alias("key")) for x, y, z in named]
    keys = pages.select(F.inline(F.array(*kinds))).distinct()
    keys = keys.where("key is not null").where(_number(F.col("key"), "listed:") % 4 == 0)
    first = _number(F.col("key"), "first:") % 250
    gone = first + 30 + _number(F.col("key"), "gone:") % 60
    again = gone + 20 + _number(F.col("key"), "again:") % 60
    dates = [(first, True), (gone, False), (F.when(_number(F.col("key"), "back:") % 2 == 0, again), True)]
    states = F.array(*[F.struct(_day(d).alias("entry_date"), F.lit(x).alias("active")) for d, x in dates])
    return keys.select("list", "action", "key", F.inline(states)).where("entry_date is not null")


def op4_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages has no fetch time; a hash of the page_id gives one in 2024."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("fetched", _day(_number(F.col("page_id").cast("string"), "fetched:") % 366))
    return judge(captures, dated_lists(pages))


def _sql_number(name: str, use: str) -> str:
    return f"('0x' || substr(md5('{use}' || {name}), 1, 3))::INT"


OP4_SQL = rf"""
WITH captures AS (
    SELECT page_id, url, DATE '2024-01-01' + {_sql_number('page_id::VARCHAR', 'fetched:')} % 366 AS fetched,
           nullif(regexp_replace(lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', ''), '') AS host,
           list_filter(string_split(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda s: s <> '') AS segments
    FROM pages
), named AS (
    SELECT DISTINCT list, action, key FROM (
        SELECT 'hosts' AS list, 'block' AS action, host AS key FROM captures
        UNION ALL SELECT 'domains', 'block', regexp_replace(host, '^[^.]+\.', '') FROM captures
        UNION ALL SELECT 'sections', 'allow', concat_ws('/', host, nullif(regexp_extract(url, '://[^/?#]*/([^/?#]+)', 1), '')) FROM captures
    ) WHERE key IS NOT NULL AND {_sql_number('key', 'listed:')} % 4 = 0
), days AS (
    SELECT *, {_sql_number('key', 'first:')} % 250 AS first, 30 + {_sql_number('key', 'gone:')} % 60 AS held,
           20 + {_sql_number('key', 'again:')} % 60 AS pause, {_sql_number('key', 'back:')} % 2 = 0 AS back
    FROM named
), valid AS (
    SELECT list, action, rtrim(trim(key), '/') AS key, DATE '2024-01-01' + first AS valid_from, DATE '2024-01-01' + (first + held) AS valid_to FROM days
    UNION ALL
    SELECT list, action, rtrim(trim(key), '/'), DATE '2024-01-01' + (first + held + pause), NULL FROM days WHERE back
), hits AS (
    SELECT c.page_id, v.*, row_number() OVER (PARTITION BY c.page_id ORDER BY length(v.key) DESC, v.action, v.list, v.key, v.valid_from) AS place
    FROM (
        SELECT page_id, fetched, unnest(list_distinct(list_concat(
            list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
            list_transform(range(1, len(segments) + 1), lambda i: host || '/' || array_to_string(segments[1:i], '/'))))) AS key
        FROM captures WHERE host IS NOT NULL
    ) c JOIN valid v ON v.key = c.key AND v.valid_from <= c.fetched AND (v.valid_to IS NULL OR c.fetched < v.valid_to)
)
SELECT c.page_id, c.url, c.fetched, CASE WHEN c.host IS NULL THEN 'no_url' ELSE coalesce(h.action, 'none') END AS verdict,
       h.key AS listed_key, h.list AS listed_by, h.valid_from, h.valid_to
FROM captures c LEFT JOIN hits h ON h.page_id = c.page_id AND h.place = 1
"""
