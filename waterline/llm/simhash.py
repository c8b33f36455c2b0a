"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

A fingerprint has two segments of 32 bits. Two fingerprints at 4 or fewer differing bits agree up to 2 bits in one of
them, so some segment value is within one bit of both: each fingerprint enters a table under every value within
one bit of its segment, and meets there whatever it can link to. Complete distances are then verified.

A table entry (a bucket) that holds very many fingerprints is dealt out anew, under values near the quarters of the
other segment as well, until buckets are bounded by what the bits allow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.llm.components import connected
from waterline.llm.store import materialize

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
#: Fingerprints of a bucket that one task compares; larger buckets are dealt out anew.
BUCKET = 8_192
#: Fingerprints that a task files under all their keys.
FILED = 16_384
#: Up to this many, a bucket's members are compared by offsets, many buckets at a time.
SMALL_BUCKET = 24

_WORD = rb"[^\x20\x09-\x0D]+"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is one if it is set in over half the hashes of the text's shingles, repeats included.

    Null, empty and wordless texts have fingerprint 0. A text of fewer words is one shingle.
    """
    import re

    from xxhash import xxh64_intdigest

    found = re.findall(_WORD, text.encode().translate(_FOLD)) if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), "i8", len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype="i8")
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, row, fp) of (doc_id, text): a hash of both, and the fingerprint as a signed 64-bit number; a row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            values = np.fromiter((fingerprint(x.as_py(), words) for x in column), "u8", len(column))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values.view("i8"))], names=["doc_id", "row", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), _row_hash().alias("row"))
    return rows.mapInArrow(run, "doc_id bigint, row bigint, fp bigint")


def _row_hash() -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _bits(segment: str, width: int) -> Column:
    """The low `width` bits of what is left after the shift that the segment names, as a bigint."""
    return F.expr(f"shiftrightunsigned(fp, {segment}) & {(1 << width) - 1}L")


def _near(value: Column, width: int, most: int) -> Column:
    """All values within `most` bits of a segment's value."""
    flips = [0] + [1 << i for i in range(width)]
    if most > 1:
        flips += [1 << i | 1 << j for i in range(width) for j in range(i)]
    return F.transform(F.lit(flips), lambda x: value.bitwiseXOR(x.cast("bigint")))


def _bucket_keys(level: int) -> Column:
    """Values that a fingerprint is filed under, as (table, value) pairs of the level's segments.

    Level 0: either half. Level 1, within a half: either quarter of the other half. Level 2: the quarter that is left,
    within 2 bits, as 4 differing bits may all lie there.
    """
    if level == 0:
        tables, width, most = [(0, 0), (1, 32)], 32, 1
    elif level == 1:
        other = "case when __table = 0 then {a} else {b} end"
        tables, width, most = [(0, other.format(a=32, b=0)), (1, other.format(a=48, b=16))], 16, 1
    else:
        # __table is 2 * half + quarter by now.
        left = "case __table when 0 then 48 when 1 then 32 when 2 then 16 else 0 end"
        tables, width, most = [(0, left)], 16, 2
    filed = []
    for number, shift in tables:
        values = _near(_bits(str(shift), width), width, most)
        filed.append(F.transform(values, lambda v: F.struct(F.lit(number).alias("t"), v.alias("v"))))  # noqa: B023
    return F.concat(*filed)


def _file(rows: DataFrame, level: int) -> DataFrame:
    """Rows (fp, __table, __key) under the keys of a level. The key of a later level extends the earlier key."""
    named = rows.withColumn("__entry", F.explode(_bucket_keys(level)))
    table = F.col("__entry.t") if level == 0 else F.col("__table") * 2 + F.col("__entry.t")
    key = F.col("__entry.v") if level == 0 else F.xxhash64("__table", "__key", "__entry.t", "__entry.v")
    # A key that is a hash may join buckets that have nothing in common: more to compare, none to lose.
    return named.select("fp", table.cast("int").alias("__table_new"), key.alias("__key")).withColumnRenamed(
        "__table_new", "__table"
    )


def _spanning(run: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links between distinct fingerprints of one bucket that connect all it can connect; at most one per member."""
    left = run.view("u8").copy()
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= MOST_BITS
            if near.any():
                for y in left[near]:
                    front.append(y)
                    yield int(np.int64(x)) if x < 1 << 63 else int(x) - (1 << 64), int(y) if y < 1 << 63 else int(y) - (1 << 64)
                left = left[~near]


def _compare(table: pa.Table) -> pa.RecordBatch:
    """Links in rows (__table, __key, fp) that are sorted and hold whole buckets."""
    t, k = table.column(0).to_numpy(), table.column(1).to_numpy()
    fp = table.column(2).to_numpy()
    new = np.ones(len(fp), bool)
    new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(fp)))
    bucket = np.repeat(np.arange(len(start)), size)
    small = size[bucket] <= SMALL_BUCKET
    a, b = [], []
    for d in range(1, int(size[size <= SMALL_BUCKET].max(initial=1))):
        i = np.flatnonzero(small[:-d] & (bucket[:-d] == bucket[d:]))
        i = i[np.bitwise_count(fp[i].view("u8") ^ fp[i + d].view("u8")) <= MOST_BITS]
        a.append(fp[i])
        b.append(fp[i + d])
    large = [pair for s in np.flatnonzero(size > SMALL_BUCKET) for pair in _spanning(fp[start[s] : start[s] + size[s]])]
    if large:
        x = np.array(large, dtype="i8")
        a.append(x[:, 0])
        b.append(x[:, 1])
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0) if a else np.empty((0, 2), "i8")
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _links_in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts a sorted stream of rows (__table, __key, fp) between buckets and compares within them.

    Holds a batch and one bucket, which the caller bounds.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = (batch.column(0)[-1], batch.column(1)[-1])
        same = pc.and_(pc.equal(batch.column(0), last[0]), pc.equal(batch.column(1), last[1]))
        n = batch.num_rows - pc.sum(same).as_py()
        if n or held and (held[-1].column(0)[-1], held[-1].column(1)[-1]) != last:
            yield _compare(pa.Table.from_batches([*held, batch.slice(0, n)]))
            held = []
        held.append(batch.slice(n))
    if held:
        yield _compare(pa.Table.from_batches(held))


def fingerprint_links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect whatever 4 or fewer differing bits connect.

    fps: distinct `fp`. Small buckets give every link, large ones a spanning forest of theirs.
    """
    # Every fingerprint is filed under 66 keys, so they are dealt out before, a bounded number to a task.
    parts = max(1, -(-fps.count() // FILED))
    filed = _file(fps.select("fp").repartition(parts, "fp"), 0)
    found = []
    for level in range(3):
        ready, crowded = filed, None
        if level < 2:
            heavy = materialize(
                filed.groupBy("__table", "__key").count().where(F.col("count") > bucket).drop("count"), "crowded"
            )
            if heavy.limit(1).count():
                ready = filed.join(heavy, ["__table", "__key"], "left_anti")
                crowded = filed.join(heavy, ["__table", "__key"], "left_semi")
        rows = ready.select("__table", "__key", "fp").repartition("__table", "__key")
        if level:  # the same fingerprint may come to a bucket in more than one way
            rows = rows.distinct().repartition("__table", "__key")
        found.append(rows.sortWithinPartitions("__table", "__key").mapInArrow(_links_in_buckets, "a bigint, b bigint"))
        if crowded is None:
            break
        filed = _file(crowded, level + 1)
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of (doc_id, text).

    fingerprint: 16 lowercase hex digits. component_id: the smallest doc_id that links of 4 or fewer differing bits
    reach, itself included; equal fingerprints link, that of wordless and null texts too. Rows with a null doc_id take
    part in the links and are never a smallest one; if a component has no other, its id is null. Repeated rows
    stay. Other columns are ignored. An empty table gives no rows.
    """
    rows = materialize(with_fingerprint(docs, words), "fingerprints")
    return _attach(rows, _classes(rows, bucket)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _classes(rows: DataFrame, bucket: int) -> DataFrame:
    """(fp, component, component_id) for every fingerprint of rows (doc_id, fp): its least fingerprint and doc_id."""
    reps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    nodes = connected(fingerprint_links(reps, bucket))
    # The links of fingerprints, then the smallest doc_id of each component of fingerprints.
    member = reps.join(nodes, reps["fp"] == nodes["node"], "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component")
    )
    smallest = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    return materialize(member.join(smallest, "component").select("fp", "component", "component_id"), "classes")


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, bucket: int = BUCKET) -> DataFrame:
    """One row of docs (doc_id, text, ...) for each component: that of the smallest doc_id (nulls last), then of the smallest
    hash of doc_id and text. Of rows that agree in both, any one. Otherwise as near_duplicates.
    """
    rows = materialize(with_fingerprint(docs, words), "fingerprints")
    member = _attach(rows, _classes(rows, bucket))
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    first = member.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.row").alias("__row"))
    kept = docs.withColumn("__row", _row_hash()).join(first, "__row", "left_semi")
    return kept.dropDuplicates(["__row"]).select(*docs.columns)


def _attach(rows: DataFrame, classes: DataFrame, salts: int = 32) -> DataFrame:
    """Rows with the class of their fingerprint. A fingerprint may hold a third of all rows, so both sides are salted.

    Spark sizes the copies as the one stored table they come from, and would send all of them to the driver and each
    executor: the hint keeps to a shuffle.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    copies = classes.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), ["fp", "__salt"]).drop("__salt")


def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
