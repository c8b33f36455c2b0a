"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Vectors of unit length at cosine c lie sqrt(2 - 2 c) apart. A hash is a random projection, shifted and quantised; a table
files a vector under several hashes at once; close vectors share a bucket in at least one of several tables. The number of
hashes follows from the number of vectors and that of tables from the recall wanted at the threshold.
Buckets are compared in blocks. A pair is counted in the first table that both share, so counts need no list of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.llm.components import connected
from waterline.llm.store import materialize

COSINE = 0.95
RECALL = 0.97
WIDTH = 2.0
#: Unrelated vectors that share a bucket, on average.
STRANGERS = 0.1
#: Vectors of a block; larger buckets are compared block by block.
BLOCK = 2_048


def collision(distance: float, width: float) -> float:
    """Chance that one p-stable hash of the width puts two points at the distance together (Datar et al. 2004)."""
    r = width / distance
    tail = math.erfc(r / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(vectors: int, cosine: float = COSINE, recall: float = RECALL, width: float = WIDTH) -> tuple[int, int]:
    """Hashes per table, and tables."""
    near = collision(max(1e-6, math.sqrt(2 - 2 * cosine)), width)
    far = collision(math.sqrt(2), width)
    hashes = max(1, math.ceil(math.log(max(2, vectors) / STRANGERS) / -math.log(far)))
    return hashes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near**hashes)))


def unit_vectors(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension, as unit vectors in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def signatures(x: np.ndarray, hashes: int, tables: int, width: float, seed: int) -> np.ndarray:
    """The bucket of every vector in every table, as 64-bit numbers."""
    dim = x.shape[1]
    rng = np.random.default_rng([seed, dim])
    found = np.empty((len(x), tables), "u8")
    for t in range(tables):
        a, b = rng.standard_normal((dim, hashes)), rng.random(hashes) * width
        mix = rng.integers(0, 1 << 63, hashes, dtype="u8") * np.uint64(2) + np.uint64(1)
        steps = np.floor((x @ a + b) / width).astype("i8").view("u8")
        found[:, t] = (steps * mix).sum(axis=1, dtype="u8") ^ np.uint64(dim)
    return found.view("i8")


def _usable(vector) -> F.Column:
    """Not null or empty, no null or non-finite component, not zero."""
    odd = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda v: v != 0), F.lit(False))


def _sign(classes: DataFrame, hashes: int, tables: int, width: float, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch.column(1)).to_numpy()
            for dim in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dim))
                s = signatures(unit_vectors(part.column(1)), hashes, tables, width, seed)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, s.size + 1, tables, dtype="i4")), pa.array(s.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), flat], names=["rep", "sig"])

    return classes.select("rep", "vector").mapInArrow(run, "rep bigint, sig array<bigint>")


def _compare_block(rows: pa.Table, cosine: float) -> pa.RecordBatch:
    """Links within one block of a bucket (columns as in _block_rows). Counts go out as rows (a, null, links), the
    links of a spanning forest as rows (a, b, 0)."""
    rep, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
    table, left = rows.column("table")[0].as_py(), rows.column("left")[0].as_py()
    side, right = rows.column("side").to_numpy(), rows.column("right")[0].as_py()
    vectors = rows.column("vector").combine_chunks()
    if len(pc.unique(pc.list_value_length(vectors))) > 1:  # a clash of two dimensions' bucket numbers
        return _links([], [], [])
    x = unit_vectors(vectors)
    sig = rows.column("sig").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)[:, :table]
    first, second = np.flatnonzero(side == left), np.flatnonzero(side == right)
    links, a, b = np.zeros(len(rep), "i8"), [], []
    tree = np.arange(len(rep))
    for i in first:
        others = second[second > i] if left == right else second
        others = others[x[others] @ x[i] >= cosine]
        if not len(others):
            continue
        # Counted in the first table that both share; linked in any.
        fresh = others[~(sig[others] == sig[i]).any(axis=1)]
        links[i] += copies[fresh].sum()
        links[fresh] += copies[i]
        others = others[tree[others] != tree[i]]
        trees, at = np.unique(tree[others], return_index=True)
        a += [int(rep[i])] * len(at)
        b += rep[others[at]].tolist()
        tree[np.isin(tree, trees)] = tree[i]
    counted = np.flatnonzero(links)
    none = [None] * len(counted)
    return _links([*rep[counted].tolist(), *a], [*none, *b], [*links[counted].tolist(), *([0] * len(a))])


def _links(a: list, b: list, n: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b, n)], names=["a", "b", "n"])


_BLOCK_KEY = ["table", "bucket", "left", "right"]


def _compare(blocks: DataFrame, cosine: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if end == start:
                    continue
                now = tuple(keys[start])
                if now != key and held:
                    yield _compare_block(pa.Table.from_batches(held), cosine)
                    held = []
                key = now
                held.append(batch.slice(start, end - start))
        if held:
            yield _compare_block(pa.Table.from_batches(held), cosine)

    return blocks.mapInArrow(run, "a bigint, b bigint, n bigint")


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    recall: float = RECALL,
    width: float = WIDTH,
    seed: int = 7,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    Vectors link at a cosine, in double precision, of at least `cosine`; a pair at that cosine is found with probability
    `recall`, closer pairs more surely, equal vectors always. n_links: other rows linked directly. component_id:
    smallest vec_id that links reach. kept: it is the row's own. Vectors that are null, empty, zero or hold a null or
    non-finite component, and rows without vec_id, link with nothing. Vectors of different dimension don't link. A
    vec_id that comes twice counts twice. Other columns are ignored. An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.withColumn("usable", F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    usable = rows.where("usable")
    # Equal vectors are one class; its links are those of each.
    classes = usable.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = materialize(classes, "vector-classes")
    hashes, tables = plan_tables(classes.count(), cosine, recall, width)
    signed = materialize(_sign(classes, hashes, tables, width, seed), "signatures")
    filed = signed.select("rep", F.posexplode("sig").alias("table", "bucket"))
    shared = filed.groupBy("table", "bucket").count().where("count > 1")
    members = filed.join(shared, ["table", "bucket"])
    parts = F.ceil(F.col("count") / block).cast("int")
    members = members.withColumn("parts", parts).withColumn("side", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    wide = members.join(signed, "rep").join(classes, "rep")
    blocks = wide.select(
        "table",
        "bucket",
        F.least("side", "other").alias("left"),
        F.greatest("side", "other").alias("right"),
        "side",
        "rep",
        "copies",
        "vector",
        "sig",
    )
    blocks = blocks.repartition(*_BLOCK_KEY).sortWithinPartitions(*_BLOCK_KEY)
    found = materialize(_compare(blocks, cosine), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("near"))
    nodes = connected(found.where("b is not null").select("a", "b"))
    nodes = nodes.select(F.col("node").alias("rep"), "component")
    facts = classes.select("rep", "copies", "vector").join(counts, "rep", "left").join(nodes, "rep", "left")
    facts = facts.select(
        "vector",
        (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    # One class may hold a third of all rows: both sides are salted.
    salts = 16
    facts = facts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    linked = usable.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int")).join(facts, ["vector", "salt"])
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "n_links", "component_id").union(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
