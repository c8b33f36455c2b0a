"""Token ids in a file format for short documents: one frame per document, a shared zstandard dictionary.

A store is two Parquet tables below one path. `dictionary` has the dictionary and its SHA-256. `blocks` has, per block of a
few MB, the frames of consecutive documents in one binary value, an index of where each frame starts, the documents'
ids and lengths, the smallest and largest id, and the dictionary's hash. Reading one document reads the blocks whose
range holds its id, and decompresses that frame alone. Spark's committer publishes the files, so a lost executor leaves
no half of one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.llm.store import shared_path
from waterline.llm.tokens import CACHE_BYTES, END_BYTES, ChunkEncoder, batched

DICTIONARY_BYTES = 64 * 1024
#: The dictionary is trained on so many documents of at most so many characters, chosen by a hash of the id.
TRAIN_DOCS = 1_000
TRAIN_CHARS = 8_000
LEVEL = 3
BLOCK_BYTES = 2_000_000
BLOCK_DOCS = 4_096

BLOCKS = (
    "shard int, block int, first_token bigint, smallest bigint, largest bigint, dictionary string, "
    "doc_ids array<bigint>, lengths array<bigint>, starts array<bigint>, frames binary"
)


def train_dictionary(docs: DataFrame, tokenizer: str, docs_used: int = TRAIN_DOCS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of serialized ids. With too few documents to train on, their ids themselves."""
    short = docs.where(F.char_length("text").between(1, TRAIN_CHARS)).select("doc_id", "text")
    hashed = short.withColumn("__hash", F.xxhash64("doc_id", "text"))
    # About twice the documents wanted have a hash this small, whatever the number of tasks that send some.
    share = min(1.0, 2 * docs_used / max(1, short.count()))
    few = hashed.where(F.col("__hash") <= int(share * (2**64 - 1)) - 2**63 if share < 1 else F.lit(True))
    sample = few.orderBy("__hash", "doc_id").limit(docs_used).collect()
    encoder = ChunkEncoder(tokenizer, keep_space=False, cache_bytes=2 * CACHE_BYTES)
    samples = [x + END_BYTES for x in encoder.encode([r["text"] for r in sample])]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:].ljust(8, b"\0")


def _ids_writer(tokenizer: str, dictionary: bytes, digest: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer, keep_space=False, cache_bytes=2 * CACHE_BYTES)
        packed = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        shard, block, tokens = TaskContext.get().partitionId(), 0, 0
        keys, lengths, frames, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal block, tokens, keys, lengths, frames, size
            named = [k for k in keys if k is not None]
            starts = np.concatenate([[0], np.cumsum([len(x) for x in frames])]).tolist()
            row = {
                "shard": shard,
                "block": block,
                "first_token": tokens,
                "smallest": min(named, default=None),
                "largest": max(named, default=None),
                "dictionary": digest,
                "doc_ids": keys,
                "lengths": lengths,
                "starts": starts,
                "frames": b"".join(frames),
            }
            block, tokens = block + 1, tokens + sum(lengths)
            keys, lengths, frames, size = [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in batched(texts):
                for key, raw in zip(ids[part], encoder.encode(texts[part])):
                    raw += END_BYTES
                    keys.append(key)
                    lengths.append(len(raw) // 4)
                    frames.append(packed.compress(raw))
                    size += len(frames[-1])
                    if size >= BLOCK_BYTES or len(keys) >= BLOCK_DOCS:
                        yield close()
        if keys:
            yield close()

    return run


_LONGS = pa.list_(pa.int64())
_BLOCK_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first_token", pa.int64()),
        ("smallest", pa.int64()),
        ("largest", pa.int64()),
        ("dictionary", pa.string()),
        ("doc_ids", _LONGS),
        ("lengths", _LONGS),
        ("starts", _LONGS),
        ("frames", pa.binary()),
    ]
)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def write_store(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode every whole text of (doc_id, text), an end id after each, and write a store in ascending doc_id order.

    A null or empty text has the end id only. Null ids come first; rows with one id are ordered by a hash of their text.
    Repeated rows stay. Other columns are ignored. An empty table gives a store without blocks. tokenizer: path of the
    vocabulary, the same on every executor.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    dictionary = train_dictionary(rows, tokenizer)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, dictionary)], "hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    order = ["doc_id", "__tie"]
    dealt = rows.withColumn("__tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = dealt.select("doc_id", "text").mapInArrow(_ids_writer(tokenizer, dictionary, digest), BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _open_store(spark: SparkSession, path: str) -> tuple[DataFrame, bytes, str]:
    stored = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(stored["dictionary"]).hexdigest() != stored["hash"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks"), bytes(stored["dictionary"]), stored["hash"]


def _decode(dictionary: bytes, digest: str, wanted: frozenset | None):
    """Documents of blocks: doc_id, shard, start in the shard, ids. wanted: ids of documents, or null for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for row in range(batch.num_rows):
                b = {n: batch.column(n)[row].as_py() for n in ("shard", "first_token", "dictionary", "doc_ids", "lengths", "starts")}
                if b["dictionary"] != digest:
                    raise ValueError("a block was written with another dictionary")
                frames = memoryview(batch.column("frames")[row].as_buffer())
                before = b["first_token"] + np.concatenate([[0], np.cumsum(b["lengths"])])
                out = []
                for i, key in enumerate(b["doc_ids"]):
                    if wanted is None or key in wanted:
                        ids = plain.decompress(frames[b["starts"][i] : b["starts"][i + 1]])
                        out.append((key, b["shard"], int(before[i]), ids))
                columns = list(zip(*out)) or [()] * 4
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "shard", "start", "ids"])

    return run


_DECODED = "doc_id bigint, shard int, start bigint, ids binary"


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of a store; start counts the ids of all documents before it."""
    blocks, dictionary, digest = _open_store(spark, path)
    ends = blocks.select("shard", (F.col("first_token") + F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("end"))
    # One number for each task that wrote.
    base, before = [], 0
    for r in ends.groupBy("shard").agg(F.max("end").alias("end")).orderBy("shard").collect():
        base.append((r["shard"], before))
        before += r["end"]
    bases = spark.createDataFrame(base, "shard int, base bigint")
    decoded = blocks.mapInArrow(_decode(dictionary, digest, None), _DECODED)
    joined = decoded.join(F.broadcast(bases), "shard")
    return joined.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "ids")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: only blocks whose range holds one are read, only their frames decompressed."""
    blocks, dictionary, digest = _open_store(spark, path)
    near = F.lit(False)
    for d in doc_ids:
        near = near | F.lit(d).between(F.col("smallest"), F.col("largest"))
    return blocks.where(near).mapInArrow(_decode(dictionary, digest, frozenset(doc_ids)), _DECODED).select("doc_id", "ids")



def op10_zstd_dictionary_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_path(spark, "id-store")
    write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    docs = read_store(spark, path)
    return docs.select("doc_id", "start", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
