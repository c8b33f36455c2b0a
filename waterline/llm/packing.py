"""Packing of documents into sequences of fixed capacity by Karmarkar-Karp multiway differencing.

Each task packs the documents of its own partition, in the order it reads them: no shuffle, and a hot source or
a long document is nothing special. Pieces of a whole sequence's length stand alone. What is left of each
document stays whole; a run of these that fills a number of windows forms a group, and differencing deals a group into
windows of nearly equal length. Their number rises while one exceeds the capacity and padding stays within a bound;
only what still exceeds is cut off and fills windows with room.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.llm.bpe import text_slices
from waterline.llm.tokens import CACHE_BYTES, END_BYTES, ChunkEncoder

SEQUENCE_TOKENS = 2048
#: Windows of a group, the share of them that a group leaves free for imbalance, and the share that may be padding.
GROUP_WINDOWS = 256
SLACK = 0.01
MOST_PADDING = 0.015
#: Bytes of text that are encoded at a time (one text at least).
BATCH_BYTES = 2_000_000
#: Sequence ids of a task start at its partition number times this.
SEQUENCES_PER_PARTITION = 1 << 36

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def difference(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: positions of sizes in so many subsets, their sums nearly equal.

    A partial partition is a list of (sum, members), largest first, without its empty subsets. The two with
    the largest spread are merged, large sums with small ones, until one is left.
    """
    # An entry: minus the spread, a number that breaks ties, the partial partition.
    heap = [(-n, i, [(n, [i])]) for i, n in enumerate(sizes)]
    heapq.heapify(heap)
    ticket = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        paired = len(a) + len(b) - ways
        if paired <= 0:
            merged = a + b
        else:
            # The subsets that find no empty partner meet smallest with largest.
            free = len(a) - paired
            tail, other = a[free:], b[len(b) - paired :]
            merged = a[:free] + b[: len(b) - paired]
            merged += [(x[0] + y[0], x[1] + y[1]) for x, y in zip(tail, reversed(other))]
        merged.sort(key=lambda x: -x[0])
        low = merged[-1][0] if len(merged) == ways else 0
        heapq.heappush(heap, (low - merged[0][0], ticket, merged))
        ticket += 1
    found = [members for _, members in heap[0][2]] if heap else []
    return found + [[] for _ in range(ways - len(found))]


def windows(sizes: list[int], capacity: int, most_padding: float = MOST_PADDING) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (position in sizes, start, length), none above the capacity.

    Differencing starts at the least possible number of windows, which rises whenever the capacity is exceeded, until more
    of all room than most_padding would be empty. The pieces that exceed it then are cut.
    """
    total = sum(sizes)
    ways = max(1, -(-total // capacity))
    most = max(ways, int(total / ((1 - most_padding) * capacity)))
    while True:
        found = difference(sizes, ways)
        held = [sum(sizes[i] for i in w) for w in found]
        above = max(held, default=0)
        if above <= capacity or ways == most:
            break
        # As many more as the largest window exceeds the capacity by.
        ways = min(most, max(ways + 1, ways * above // capacity))
    pieces = [[(i, 0, sizes[i]) for i in w] for w in found]
    spare = []
    for w, n in zip(pieces, held):
        while n > capacity:
            w.sort(key=lambda x: x[2])
            i, start, length = w.pop()
            cut = min(n - capacity, length)
            if cut < length:
                w.append((i, start, length - cut))
            spare.append((i, start + length - cut, cut))
            n -= cut
    room = [(n - capacity, k) for k, n in enumerate(held) if n < capacity]
    heapq.heapify(room)
    for i, start, length in sorted(spare, key=lambda x: -x[2]):
        while length:
            free, k = heapq.heappop(room)
            cut = min(length, -free)
            pieces[k].append((i, start, cut))
            start, length = start + cut, length - cut
            if free + cut:
                heapq.heappush(room, (free + cut, k))
    return [w for w in pieces if w]


class _Packer:
    """Cuts the documents of one task and gives their pieces places."""

    def __init__(self, partition: int, capacity: int):
        self.next_id = partition * SEQUENCES_PER_PARTITION
        self.capacity = capacity
        self.room = int(GROUP_WINDOWS * capacity * (1 - SLACK))
        self.group: list[tuple] = []
        self.filled = 0
        self.placed: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self._place([(doc_id, start, self.capacity, total, ids[4 * start : 4 * (start + self.capacity)])])
        if whole < total:
            if self.filled + total - whole > self.room:
                self.flush()
            self.group.append((doc_id, whole, total - whole, total, ids[4 * whole :]))
            self.filled += total - whole

    def flush(self) -> None:
        if self.group:
            for window in windows([x[2] for x in self.group], self.capacity):
                made = []
                for i, start, length in window:
                    doc_id, first, _, total, ids = self.group[i]
                    made.append((doc_id, first + start, length, total, ids[4 * start : 4 * (start + length)]))
                self._place(made)
        self.group, self.filled = [], 0

    def _place(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, n, total, ids in pieces:
            self.placed.append((doc_id, start, n, total, self.next_id, offset, ids))
            offset += n
        self.next_id += 1

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.placed)) or [()] * 7
        self.placed = []
        names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE_TOKENS, cache_bytes: int = CACHE_BYTES
) -> DataFrame:
    """Pack the whole texts of (doc_id, text) into sequences of at most so many tokens.

    tokenizer: path of a byte-level vocabulary, the same on every executor. cache_bytes: see ChunkEncoder. Returns a row per piece: doc_id, start
    (ids of its document before it), length, doc_tokens (with the end id), sequence_id, offset (in the sequence)
    and ids (bytes, little-endian unsigned 32-bit).

    A document that fits one sequence stays whole but for the few that are cut to fill room.
    A null or empty text has the end id only. Rows count one by one: a repeated or null doc_id gives the pieces of
    each of its rows. Other columns are ignored. An empty table gives no piece. Sequence ids depend on how the
    table is split, not on retries: a task that is run again reads the same split in the same order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer, keep_space=True, cache_bytes=cache_bytes)
        packer = _Packer(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            for part in text_slices(batch, 1, BATCH_BYTES):
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                    packer.add(doc_id, ids + END_BYTES)
                yield packer.take()
        packer.flush()
        yield packer.take()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op1_pack_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(pack(docs, public_tokenizers.path("byte_bpe_50k.json"), cache_bytes=3 * CACHE_BYTES))
