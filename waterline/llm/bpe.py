"""Byte-level BPE by a pair occurrence index, and back.

The distinct words of a batch of texts lie in one array of symbols. An index maps each pair that has a merge, by the merge's
rank, to all positions where the pair begins. Active ranks are applied in ascending order, each at all its positions at
once; only the pairs beside a merge change, and enter the lists of their ranks.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.llm.tokens import BYTE_LETTERS

#: Fixed value: how byte-level vocabularies split a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of the texts that share an index (one text at least, whatever its length).
BATCH_CHARS = 4_000_000


class Vocabulary:
    """Merges by rank, ids and their bytes, from a file of the tokenizers library.

    Only plain byte-level vocabularies are taken: no normalizer, no prefix space, no dropout, added tokens without
    options. A merge must have a larger rank than those that make its parts; then a merge never makes a pair of
    a smaller rank, and ranks in ascending order give what the smallest rank of each word in turn gives.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            text = f.read()
        plan = json.loads(text)
        model, split = plan["model"], plan["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and split.get("type") == "ByteLevel"
            and not split["add_prefix_space"]
            and plan["normalizer"] is None
            and not any(t[x] for t in plan["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        vocab = model["vocab"]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.left = [vocab[a] for a, _ in pairs]
        self.right = [vocab[b] for _, b in pairs]
        self.made = [vocab[a + b] for a, b in pairs]
        born: dict[int, int] = {}
        for rank, x in enumerate(self.made):
            born.setdefault(x, rank)
        if any(max(born.get(a, -1), born.get(b, -1)) >= r for r, (a, b) in enumerate(zip(self.left, self.right))):
            raise ValueError(f"{path} has merges that come before their parts")
        keys = np.array(self.left, "i8") << 32 | np.array(self.right, "i8")
        # Of a pair that is listed twice the later rank counts, as in a map that is filled in order.
        self.keys, last = np.unique(keys[::-1], return_index=True)
        self.rank = len(keys) - 1 - last
        self.byte_id = np.array([vocab[BYTE_LETTERS[b]] for b in range(256)], "i4")

        self.added = {t["content"]: t["id"] for t in plan["added_tokens"]}
        longest = sorted(self.added, key=len, reverse=True)
        self.literal = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.words = regex.compile(WORDS)
        self.splitter = Tokenizer.from_str(text).pre_tokenizer
        letter_byte = {c: b for b, c in BYTE_LETTERS.items()}
        spelled = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in {**vocab, **self.added}.items():
            known = all(c in letter_byte for c in token)
            spelled[i] = bytes(letter_byte[c] for c in token) if known else token.encode()
        self.spelled = np.frombuffer(b"".join(spelled), "u1")
        self.spelled_to = np.cumsum([0, *map(len, spelled)])

    def split(self, text: str) -> list[str]:
        """The words of a text without added tokens. Together they are the text."""
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Characters without a category here may have one in the library, and the other way round.
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.words.findall(text)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair; -1 for pairs without a merge."""
        keys = a.astype("i8") << 32 | b
        at = self.keys.searchsorted(keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.rank[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after another, and where each word's begin (with the end of the last)."""
        spelled = [w.encode() for w in words]
        symbol = np.append(self.byte_id[np.frombuffer(b"".join(spelled), "u1")], np.int32(-1))
        end = len(symbol) - 1
        stops = np.cumsum([0, *map(len, spelled)])
        after, before = np.arange(1, end + 2), np.arange(-1, end)
        # Beyond a word lies the last position, which holds no symbol.
        after[stops[1:] - 1] = end
        before[stops[:-1]] = end
        after[end] = before[end] = end

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray) -> None:
            ranks = self.ranks(symbol[positions], symbol[after[positions]])
            held = np.flatnonzero(ranks >= 0)
            if not len(held):
                return
            held = held[np.argsort(ranks[held], kind="stable")]
            ranks, positions = ranks[held], positions[held]
            starts = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])).tolist()
            for rank, i, j in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(positions[i:j])

        enter(np.arange(end))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            if len(at) > 1:
                at = np.unique(at)
            a, b = self.left[rank], self.right[rank]
            at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
            if a == b and len(at) > 1:
                at = _from_the_left(at, after)
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbol[at], symbol[gone] = self.made[rank], -1
            after[at] = beyond
            before[beyond] = at
            earlier = before[at]
            enter(np.concatenate([earlier[earlier != end], at[beyond != end]]))

        kept = symbol[:-1] >= 0
        return symbol[:-1][kept], np.append(0, np.cumsum(kept))[stops]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (with the end of the last)."""
        numbers = _Numbers()
        sequences: list[np.ndarray] = []
        for text in texts:
            found = []
            for part, added in self._parts(text or ""):
                found += map(numbers.__getitem__, self.split(part))
                if added is not None:
                    found.append(-1 - added)
            sequences.append(np.array(found, "i4"))
        words = np.concatenate([*sequences, np.empty(0, "i4")])
        ids, starts = self.merge(list(numbers))
        # An added token is a word of one id behind those of the batch.
        extra = np.unique(words[words < 0])
        ids = np.concatenate([ids, (-1 - extra).astype("i4")])
        starts = np.concatenate([starts, starts[-1] + 1 + np.arange(len(extra))])
        words = np.where(words < 0, len(numbers) + np.searchsorted(extra, words), words)
        length = np.diff(starts)[words]
        before = np.append(0, np.cumsum(length))
        stops = before[np.cumsum([0, *map(len, sequences)])]
        return ids[_spans(starts[words], length)], stops

    def _parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        at = 0
        if self.literal:
            for m in self.literal.finditer(text):
                yield text[at : m.start()], self.added[m.group()]
                at = m.end()
        yield text[at:], None

    def decode(self, ids: np.ndarray, stops: np.ndarray) -> list[str]:
        """The texts of ids that lie between the stops. Unknown ids are left out, bytes that are no UTF-8 replaced."""
        known = (ids >= 0) & (ids < len(self.spelled_to) - 1)
        ids = np.where(known, ids, 0)
        length = np.where(known, self.spelled_to[ids + 1] - self.spelled_to[ids], 0)
        letters = self.spelled[_spans(self.spelled_to[ids], length)].tobytes()
        cuts = np.append(0, np.cumsum(length))[stops].tolist()
        return [letters[i:j].decode("utf-8", "replace") for i, j in zip(cuts, cuts[1:])]


class _Numbers(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... for each span, one span after another."""
    before = np.cumsum(length) - length
    total = int(length.sum())
    kind = "i4" if total + int(start.max(initial=0)) < 1 << 31 else "i8"
    spans = np.repeat((start - before).astype(kind), length)
    spans += np.arange(total, dtype=kind)
    return spans


def _from_the_left(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of equal pairs that overlap ("aaa") the first, third, ... of each run."""
    joined = np.append(False, after[at[:-1]] == at[1:])
    first = np.flatnonzero(~joined)
    place = np.arange(len(at)) - first[np.cumsum(~joined) - 1]
    return at[place % 2 == 0]


def text_slices(batch: pa.RecordBatch, column: int, most_chars: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most so many bytes together (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    upto, start = np.cumsum(size), 0
    while start < len(size):
        before = int(upto[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, before + most_chars, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode(docs: DataFrame, path: str, batch_chars: int = BATCH_CHARS, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) for every row of (doc_id, text).

    decoded: also `text`, what decode makes of the ids, without another pass over them.

    path: a byte-level vocabulary of the tokenizers library, the same on every executor. Ids are those of its encode with
    add_special_tokens=False; the literal of an added token has that token's id. A null or empty text has no ids. Rows count
    one by one, whatever their doc_id. Other columns are ignored; an empty table gives no rows. Texts are whole,
    of any length; no row leaves its partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for batch in batches:
            for part in text_slices(batch, 1, batch_chars):
                ids, stops = vocabulary.encode(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32()))
                columns = {"doc_id": part.column(0), "ids": lists}
                if decoded:
                    columns["text"] = pa.array(vocabulary.decode(ids, stops), pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>" + (", text string" if decoded else ""))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) for every row of (doc_id, ids): the text that the ids spell, added tokens included.

    Null ids give an empty text, null or unknown ids in a list are left out. Otherwise as in encode.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for batch in batches:
            lists = batch.column(1)
            length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
            texts = vocabulary.decode(ids, np.append(0, np.cumsum(length)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    rows = encoded.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def op12_bpe_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, path, decoded=True).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
