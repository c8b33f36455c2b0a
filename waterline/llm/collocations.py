"""Collocations: phrases of two and three words, counted exactly by HAT-tries.

Each task counts the phrases of its own texts in a shallow trie over word ids, whose leaves are hash containers. A container covers a
range of ids; one that grows beyond its bound bursts, into two halves of its range, or, if it covers a single id, into a node for
the next word. A trie that holds too many phrases spills whole subtrees, each as a run sorted by phrase. Spark brings
the runs of a prefix partition (language, first word, a share of the phrases) together and adds them up.

Phrases are counted by length. A phrase can be frequent only if both phrases of one word less in it are, so the longer counts skip
whatever a filter of the shorter frequent phrases doesn't hold: a bit table of bounded size, which lets some
infrequent ones through and holds back no frequent one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waterline.llm.bpe import _Numbers, text_slices
from waterline.llm.store import materialize

MOST_WORDS = 3
LEAST_COUNT = 10
LARGEST_SHARE = 50
TOP = 2_000
#: Phrases of a container; phrases that a task holds before it spills; distinct words, and their bytes, that have ids at once.
CONTAINER, HELD_PHRASES, HELD_WORDS, HELD_BYTES = 16_384, 1_000_000, 400_000, 32 << 20
#: Bytes of text that are counted at a time (one text at least, whatever its length).
BATCH_BYTES = 4_000_000
#: Bits of a filter: so many for each phrase, up to a bound (8 MB).
BITS_A_PHRASE, MOST_BITS, PROBES = 12, 1 << 26, 4
#: A word may begin or end a third of all phrases, so joins on a part of a phrase are salted, and prefixes spread.
SALTS = 16

#: Word ids have 21 bits, so a key of three words is one number in the order of its words. 0 and 1 are no words.
ID_BITS = 21
_ABSENT, _BREAK = b"", b"\n"

#: A-Z in lower case; the characters that end a piece become line feeds, tabs become spaces.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))


class _Node:
    """Ranges of the word at one depth: lower bounds of the keys, and for each a container (dict) or a node."""

    def __init__(self, depth: int, low: int):
        self.depth, self.bounds, self.parts = depth, [low], [{}]


class HatTrie:
    """Counts of phrases of a fixed number of word ids, as packed keys."""

    def __init__(self, words: int, container: int = CONTAINER):
        self.words, self.container = words, container
        self.size = 0
        self.root = _Node(0, 0)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Distinct keys in ascending order."""
        self._add(self.root, keys, counts)

    def _add(self, node: _Node, keys: np.ndarray, counts: np.ndarray) -> None:
        cuts = [0, *np.searchsorted(keys, node.bounds[1:]).tolist(), len(keys)]
        for i in reversed(range(len(node.parts))):
            a, b = cuts[i], cuts[i + 1]
            if a == b:
                continue
            part = node.parts[i]
            if isinstance(part, _Node):
                self._add(part, keys[a:b], counts[a:b])
                continue
            before, held = len(part), part.get
            for key, n in zip(keys[a:b].tolist(), counts[a:b].tolist()):
                part[key] = held(key, 0) + n
            self.size += len(part) - before
            if len(part) > self.container:
                self._burst(node, i)

    def _burst(self, node: _Node, i: int) -> None:
        """Replaces a container by containers of bounded size."""
        part, low = node.parts[i], node.bounds[i]
        shift = ID_BITS * (self.words - 1 - node.depth)
        ids = np.sort(np.fromiter(part, "i8", len(part))) >> shift
        middle = int(ids[len(ids) // 2])
        if middle == ids[0]:
            after = ids[ids > middle]
            if not len(after):
                if node.depth + 1 < self.words:
                    child = _Node(node.depth + 1, low)
                    child.parts = [part]
                    node.parts[i] = child
                    self._burst(child, 0)
                return
            middle = int(after[0])
        bound = middle << shift
        halves = [{k: n for k, n in part.items() if k < bound}, {k: n for k, n in part.items() if k >= bound}]
        node.bounds[i : i + 1] = [low, bound]
        node.parts[i : i + 1] = halves
        for j in (1, 0):
            if len(halves[j]) > self.container:
                self._burst(node, i + j)

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes out whole subtrees below the root, the largest first, until no more than `keep` phrases are left: keys in
        order, and their counts."""
        by_size = sorted(range(len(self.root.parts)), key=lambda i: -_size(self.root.parts[i]))
        for i in by_size:
            if self.size <= keep:
                break
            found = list(_items(self.root.parts[i]))
            self.root.parts[i] = {}
            if found:
                keys, counts = np.array(found, "i8").T
                self.size -= len(keys)
                order = np.argsort(keys)
                yield keys[order], counts[order]
        if not self.size:
            self.root = _Node(0, 0)


def _size(part: dict | _Node) -> int:
    return len(part) if isinstance(part, dict) else sum(map(_size, part.parts))


def _items(part: dict | _Node) -> Iterator[tuple[int, int]]:
    if isinstance(part, dict):
        yield from part.items()
    else:
        for x in part.parts:
            yield from _items(x)


def _together(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash for the phrases whose words have these."""
    found = hashes[0]
    for h in hashes[1:]:
        found = (found * np.uint64(0x9E3779B97F4A7C15)) ^ h
        found = (found ^ (found >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode())
    return np.fromiter((xxh64_intdigest(w, seed) for w in words), "u8", len(words))


def _bits(hashes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The places of phrases in a table of so many bits (a power of two), a probe at a time."""
    step = (hashes >> np.uint64(33)) | np.uint64(1)
    for i in range(PROBES):
        yield (hashes + np.uint64(i) * step) & np.uint64(size - 1)


class Filter:
    """A bit table of phrases: holds all that were put in, and some others."""

    def __init__(self, size: int, words: np.ndarray):
        self.size, self.words = size, words

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in _bits(hashes, self.size):
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def phrase_filter(phrases: DataFrame, words: int, most_bits: int = MOST_BITS) -> Filter:
    """The filter of (lang, phrase), phrases of so many words. Its bits are joined by Spark; the driver gets the table."""
    wanted = max(64, min(most_bits, BITS_A_PHRASE * phrases.count()))
    size = 1 << (wanted - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size >> 6, "u8")
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                parts = [x.encode().split(b" ") for x, y in zip(texts, langs) if y == lang]
                hashes = _together([_word_hashes(lang, [p[i] for p in parts]) for i in range(words)])
                for at in _bits(hashes, size):
                    np.bitwise_or.at(table, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(table)
        for i in range(0, len(used), 100_000):
            part = used[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(table[part].view("i8"))], names=["word", "bits"])

    found = phrases.select("lang", "phrase").mapInArrow(run, "word bigint, bits bigint")
    table = np.zeros(size >> 6, "u8")
    # Bounded by the size of the table, whatever the number of phrases.
    joined = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table[joined.column("word").to_numpy()] = joined.column("bits").to_numpy().view("u8")
    return Filter(size, table)


def segments(letters: bytes, words: int, size: int = BATCH_BYTES) -> Iterator[bytes]:
    """Parts of about so many bytes at most that hold each phrase of so many words once.

    Cut at the end of a piece, or, in a longer piece, behind a word; then the next part begins with the last words - 1 words.
    """
    start, room = 0, size
    while len(letters) - start > room:
        stop = letters.rfind(b"\n", start, start + room)
        after = stop + 1
        if stop <= start:
            stop = after = letters.rfind(b" ", start, start + room)
            for _ in range(words - 1):
                while after > start and letters[after - 1 : after] == b" ":
                    after -= 1
                after = 1 + max(letters.rfind(b" ", start, after), letters.rfind(b"\n", start, after), start - 1)
        if after <= start:
            room *= 2  # words as long as this
            continue
        yield letters[start:stop]
        start, room = after, size
    yield letters[start:]


class _Counter:
    """Counts the phrases of one length in the texts of a task."""

    def __init__(self, words: int, filter_: Filter | None, held: int, container: int):
        self.words, self.filter, self.held, self.container = words, filter_, held, container
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers({_ABSENT: 0, _BREAK: 1})
        self.bytes = 0
        self.tries: dict[str, HatTrie] = {}
        self.hashes: dict[str, np.ndarray] = {}

    def add(self, lang: str, letters: bytes) -> None:
        """Letters: as LETTERS makes them, a segment of bounded size."""
        words = letters.replace(b"\n", b" \n ").split(b" ")
        known = len(self.numbers)
        ids = np.fromiter(map(self.numbers.__getitem__, words), "i8", len(words))
        ids = ids[ids != 0]
        names = list(self.numbers)
        self.bytes += sum(map(len, names[known:]))
        here = ids > 1
        n = len(ids) - self.words + 1
        if n <= 0:
            return
        whole = np.logical_and.reduce([here[i : n + i] for i in range(self.words)])
        if self.filter:
            # Both phrases of one word less must be in the filter.
            old = self.hashes.get(lang, np.zeros(0, "u8"))
            hashes = self.hashes[lang] = np.append(old, _word_hashes(lang, names[len(old) :]))
            mine = hashes[ids]
            shorter = _together([mine[i : n + 1 + i] for i in range(self.words - 1)])
            held = self.filter.holds(shorter)
            whole &= held[:-1] & held[1:]
        at = np.flatnonzero(whole)
        keys = ids[at]
        for i in range(1, self.words):
            keys = keys << ID_BITS | ids[at + i]
        if len(keys):
            trie = self.tries.setdefault(lang, HatTrie(self.words, self.container))
            trie.add(*np.unique(keys, return_counts=True))

    def runs(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Spilled runs, if it is time."""
        # A segment's new words, fewer than a million, still have ids of 21 bits.
        full = len(self.numbers) > HELD_WORDS or self.bytes > HELD_BYTES
        if not (last or full or sum(t.size for t in self.tries.values()) > self.held):
            return
        names = None
        for lang, trie in self.tries.items():
            for keys, counts in trie.spill(0 if last or full else self.held // (2 * len(self.tries))):
                if names is None:
                    names = pa.array(list(self.numbers), pa.binary()).cast(pa.string())
                for i in range(0, len(keys), 50_000):
                    yield self._run(lang, names, keys[i : i + 50_000], counts[i : i + 50_000])
        if full:
            self._forget()

    def _run(self, lang: str, names: pa.Array, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        mask = (1 << ID_BITS) - 1
        words = [names.take(pa.array(keys >> ID_BITS * i & mask)) for i in reversed(range(self.words))]
        phrase = words[0] if len(words) == 1 else pc.binary_join_element_wise(*words, " ")
        langs = pa.array([lang] * len(keys), pa.string())
        return pa.RecordBatch.from_arrays([langs, words[0], phrase, pa.array(counts)], names=["lang", "first", "phrase", "f"])


def count_phrases(
    docs: DataFrame, words: int, filter_: Filter | None = None, held: int = HELD_PHRASES, container: int = CONTAINER
) -> DataFrame:
    """(lang, phrase, f): how often each phrase of so many words occurs in (lang, text), within pieces, overlaps included.

    filter_: of phrases of one word less; phrases it rules out are left out. Null texts are empty, a null lang is `und`.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(filter_) if filter_ else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(words, broadcast.value if broadcast else None, held, container)
        for batch in batches:
            for part in text_slices(batch, 1, BATCH_BYTES):
                langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(langs, texts):
                    by_lang.setdefault(lang, []).append(text)
                for lang, mine in by_lang.items():
                    for letters in segments(_BREAK.join(mine).translate(LETTERS), words):
                        counter.add(lang, letters)
                        yield from counter.runs(last=False)
        yield from counter.runs(last=True)

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    runs = rows.mapInArrow(run, "lang string, first string, phrase string, f bigint")
    runs = runs.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    prefix = ["lang", "first", "share"]
    merged = runs.repartition(*prefix).groupBy(*prefix, "phrase").agg(F.sum("f").alias("f"))
    return merged.select("lang", "phrase", "f")


def _look_up(rows: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """Rows with the count of the phrase in one of their columns."""
    copies = counts.select(F.col("lang"), F.col("phrase").alias(part), F.col("f").alias(name))
    copies = copies.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    return salted.join(copies, ["lang", part, "__salt"]).drop("__salt")


def _words(first: int, last: int) -> F.Column:
    """Words first to last (from 1) of the phrase, space-joined."""
    return F.array_join(F.slice(F.split("phrase", " "), first, last - first + 1), " ")


def _score(a: str = "a", l: str = "l", r: str = "r") -> F.Column:  # noqa: E741
    """floor(1000000 a² / (l r)), in whole numbers of 38 digits: exact for counts up to 10¹⁵."""
    return F.expr(f"(1000000BD * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0))) div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0)))")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, share: int = LARGEST_SHARE, held: int = HELD_PHRASES, container: int = CONTAINER) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) for the phrases of two and three words that occur at least `least` times in a language.

    Texts are lower-cased (A-Z) and split into pieces at [.,;:!?] and line breaks, pieces into words at spaces and tabs. a: occurrences;
    l, r: those of the first part and the rest for the cut of the lowest score (the earliest of equal ones); n: words of the
    language. A phrase inside a longer candidate that has at least `share` percent of its occurrences is left out.

    Null texts are empty and a null lang is `und`. Rows count one by one, repeated ones too; doc_id and other columns are ignored.
    An empty table gives no rows. Counts are of all rows, and exact.
    """
    words = materialize(count_phrases(docs, 1, None, held, container), "words")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = [words.where(F.col("f") >= least)]
    for k in range(2, MOST_WORDS + 1):
        found = count_phrases(docs, k, phrase_filter(counts[-1], k - 1), held, container)
        counts.append(materialize(found.where(F.col("f") >= least), f"phrases-{k}"))

    cut = None
    for k in range(2, MOST_WORDS + 1):
        rows = counts[k - 1].withColumnRenamed("f", "a")
        for at in range(1, k):
            rows = rows.withColumn("front", _words(1, at)).withColumn("back", _words(at + 1, k))
            rows = _look_up(rows, counts[at - 1], "front", "l")
            rows = _look_up(rows, counts[k - at - 1], "back", "r")
            rows = rows.withColumn(f"cut{at}", F.struct(_score().alias("score"), F.lit(at).alias("at"), "l", "r")).drop("front", "back", "l", "r")
        cuts = [F.col(f"cut{at}") for at in range(1, k)]
        rows = rows.select("lang", "phrase", "a", (F.least(*cuts) if k > 2 else cuts[0]).alias("cut"))
        if k < MOST_WORDS:
            longer = counts[k].select("lang", F.explode(F.array(_words(1, k), _words(2, k + 1))).alias("__part"), "f")
            most = longer.groupBy("lang", "__part").agg(F.max("f").alias("most")).withColumnRenamed("lang", "__lang")
            inside = rows.join(most, (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__part")), "left")
            rows = inside.where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))).drop("__lang", "__part", "most")
        cut = rows if cut is None else cut.unionByName(rows)
    return cut.join(total, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op11_hat_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
pieces AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts
),
listed AS (
  SELECT lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
),
occurrences AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM listed
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM listed WHERE len(w) > 1
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM listed WHERE len(w) > 2
),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM occurrences GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.*, 1 AS cut, w[1] AS front, array_to_string(w[2:], ' ') AS back FROM candidates c
  UNION ALL
  SELECT c.*, 2, w[1] || ' ' || w[2], w[3] FROM candidates c WHERE k = 3
),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f * y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = c.front AND x.k = c.cut
  JOIN f y ON y.lang = c.lang AND y.phrase = c.back AND y.k = c.k - c.cut
),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
inner_parts AS (
  SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE k = 3
  UNION ALL
  SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE k = 3
),
longest AS (SELECT lang, phrase, max(a) AS most FROM inner_parts GROUP BY ALL),
kept AS (
  SELECT x.* FROM lowest x LEFT JOIN longest y ON x.k = 2 AND x.lang = y.lang AND x.phrase = y.phrase
  WHERE y.most IS NULL OR 100 * y.most < 50 * x.a
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, t.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN totals t USING (lang)
WHERE r.rank <= 2000
"""
