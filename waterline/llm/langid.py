"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text of each language tells how far a text goes on as that text does somewhere. Parsing a
document into longest matches, the number of phrases times the bits that name a place estimates the cross entropy
(Ziv and Merhav 1993). The language that needs fewest such bits per letter wins.

Whole texts are parsed, all languages alike, in lanes of 256 letters side by side, so that one numpy step moves thousands of
lanes; a phrase ends where its lane does.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waterline.llm.tokens import batched

#: Labelled text of each language that its automaton is built from, in characters, and the documents it may come from:
#: those of at most so many characters first, in a seeded order.
REFERENCE_CHARS = 16_384
REFERENCE_DOCS = 48
SHORT_DOC_CHARS = 2_000
LANE = 256
#: Codes of letters that no automaton knows, of anything but letters, and of the end of a lane; then the known letters.
UNKNOWN, SPACE, PAD, FIRST = 0, 1, 2, 3
UNDETERMINED = "und"
CODE_POINTS = 0x110000


def folded(text: str) -> str:
    """Lower case, and one blank for anything else than letters."""
    return "".join(c if c.isalpha() else " " for c in text.lower())


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start (Blumer et al. 1985)."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        now = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return step


def random_bits(text: str) -> float:
    """Bits per letter of letters drawn at random, as often as a learnt text has them (blanks between words count); those
    of 26 equally likely letters at least."""
    counts = np.array(list(Counter(" ".join(folded(text).split())).values()), "f8")
    share = counts / counts.sum()
    return max(math.log2(26), float(-(share * np.log2(share)).sum()))


class Parser:
    """The automata of all languages as tables: the next state times the alphabet, and in the lowest bit whether a phrase
    ended before this letter."""

    def __init__(self, references: dict[str, str]):
        self.langs = sorted(references)
        texts = [" ".join(folded(references[x]).split()) for x in self.langs]
        letters = sorted({c for x in texts for c in x if c != " "})
        self.size = FIRST + len(letters)
        self.codes = np.full(CODE_POINTS, SPACE, "u2")
        self.codes[[i for i in range(CODE_POINTS) if chr(i).isalpha()]] = UNKNOWN
        self.codes[[ord(c) for c in letters]] = np.arange(FIRST, self.size)
        self.tables = [self._table(self.encode(x).tolist()) for x in texts]
        self.place_bits = [math.log2(max(2, len(x))) for x in texts]

    def encode(self, text: str) -> np.ndarray:
        return self.codes[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]

    def _table(self, codes: list[int]) -> np.ndarray:
        steps, n = suffix_automaton(codes), self.size
        fresh = np.ones(n, "i8")  # a new phrase from the start, or none at all
        for c, state in steps[0].items():
            fresh[c] = (state * n) << 1 | 1
        table = np.tile(fresh, (len(steps), 1))
        table[0] &= ~np.int64(1)
        table[0, UNKNOWN] |= 1
        for c in range(n):  # at the start, a letter that begins no phrase is one of its own
            table[0, c] |= c not in steps[0]
        for state, step in enumerate(steps):
            for c, to in step.items():
                table[state, c] = (to * n) << 1
        table[:, PAD] = (np.arange(len(steps)) * n) << 1
        return table.ravel().astype("i4" if table.max() < 1 << 31 else "i8")

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters parsed (blanks between words count), and phrases per language, of each text; no letters: zeros."""
        parts, lanes, sizes = [], [], []
        for x in texts:
            c = self.encode(x.lower())
            blank = c == SPACE
            keep = ~blank
            keep[1:] |= ~blank[:-1]  # one blank of a run
            c = c[keep]
            n = 0 if blank.all() else len(c)
            count = -(-n // LANE)
            parts.append(np.pad(c[:n], (0, count * LANE - n), constant_values=PAD))
            lanes.append(count)
            sizes.append(n)
        letters = np.concatenate(parts).reshape(-1, LANE).T.copy() if parts else np.empty((LANE, 0), "u2")
        owner = np.repeat(np.arange(len(texts)), lanes)
        found = np.zeros((len(texts), len(self.langs)), "i8")
        for k, table in enumerate(self.tables):
            state, ended = np.zeros(letters.shape[1], "i8"), np.zeros(letters.shape[1], "i8")
            for row in letters:
                step = table[state + row]
                ended += step & 1
                state = step >> 1
            found[:, k] = np.bincount(owner, weights=ended, minlength=len(texts))
        return np.array(sizes, "i8"), found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bits per letter of each text."""
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        sizes, ended = self.phrases([x or "" for x in texts])
        bits = ended * np.array(self.place_bits) / np.maximum(sizes, 1)[:, None]
        best = bits.argmin(axis=1)
        # Half a phrase keeps the shares of very short texts finite.
        share = 1 / (ended + 0.5) / np.array(self.place_bits)
        share = share[np.arange(len(texts)), best] / share.sum(axis=1)
        known = sizes > 0
        langs = [self.langs[i] if ok else UNDETERMINED for i, ok in zip(best, known)]
        return langs, np.where(known, share, 0.0), np.where(known, bits[np.arange(len(texts)), best], 0.0)


def held_out() -> Column:
    """Documents that nothing is learnt from: crc32 of the doc_id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def references(docs: DataFrame, chars: int = REFERENCE_CHARS, most_docs: int = REFERENCE_DOCS) -> dict[str, str]:
    """A bounded sample of labelled text for each language, from documents that are not held out and have a doc_id.

    Document numbers are chosen first; only their texts are read. The bound holds for each language in use.
    """
    open_docs = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    open_docs = open_docs.withColumn("chars", F.char_length("text")).where("chars > 0")
    order = Window.partitionBy("lang").orderBy(F.col("chars") > SHORT_DOC_CHARS, F.xxhash64("doc_id"), "doc_id")
    chosen = open_docs.select("doc_id", "lang", F.row_number().over(order).alias("turn")).where(F.col("turn") <= most_docs)
    # At most most_docs for each language.
    wanted = chosen.collect()
    texts = docs.where(F.col("doc_id").isin([r["doc_id"] for r in wanted]) & F.col("lang").isin(list({r["lang"] for r in wanted})))
    # One text for each number and language, however often a number comes.
    texts = texts.groupBy("doc_id", "lang").agg(F.max(F.substring("text", 1, chars)).alias("text"))
    by_doc = {(r["doc_id"], r["lang"]): r["text"] or "" for r in texts.collect()}
    found: dict[str, str] = {}
    for r in sorted(wanted, key=lambda r: (r["lang"], r["turn"])):
        found[r["lang"]] = (found.get(r["lang"], "") + " " + by_doc.get((r["doc_id"], r["lang"]), ""))[: chars + 1]
    return {k: v for k, v in found.items() if any(c.isalpha() for c in v)}


def identify(docs: DataFrame, learned: dict[str, str] | None = None) -> DataFrame:
    """All rows of docs (doc_id, text, lang, ...) with held_out, lang_pred, score and bits.

    learned: text for each language; by default a bounded sample of the labelled documents that are not held out. A
    prediction uses the text alone. A null text, one without a letter, and any text if nothing could be learnt, is `und`
    with score 0. score: the winner's share, the inverse numbers of bits adding up to 1. bits: per letter, for the winner.
    Equal languages: the first by name. A null doc_id is not held out and teaches nothing. Repeated rows stay; input
    columns with the names of the results are replaced; an empty table gives no rows.
    """
    known = references(docs) if learned is None else learned
    names = ["held_out", "lang_pred", "score", "bits"]
    rows = docs.drop(*names).withColumn("held_out", held_out())
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(known)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for part in batched(texts, 2_000_000):
                langs, score, bits = parser.predict(texts[part])
                held = batch.slice(part.start, part.stop - part.start)
                columns = [*held.columns, pa.array(langs, pa.string()), pa.array(score), pa.array(bits)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names[1:]])

    schema = StructType(list(rows.schema.fields)).add("lang_pred", "string").add("score", "double").add("bits", "double")
    return rows.mapInArrow(run, schema)


def op6_language_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), references(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")
