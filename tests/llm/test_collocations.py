"""Collocations against plain counting, with tries that burst and spill."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from waterline.llm.collocations import LETTERS, HatTrie, _score, collocations, count_phrases, phrase_filter, segments

SCHEMA = "doc_id bigint, text string, lang string"


def plain_counts(rows, words):
    found = Counter()
    for _, text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            found.update((lang or "und" if lang is None else lang, " ".join(w[i : i + words])) for i in range(len(w) - words + 1))
    return found


def plain_collocations(rows, least, share=50):
    f = {k: plain_counts(rows, k) for k in (1, 2, 3)}
    n = defaultdict(int)
    for (lang, _), c in f[1].items():
        n[lang] += c
    kept = {}
    for k in (2, 3):
        for (lang, phrase), a in f[k].items():
            if a < least:
                continue
            w = phrase.split(" ")
            if k == 2 and any(100 * c >= share * a for (x, y), c in f[3].items() if c >= least and x == lang and phrase in (y.rsplit(" ", 1)[0], y.split(" ", 1)[1])):
                continue
            cuts = []
            for at in range(1, k):
                l, r = f[at][lang, " ".join(w[:at])], f[k - at][lang, " ".join(w[at:])]  # noqa: E741
                cuts.append((1_000_000 * a * a // (l * r), at, l, r))
            score, _, l, r = min(cuts)  # noqa: E741
            kept[lang, phrase] = (a, l, r, n[lang], score)
    return kept


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    words = ["New", "york", "CITY", "of", "the", "é", "Éa", "x y", "and", "z"] + [f"w{i}" for i in range(40)]
    weights = [8, 8, 6, 9, 12, 3, 3, 2, 6, 2] + [1] * 40
    rows = []
    for i in range(120):
        text = "".join(rng.choices(words, weights)[0] + rng.choice([" "] * 12 + ["  ", "\t", ". ", "\n", "!?", " , "]) for _ in range(rng.randint(0, 80)))
        rows.append((i, text, rng.choice(["en", "en", "en", "fr", None, ""])))
    return rows + [(None, None, "en"), (1, "", None), (1, "..,,\n\n", "xx"), (5, "the the the the the the", "yy")] + rows[:20]


@pytest.mark.parametrize("held, container", [(1_000_000, 16_384), (50, 4), (300, 1)])
def test_counts_and_candidates(spark, rows, held, container):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for k in (1, 2, 3):
        got = {(r["lang"], r["phrase"]): r["f"] for r in count_phrases(docs, k, None, held, container).collect()}
        assert got == plain_counts(rows, k)
    got = {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in collocations(docs, 3, 50, held, container).collect()}
    assert got == plain_collocations(rows, 3)


def test_trie_bursts_into_nodes_and_spills_whole_subtrees():
    rng = np.random.default_rng(8)
    trie, expected = HatTrie(3, container=5), Counter()
    for _ in range(20):
        words = rng.integers(2, 9, (300, 3)) ** 2
        keys = words[:, 0] << 42 | words[:, 1] << 21 | words[:, 2]
        trie.add(*np.unique(keys, return_counts=True))
        expected.update(keys.tolist())
    assert trie.size == len(expected)
    assert any(not isinstance(p, dict) for p in trie.root.parts)
    found = Counter()
    for keep in (trie.size // 2, 0):
        for keys, counts in trie.spill(keep):
            assert (np.diff(keys) > 0).all()
            found.update(dict(zip(keys.tolist(), counts.tolist())))
        assert trie.size <= keep
    assert found == expected


def test_filter_holds_what_was_put_in(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    two = count_phrases(docs, 2)
    often = plain_counts(rows, 2)
    frequent = two.where("f >= 6")
    through = {(r["lang"], r["phrase"]) for r in count_phrases(docs, 3, phrase_filter(frequent, 2, most_bits=64)).collect()}
    needed = {
        k for k in plain_counts(rows, 3)
        if often[k[0], k[1].rsplit(" ", 1)[0]] >= 6 and often[k[0], k[1].split(" ", 1)[1]] >= 6
    }
    assert needed <= through
    few = {(r["lang"], r["phrase"]) for r in count_phrases(docs, 3, phrase_filter(frequent, 2)).collect()}
    assert needed <= few < set(plain_counts(rows, 3))


@pytest.mark.parametrize("size", [1, 7, 40, 300])
def test_segments_hold_each_phrase_once(rows, size):
    text = " ".join(x or "" for _, x, _ in rows[:40]) + "\nlonglonglonglong  " * 3 + "  one piece without any mark " * 9
    letters = text.encode().translate(LETTERS)
    for k in (1, 2, 3):
        parts = [(0, x.decode(), "en") for x in segments(letters, k, size)]
        assert plain_counts(parts, k) == plain_counts([(0, text, "en")], k)
        if size == 300:
            assert max(len(x) for _, x, _ in parts) <= 300


def test_score_is_exact_beyond_64_bits(spark):
    a, l, r = 10**14 + 7, 10**14 + 9, 3 * 10**14 + 1  # noqa: E741
    df = spark.createDataFrame([(a, l, r)], "a bigint, l bigint, r bigint")
    assert df.select(_score().alias("s")).first()["s"] == 1_000_000 * a * a // (l * r)


def test_empty_and_long(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "red fox " * 300_000 + "x" * 3_000_000
    got = {r["phrase"]: r["a"] for r in collocations(spark.createDataFrame([(1, text, "en", 5, 6)], SCHEMA + ", f int, phrase int")).collect()}
    # "red fox" lies inside "red fox red", which is as frequent but for one.
    assert got == {"red fox red": 299_999, "fox red fox": 299_999}
