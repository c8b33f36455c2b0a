"""BPE by the pair occurrence index against the tokenizers library."""

from __future__ import annotations

import json
import random

import pytest

from waterline.llm.bpe import Vocabulary, decode, encode

public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [
    "",
    None,
    " ",
    "   ",
    "\n\n a \t\n",
    "it's WE'LL I'd 'tis",
    "a" * 5000,
    "abab" * 300 + " " * 77,
    "one<|endoftext|>two <|endoftext|><|endoftext|>",
    "<|endoftext|>",
    "<|endoftext",
    "日本語テキスト 😀👍🏽 é \x00\x1c\x1d\x85 ",
    "՘ ࢏͸x 12٣④ ¼",
    "one",
    "one",
]


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def made_texts(n):
    rng = random.Random(5)
    letters = "aaaabbceett  \n.,'sä中😀1"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(n)]


@pytest.mark.parametrize("batch_chars", [1, 700, 8_000_000])
def test_ids_and_texts(spark, path, library, batch_chars):
    texts = ODD + made_texts(60)
    docs = spark.createDataFrame([(i if i != 7 else None, x, 0) for i, x in enumerate(texts)], "doc_id bigint, text string, ids int")
    rows = decode(encode(docs.repartition(3), path, batch_chars), path).collect()
    found = sorted((r["text"], r["ids"]) for r in rows)
    assert found == sorted((x or "", library.encode(x or "", add_special_tokens=False).ids) for x in texts)
    assert sum(r["doc_id"] is None for r in rows) == 1
    both = encode(docs, path, batch_chars, decoded=True).collect()
    assert sorted((r["text"], r["ids"]) for r in both) == found


def test_documents(spark, path, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in decode(encode(docs, path), path).collect():
        assert r["text"] == texts[r["doc_id"]]
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def test_ids_that_no_text_has(spark, path, library):
    rng = random.Random(6)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 40))] for _ in range(50)]
    encoded = spark.createDataFrame(list(enumerate(lists)) + [(98, [-5, 99999, None, 50256]), (99, None)], "doc_id bigint, ids array<int>")
    found = {r["doc_id"]: r["text"] for r in decode(encoded, path).collect()}
    assert [found[i] for i in range(50)] == [library.decode(x, skip_special_tokens=False) for x in lists]
    assert (found[98], found[99]) == ("<|endoftext|>", "")


def test_empty_table(spark, path):
    assert decode(encode(spark.createDataFrame([], "doc_id bigint, text string"), path), path).count() == 0


def test_merges_before_their_parts_are_refused(path, tmp_path):
    with open(path, encoding="utf-8") as f:
        plan = json.load(f)
    plan["model"]["merges"].reverse()
    changed = tmp_path / "reversed.json"
    changed.write_text(json.dumps(plan))
    with pytest.raises(ValueError, match="before their parts"):
        Vocabulary(str(changed))
