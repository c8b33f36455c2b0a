"""Every operator of the llm package against a plain version, an exact round trip or held-out labels."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waterline.llm import embeddings, idstore, langid, mixing, packing, quality, sharding, simhash, url_lists, vptree
from waterline.llm.components import connected
from waterline.llm.store import shared_path
from waterline.llm.tokens import ChunkEncoder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, size string, score string"
LONG = " ".join(f"word{i % 977} and the" for i in range(9_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44, 1, "x", "y"),
    (2, "The quick brown fox jumps over the lazy dog.", "en", "a", 44, None, None, None),
    (2, "The quick brown fox jumps over the lazy dog.", "en", "a", 44, None, None, None),
    (3, None, None, None, None, 3, "z", "z"),
    (4, "", "en", "b", 0, 0, "", ""),
    (5, " \n\t ", "de", "b", 4, 0, "", ""),
    (6, LONG, "en", "c", len(LONG), 0, "", ""),
    (None, "Ohne Nummer ist dieses Dokument.", "de", "c", 32, 0, "", ""),
    (8, "été 123 !!! ### Σίσυφος İstanbul", "fr", "a", 30, 0, "", ""),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain_ids(path: str, text: str | None) -> list[int]:
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize(("path", "keep"), [(BYTES, True), (WORDS, False)])
def test_chunks_give_the_ids_of_whole_texts(path, keep):
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    encoder = ChunkEncoder(path, keep, cache_bytes=5_000)
    rng = random.Random(3)
    for _ in range(4_000):
        text = "".join(rng.choice(" \n\tab'sS1.,ΣİÁé\r") for _ in range(rng.randint(0, 10)))
        want = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode([text])[0] == want, repr(text)


@pytest.mark.parametrize(("path", "keep"), [(BYTES, True), (WORDS, False)])
def test_literals_of_added_tokens_have_their_ids(path, keep):
    plain = Tokenizer.from_file(path)
    encoder = ChunkEncoder(path, keep, cache_bytes=5_000)
    rng = random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDofTEXT|>", "<|", "|>", "<", " ", "\n", "page", "Next", "\u03a3", "e\u0301", "\u0130", "."]
    texts = ["one page<|endoftext|>next page", "<|endoftext|>", "a <|startoftext|> b", "<|END\u1e9eOFTEXT|>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(4_000)]
    for text in texts:
        want = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode([text])[0] == want, repr(text)
    assert {50256, 49407} & set(np.frombuffer(encoder.encode(texts[:1])[0], "<u4").tolist())


def check_pieces(rows, texts: dict) -> None:
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 2048
    for doc_id, want in texts.items():
        pieces = sorted(by_doc[doc_id], key=lambda r: r["start"])
        got = b"".join(bytes(r["ids"]) for r in pieces)
        assert got == np.array(want, "<u4").tobytes()
        assert {r["doc_tokens"] for r in pieces} == {len(want)}


def test_packing_keeps_every_id_once_with_little_padding(spark, docs):
    rows = packing.pack(docs, BYTES).collect()
    check_pieces(rows, {r["doc_id"]: plain_ids(BYTES, r["text"]) for r in docs.collect()})
    used, sequences = sum(r["length"] for r in rows), len({r["sequence_id"] for r in rows})
    assert 1 - used / 2048 / sequences < 0.02


def test_packing_odd_rows(spark, odd):
    rows = packing.pack(odd, BYTES).collect()
    # Document 2 comes twice, so its pieces do as well.
    check_pieces([r for r in rows if r["doc_id"] != 2], {r[0]: plain_ids(BYTES, r[1]) for r in ROWS if r[0] != 2})
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 2 * len(plain_ids(BYTES, ROWS[1][1]))
    assert packing.pack(odd.limit(0), BYTES).count() == 0


def test_differencing_is_near_equal_and_complete():
    rng = random.Random(1)
    sizes = [rng.randint(1, 256) for _ in range(400)]
    found = packing.difference(sizes, 24)
    assert sorted(i for w in found for i in w) == list(range(400))
    sums = [sum(sizes[i] for i in w) for w in found]
    assert max(sums) - min(sums) < 30
    assert packing.difference([5], 3) == [[0], [], []]
    # Two windows would have room for the sum, but not for three equal pieces.
    assert sorted(packing.windows([6, 6, 6], 10, most_padding=0.5)) == [[(0, 0, 6)], [(1, 0, 6)], [(2, 0, 6)]]
    cut = packing.windows([6, 6, 6], 10)
    assert [sum(x[2] for x in w) for w in cut] in ([10, 8], [8, 10]) and sum(len(w) for w in cut) == 4
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(0, 40))]
        made = packing.windows(sizes, 30)
        assert len(made) <= max(1, -(-sum(sizes) // 30)) or 30 * len(made) * (1 - packing.MOST_PADDING) <= sum(sizes)
        assert all(sum(x[2] for x in w) <= 30 for w in made)
        held = sorted(x for w in made for x in w)
        assert [sum(x[2] for x in held if x[0] == i) for i in range(len(sizes))] == sizes
        assert all(b[1] == a[1] + a[2] if a[0] == b[0] else b[1] == 0 for a, b in zip(held, held[1:]))


def test_few_documents_that_fit_are_cut(spark, sf_dir):
    big = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").coalesce(1)
    rows = packing.pack(big, BYTES).collect()
    pieces = Counter(r["doc_id"] for r in rows if r["doc_tokens"] <= 2048)
    assert sum(n > 1 for n in pieces.values()) < 0.1 * len(pieces)
    used, sequences = sum(r["length"] for r in rows), len({r["sequence_id"] for r in rows})
    assert 1 - used / 2048 / sequences < 0.02


def test_hypergeometric_distribution():
    rng = np.random.default_rng(1)
    draws = [sharding.hypergeometric(rng, 30, 50, 20) for _ in range(20_000)]
    assert abs(np.mean(draws) - 7.5) < 0.05 and abs(np.var(draws) - 20 * 0.375 * 0.625 * 60 / 79) < 0.15
    big = sharding.hypergeometric(rng, 10**11, 10**12, 10**10)
    assert abs(big - 10**10 / 11) < 10**6
    matrix = np.array(sharding.communication_matrix([5, 0, 17, 30], [18, 17, 17], seed=4))
    assert matrix.sum(axis=1).tolist() == [5, 0, 17, 30] and matrix.sum(axis=0).tolist() == [18, 17, 17]


@pytest.mark.parametrize("rows_per_task", [15, 500_000])
def test_shards_are_exact_gapless_and_repeatable(spark, docs, odd, rows_per_task):
    for table in (docs, odd):
        rows = sharding.shard(table, 7, seed=1, rows_per_task=rows_per_task).collect()
        assert len(rows) == table.count()
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
        counts = [len(slots[k]) for k in range(7)]
        assert max(counts) - min(counts) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        again = sharding.shard(table, 7, seed=1, rows_per_task=rows_per_task).collect()
        assert Counter(map(str, rows)) == Counter(map(str, again))
    assert sharding.shard(docs.limit(0), 7).count() == 0


def test_sharding_runs_no_python(spark, docs):
    plan = sharding.shard(docs, 24)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def plain_components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 200)]
    pairs += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(70)]
    found = connected(spark.createDataFrame([*pairs, *pairs[:5], (None, 1)], "a bigint, b bigint")).collect()
    want = plain_components(pairs, {x for p in pairs for x in p})
    assert {r["node"]: r["component"] for r in found} == want
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("bucket", [3, 8_192])
def test_fingerprints_link_as_all_pairs_do(spark, bucket):
    """Bucket 3 sends the crowd through every level."""
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    crowd = [base[0] ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3))) for _ in range(60)]
    chain = [base[1] ^ ((1 << (4 * i)) - 1) for i in range(12)]
    every = sorted({x - (1 << 64) if x >> 63 else x for x in base + crowd + chain})
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in every], "fp bigint"), bucket)
    found = {tuple(r) for r in links.collect()}
    bits = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    assert all(bits(a, b) <= 4 for a, b in found)
    near = [(a, b) for a in every for b in every if a < b and bits(a, b) <= 4]
    assert plain_components(found, every) == plain_components(near, every)


def test_simhash_rows(spark, odd, docs):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == 1
    assert by_id[3]["fingerprint"] == "0" * 16 and by_id[3]["component_id"] == by_id[4]["component_id"] == by_id[5]["component_id"] == 3
    assert by_id[None]["component_id"] is None
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    # Spark's own xxhash64 has the same seed.
    text = "One two Three four"
    same = spark.range(1).select(F.xxhash64(F.lit(text.lower())).alias("h")).first()["h"] & ((1 << 64) - 1)
    assert simhash.fingerprint(text) == same and simhash.fingerprint("ÀB c") == simhash.fingerprint("Àb  C")


def test_simhash_does_not_broadcast_copies_of_classes(odd):
    """32 copies of each class were sized as one, and all of them went through the driver while one took under 10 MB."""
    plan = simhash.near_duplicates(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_url_lists_as_of(spark):
    from datetime import date

    entries = [
        ("bad", "block", "spam.example.com", date(2024, 1, 10), True),
        ("bad", "block", "spam.example.com", date(2024, 3, 1), False),
        ("bad", "block", "example.com", date(2023, 1, 1), True),
        ("good", "allow", "spam.example.com/docs", date(2024, 2, 1), True),
        ("good", "allow", "spam.example.com", date(2024, 2, 5), True),
        ("bad", "block", None, date(2024, 2, 5), True),
        ("bad", "block", "late.org", None, True),
    ]
    captures = [
        (1, "http://spam.example.com/x", date(2024, 1, 9), "block", "example.com"),
        (2, "http://spam.example.com/x", date(2024, 1, 10), "block", "spam.example.com"),
        (3, "https://u@SPAM.example.com.:80/docs/a?b", date(2024, 2, 2), "allow", "spam.example.com/docs"),
        (4, "http://spam.example.com/x", date(2024, 2, 6), "allow", "spam.example.com"),
        (5, "http://spam.example.com/x", date(2024, 2, 6), "allow", "spam.example.com"),
        (6, "http://late.org/", date(2024, 2, 6), "none", None),
        (7, None, date(2024, 2, 6), "no_url", None),
        (8, "junk", date(2024, 2, 6), "no_url", None),
        (9, "http://example.com", None, "no_date", None),
    ]
    given = spark.createDataFrame([(*c[:3], "mine") for c in captures], "page_id bigint, url string, fetched date, verdict string")
    lists = spark.createDataFrame(entries, "list string, action string, key string, entry_date date, active boolean")
    for most in (200_000, 0):
        rows = {r["page_id"]: r for r in url_lists.judge(given, lists, most_broadcast=most).collect()}
        assert {k: (r["verdict"], r["listed_key"]) for k, r in rows.items()} == {c[0]: c[3:] for c in captures}
    assert {r["verdict"] for r in url_lists.judge(given, lists.limit(0)).collect()} == {"none", "no_url", "no_date"}
    assert url_lists.judge(given.limit(0), lists).count() == 0


def test_url_lists_keep_the_case_of_paths(spark):
    from datetime import date

    entries = [("bad", "block", " Example.COM/Docs/ ", date(2024, 1, 1), True), ("bad", "block", "org", date(2024, 1, 1), True)]
    lists = spark.createDataFrame(entries, "list string, action string, key string, entry_date date, active boolean")
    urls = ["http://example.com/Docs/a", "http://example.com/docs/a", "http://EXAMPLE.com//Docs", "http://example.com/Docs2", "http://a.b.ORG/x"]
    given = spark.createDataFrame([(u, date(2024, 2, 1)) for u in urls], "url string, fetched date")
    found = {r["url"]: r["verdict"] for r in url_lists.judge(given, lists).collect()}
    assert [found[u] for u in urls] == ["block", "none", "block", "none", "block"]


def test_url_lists_take_long_urls(spark):
    import time
    from datetime import date

    entries = [("bad", "block", "example.com/a/a/a", date(2024, 1, 1), True), ("bad", "block", "a.org", date(2024, 1, 1), True)]
    lists = spark.createDataFrame(entries, "list string, action string, key string, entry_date date, active boolean")
    urls = ["http://example.com" + "/a" * 100_000, "http://" + "a." * 100_000 + "org/"]
    given = spark.createDataFrame([(u, date(2024, 2, 1)) for u in urls], "url string, fetched date")
    url_lists.judge(given, lists).collect()
    start = time.perf_counter()
    assert {r["listed_key"] for r in url_lists.judge(given, lists).collect()} == {"example.com/a/a/a", "a.org"}
    assert time.perf_counter() - start < 20


def test_mixing(spark, docs, odd):
    rows = mixing.mix(docs).collect()
    sizes, taken, goal = Counter(), Counter(), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["repeats"] * r["size"] + r["tail_words"]
    left, weight = {}, {}
    for i, s in enumerate(sorted(sizes)):
        left[s], weight[s] = 0.0, (5, 2, 1)[i % 3]
    spare, open_ = 1.5 * sum(sizes.values()), set(sizes)
    while spare > 1e-6:  # the excess over the caps goes round until none is above
        share = {s: spare * weight[s] / sum(weight[x] for x in open_) for s in open_}
        spare = 0.0
        for s, x in share.items():
            left[s] += x
            if left[s] >= 2 * sizes[s]:
                spare += left[s] - 2 * sizes[s]
                left[s] = 2.0 * sizes[s]
                open_.discard(s)
    assert all(abs(left[s] - goal[s]) < 1e-3 and abs(taken[s] - goal[s]) <= 1 for s in sizes)
    again = mixing.mix(docs.repartition(5), most_broadcast=0).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in rows) == Counter((r["doc_id"], r["taken"]) for r in again)
    copies = mixing.mixed_rows(mixing.mix(docs), docs.columns)
    assert copies.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] == sum(taken.values())
    strange = mixing.mix(odd).collect()
    assert len(strange) == len(ROWS) and {r["size"] for r in strange if r["text"] is None} == {0}
    assert mixing.mix(odd.limit(0)).count() == 0


def plain_phrases(reference: str, text: str) -> int:
    """Longest matches of a lane's letters; a phrase counts when the next letter ends it."""
    count = 0
    for lane in (text[i : i + langid.LANE] for i in range(0, len(text), langid.LANE)):
        at = 0
        while at < len(lane):
            n = 0
            while at + n < len(lane) and lane[at : at + n + 1] in reference:
                n += 1
            count += at + n < len(lane) or n == 0
            at += max(1, n)
    return count


def test_cross_parsing_counts_longest_matches():
    reference = "der hund und die katze gehen in den wald"
    parser = langid.Parser({"de": reference})
    for text in ("die hunde gehen und gehen", "xyz", "der wald " * 90, "q"):
        folded = " ".join(langid.folded(text).split(" "))
        assert parser.phrases([text])[1][0, 0] == plain_phrases(reference, folded), text


def test_language_held_out(spark, docs, odd):
    rows = langid.identify(docs).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    known = langid.references(docs)
    blind = langid.identify(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s")), known).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in blind} == {r["doc_id"]: r["lang_pred"] for r in rows}
    strange = langid.identify(odd, known).collect()
    assert {r["doc_id"] for r in strange if r["lang_pred"] == "und"} == {3, 4, 5} and len(strange) == len(ROWS)
    assert langid.identify(odd.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, {}).collect()} == {"und"}


def test_references_collect_a_bounded_sample(spark, monkeypatch):
    """Of a number that comes 500 times, one text goes to the driver."""
    rows = [(1, f"text number {'abcdefghij'[i % 10]}", "en") for i in range(500)] + [(7, "ein anderer text", "de"), (1, None, "de")]
    given = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sizes, collect = [], type(given).collect

    def counted(self):
        found = collect(self)
        sizes.append(len(found))
        return found

    monkeypatch.setattr(type(given), "collect", counted)
    found = langid.references(given)
    assert found["en"].startswith(" text number j") and found["de"] == " ein anderer text"
    assert max(sizes) <= 2 * langid.REFERENCE_DOCS


def plain_links(rows):
    ok = {i: np.array(v, "f8") for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in ok.items()}
    return [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]


@pytest.mark.parametrize("block", [4, 2_048])
def test_near_vectors(spark, block):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[0] + 0.05 * rng.standard_normal(32)).tolist()) for i in range(25)]
    rows += [(200 + i, base[1].tolist()) for i in range(9)] + [(300, (base[2] * 7).tolist())]
    rows += [(400, None), (401, [0.0] * 32), (402, [float("nan")] + [1.0] * 31), (403, [None] + [1.0] * 31), (404, [])]
    rows += [(405, [1.0, 2.0]), (406, [1.0, 2.0, 0.0]), (407, [float("inf")] * 32)]
    given = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, n_links int")
    found = {r["vec_id"]: r for r in embeddings.near_vectors(given, block=block).collect()}
    stored = [(r["vec_id"], r["embedding"]) for r in given.collect()]
    links = plain_links(stored)
    degree = Counter(x for p in links for x in p)
    component = plain_components(links, [i for i, _ in rows])
    assert len(found) == len(rows)
    for i, r in found.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (degree[i], component[i], component[i] == i), i
    assert embeddings.near_vectors(given.limit(0)).count() == 0


@pytest.mark.parametrize("factor", [1.0, 1.1])
def test_vantage_point_trees(spark, sf_dir, factor):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    extra = [(-20, [1.0] * 64), (10_000, [0.0] * 64), (10_020, None), (10_040, [float("nan")] * 64), (-40, [1.0] * 64)]
    extra += [(i, [0.5] * 64) for i in range(20_001, 20_300)]
    table = table.union(spark.createDataFrame(extra, "vec_id bigint, embedding array<float>"))
    found = defaultdict(list)
    for r in vptree.nearest(table, 20, factor=factor, shard_rows=100).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found[r["query_id"]]) + 1
        found[r["query_id"]].append(r["vec_id"])
    rows = [r for r in table.collect() if r["embedding"] and np.isfinite(r["embedding"]).all() and any(r["embedding"])]
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], "f8")
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = np.einsum("ij,j->i", x, x[i])
        score[i] = -np.inf
        want = ids[np.lexsort((ids, -score))[:20]].tolist()
        total += 20
        hits += len(set(want) & set(found[ids[i]]))
        assert factor > 1 or sorted(want) == sorted(found[ids[i]])
    assert set(found) == {int(i) for i in ids if i % 20 == 0} and hits >= 0.95 * total
    few = vptree.nearest(table.where("vec_id in (0, 1, 2)"), 20).collect()
    assert [r["vec_id"] for r in sorted(few, key=lambda r: r["rank"])] in ([1, 2], [2, 1])
    assert vptree.nearest(table.limit(0), 20).count() == 0


@pytest.mark.parametrize("factor", [1.0, 1.1])
def test_vantage_point_tree_that_prunes(factor):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((60, 16))
    x = np.repeat(centres, 100, axis=0) + 0.02 * rng.standard_normal((6_000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree, scanned = vptree.Tree(np.arange(6_000), x, factor), []
    offer = tree._offer
    tree._offer = lambda rows, active: (scanned.append(len(rows) * len(active)), offer(rows, active))
    asked = np.arange(0, 6_000, 60)
    found, _ = tree.search(asked, x[asked], 20)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    want = np.argsort(-score, axis=1, kind="stable")[:, :20]
    hits = sum(len(set(a) & set(b)) for a, b in zip(found.tolist(), want.tolist()))
    assert hits == want.size if factor == 1 else hits >= 0.95 * want.size
    assert sum(scanned) < 0.6 * len(x) * len(asked)


def test_quality_held_out(spark, sf_dir, docs, odd):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")
    learn_from = labels.where("doc_id % 3 <> 0")
    model = quality.learn(docs, learn_from)
    judged = quality.classify(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = sum(r["keep"] == (r["quality"] == 1) for r in judged)
    assert right >= 0.95 * len(judged)
    plain = quality.classify(docs, model, most_broadcast=0)
    assert plain.where("keep").count() == quality.classify(docs, model).where("keep").count()
    strange = quality.classify(odd, model).collect()
    assert len(strange) == len(ROWS) and all(r["keep"] is not None for r in strange)
    assert quality.classify(odd.limit(0), model).count() == 0
    assert len(quality.learn(docs, labels.limit(0))) == len(model)


def test_quality_levels_shrink(spark):
    """A sparse path stays near its host, a full one near its own mean, and a document is not its own evidence."""
    rows = [(i, "Words of a text like any other.", "h", "full", 10.0) for i in range(200)]
    rows += [(300, "Words of a text like any other.", "h", "sparse", 1.0)]
    rows += [(400 + i, "### ### ###", "g", "full", 1.0) for i in range(50)] + [(500, "### ### ###", "h", "sparse", 1.0)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n double")
    model = quality.fit(np.array([[0.0] * 12, [0.6] + [0.0] * 11] * 10), np.array([True, False] * 10))
    found = {r["doc_id"]: r for r in quality.classify(given, model).collect()}
    assert found[0]["path_level"] > found[300]["path_level"] > found[400]["path_level"]
    assert found[500]["path_level"] > found[300]["path_level"]


def test_id_store_round_trip(spark, docs, odd):
    for table, rows in ((docs, [(r["doc_id"], r["text"]) for r in docs.collect()]), (odd, [r[:2] for r in ROWS])):
        path = shared_path(spark, "test-store")
        idstore.write_store(table, path, WORDS)
        found = idstore.read_store(spark, path).orderBy("start").collect()
        assert Counter((r["doc_id"], bytes(r["ids"])) for r in found) == Counter(
            (i, np.array(plain_ids(WORDS, t), "<u4").tobytes()) for i, t in rows
        )
        at = 0
        for r in found:
            assert r["start"] == at
            at += len(r["ids"]) // 4
        ids = [r["doc_id"] for r in found]
        assert ids == sorted(ids, key=lambda x: (x is not None, x))
        few = idstore.read_documents(spark, path, [4, 6]).collect()
        assert {(r["doc_id"], bytes(r["ids"])) for r in few} == {(r["doc_id"], bytes(r["ids"])) for r in found if r["doc_id"] in (4, 6)}
    path = shared_path(spark, "empty-store")
    idstore.write_store(odd.limit(0), path, WORDS)
    assert idstore.read_store(spark, path).count() == 0
