"""The corpus pipeline, stage by stage, and the queries that have SQL."""

import random
import re

import duckdb

import __spark_entry__
import corpus_pipeline
from waterline.llm import langid, simhash, stages
from waterline.llm.queries import ORACLES, QUERIES


def test_stages_filter_and_keep(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = stages.quality(spark, docs, sf_dir)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns
    assert sum((i in ids) == bool(q) for i, q in labels.items()) >= 0.95 * len(labels)
    spoken = stages.language(spark, docs, sf_dir)
    assert spoken.columns == docs.columns
    odd = docs.limit(1).selectExpr("doc_id", "'12 34 !!' as text", "lang", "source", "n_chars")
    found = langid.identify(docs.union(odd))
    assert found.where("lang_pred = 'und'").count() == 1
    assert spoken.count() >= 0.98 * docs.count()
    single = stages.near_duplicate(spark, docs.union(docs), sf_dir)
    assert single.columns == docs.columns
    from waterline.llm.simhash import near_duplicates

    groups = near_duplicates(docs).collect()
    assert {r["doc_id"] for r in single.collect()} == {r["component_id"] for r in groups}
    assert single.count() == len({r["component_id"] for r in groups})
    mixed = stages.mixing(spark, docs, sf_dir)
    assert mixed.columns == docs.columns and mixed.count() > docs.count()


def test_run_is_registered_and_packs(spark, sf_dir):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert set(QUERIES) <= set(__spark_entry__.queries())
    rows = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_language_of_many_letters_stays(spark, sf_dir):
    """A language of 1,500 letters needs more than log2(26) bits a letter; random letters of it still go."""
    rng = random.Random(6)
    letters = [chr(0x4E00 + 7 * i) for i in range(1_500)]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 2))) for _ in range(2_500)]
    often = [1 / (i + 3) for i in range(len(words))]
    texts = ["".join(rng.choices(words, often, k=500)) for _ in range(60)]
    texts += ["".join(rng.choices(letters, k=700)) for _ in range(5)]
    rows = [(10_000 + i, x, "zh" if i < 60 else None, "s", len(x)) for i, x in enumerate(texts)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema)).coalesce(1)
    bits = [r["bits"] for r in langid.identify(docs).where("lang = 'zh' and held_out").collect()]
    assert bits and min(bits) > 4.71
    kept = {r["doc_id"] for r in stages.language(spark, docs, sf_dir).collect()}
    assert kept >= set(range(10_000, 10_060)) and not kept & set(range(10_060, 10_065))


def test_one_document_of_each_group_of_fingerprints(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in docs.collect()}
    ids = sorted(prints)
    kept, seen = set(), set()
    for first in ids:
        if first in seen:
            continue
        kept.add(first)
        front = [first]
        seen.add(first)
        while front:
            a = prints[front.pop()]
            near = [i for i in ids if i not in seen and (a ^ prints[i]).bit_count() <= 4]
            seen.update(near)
            front += near
    stage = dict(corpus_pipeline.STAGES)["SimHash near-duplicates"]
    found = stage(spark, docs, sf_dir)
    assert found.columns == docs.columns
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(kept)


def test_one_row_of_each_group_where_numbers_repeat(spark, sf_dir):
    """Exact copies without a number, and a copy that shares its number with a unique text."""
    same = " ".join(f"word{i}" for i in range(60))
    rows = [(None, same), (None, same), (5, same), (5, "a text of its own"), (5, same), (3, same.upper() + " ")]
    rows += [(None, "only this one"), (None, "only this one"), (None, None), (9, " ")]
    given = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], spark.read.parquet(f"{sf_dir}/documents.parquet").schema)
    stage = dict(corpus_pipeline.STAGES)["SimHash near-duplicates"]
    found = sorted((str(r["doc_id"]), r["text"]) for r in stage(spark, given, sf_dir).collect())
    assert found == sorted([("3", same.upper() + " "), ("5", "a text of its own"), ("None", "only this one"), ("9", " ")])


def test_stage_does_not_broadcast_copies_of_classes(spark, sf_dir):
    """Spark sizes an explode as its input, so it took 32 copies of each class for a small table."""
    given = [(i, f"text number {i} of some words", "en", "s", 20) for i in range(50)]
    docs = spark.createDataFrame(given, spark.read.parquet(f"{sf_dir}/documents.parquet").schema)
    found = dict(corpus_pipeline.STAGES)["SimHash near-duplicates"](spark, docs, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1
    assert re.findall(r"(\w+Join) \[.*__salt", plan) == ["SortMergeJoin"]
    assert found.count() == len(given)


def test_queries_agree_with_sql(spark, sf_dir):
    with duckdb.connect() as db:
        for table in ("documents", "pages"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        for name, sql in ORACLES.items():
            want = db.execute(sql).fetchall()
            columns = [d[0] for d in db.description]
            got = [tuple(r) for r in QUERIES[name](spark, sf_dir).select(*columns).collect()]
            plain = lambda rows: sorted(str([getattr(x, "date", lambda x=x: x)() if hasattr(x, "hour") else x for x in r]) for r in rows)
            assert plain(got) == plain(want), name
