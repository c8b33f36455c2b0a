"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns documents; the last returns pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.llm.langid import identify, random_bits, references
from waterline.llm.mixing import mix, mixed_rows
from waterline.llm.packing import digest, pack
from waterline.llm.quality import classify, learn
from waterline.llm.simhash import one_of_each

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose posterior quality reaches one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, learn(docs, labels)).where("keep").select(*DOCUMENTS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that was learnt: not those without letters, nor those that no language fits, as they
    need as many bits per letter as random letters of the language found.
    """
    known = references(docs)
    found = identify(docs, known)
    kept = F.lit(False)
    for lang, text in known.items():
        kept |= (F.col("lang_pred") == lang) & (F.col("bits") < random_bits(text))
    return found.where(kept).select(*DOCUMENTS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash near-duplicates (four-word shingles, 4 of 64 bits)."""
    return one_of_each(docs).select(*DOCUMENTS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by target weight; a document comes as often as the mix takes it."""
    return mixed_rows(mix(docs), DOCUMENTS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a training sequence."""
    import public_tokenizers

    return digest(pack(docs, public_tokenizers.path("byte_bpe_50k.json")))
