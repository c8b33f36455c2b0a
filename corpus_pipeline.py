"""From documents to training sequences: quality, language, near-duplicates, mixing, packing.

Every stage is written as Parquet to the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waterline.llm import stages
from waterline.llm.store import shared_path

STAGES = [
    ("quality classifier", stages.quality),
    ("language identification", stages.language),
    ("SimHash near-duplicates", stages.near_duplicate),
    ("mixing to target weights", stages.mixing),
    ("packing", stages.packing),
]

#: Classifier, automata, fingerprints and tokenizer can't be said in SQL; tests/llm checks the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
