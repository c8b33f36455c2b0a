"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

Rows fall into source partitions by a hash. How many rows of each partition go to each shard is drawn once, from
the counts alone, as a uniform permutation of all rows would distribute them. Every partition then permutes
its own rows and deals them out by its line of the matrix, and every shard permutes what it has received.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that one task permutes, on average.
ROWS_PER_TASK = 500_000
#: Source partitions, at least.
LEAST_PARTITIONS = 48


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among draws without replacement from good + bad, for counts of any size.

    Inverts the distribution around its mode, by the ratios of neighbouring probabilities. Beyond 40 standard
    deviations the probabilities are zero in double precision.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low >= high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1)))
    reach = int(40 * spread) + 40
    up = np.arange(mode, min(high, mode + reach), dtype="f8")
    down = np.arange(mode, max(low, mode - reach), -1, dtype="f8")
    rise = np.log((good - up) * (draws - up)) - np.log((up + 1) * (bad - draws + up + 1))
    fall = np.log(down * (bad - draws + down)) - np.log((good - down + 1) * (draws - down + 1))
    logs = np.concatenate([np.cumsum(fall)[::-1], [0.0], np.cumsum(rise)])
    sums = np.cumsum(np.exp(logs))
    at = int(np.searchsorted(sums, rng.random() * sums[-1], side="right"))
    return mode - len(down) + min(at, len(logs) - 1)


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows from each partition (line) to each shard (column); lines sum to counts, columns to sizes."""
    rng = np.random.default_rng(seed)
    left, lines = list(sizes), []
    for n in counts:
        line, rest, pool = [], n, sum(left)
        for k in range(len(left)):
            pool -= left[k]
            x = hypergeometric(rng, left[k], pool, rest)
            line.append(x)
            rest -= x
        left = [a - b for a, b in zip(left, line)]
        lines.append(line)
    return lines


def _salted(seed: int, use: str, key: Column) -> Column:
    return F.xxhash64(F.lit(f"{use}:{seed}"), key)


def shard(
    df: DataFrame, shards: int, seed: int = 0, key: list[str] | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add `shard` (0 to shards - 1, counts at most one apart) and `slot` (place in the shard, gapless from 0).

    key: columns that tell rows apart; all columns by default. Rows that agree in the key are interchangeable: any of
    them may take any of their places, and they share a source partition. Nulls are values like others.
    A column of the input named shard or slot is replaced. An empty table gives no rows. Texts are neither
    read to draw the matrix nor moved more than twice. Runs agree.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    names = key or df.columns
    hashed = df.withColumn("__key", F.xxhash64(*[F.col(f"`{c}`") for c in names]))
    total = df.count()
    if not total:
        return df.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("bigint"))
    partitions = max(LEAST_PARTITIONS, -(-total // rows_per_task))
    blocks = max(1, -(-total // (shards * rows_per_task)))
    hashed = hashed.withColumn("__part", F.pmod(_salted(seed, "part", F.col("__key")), F.lit(partitions)).cast("int"))
    # As many counts as there are source partitions: a number that follows the tasks, not the rows.
    counts = {r["__part"]: r["count"] for r in hashed.groupBy("__part").count().collect()}
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    parts = sorted(counts)
    matrix = communication_matrix([counts[p] for p in parts], sizes, seed)
    upto = [[int(x) for x in np.cumsum(line)] for line in matrix]
    lines = spark.createDataFrame(list(zip(parts, upto)), "__line int, __upto array<bigint>")

    # Permute locally, then deal out by the matrix: a row's shard is the first whose share reaches its place.
    place = F.row_number().over(Window.partitionBy("__part").orderBy(_salted(seed, "local", F.col("__key")), "__key"))
    dealt = (
        hashed.withColumn("__place", place)
        .join(F.broadcast(lines), F.col("__part") == F.col("__line"))
        .withColumn("shard", F.size(F.filter("__upto", lambda x: x < F.col("__place"))).cast("int"))
        .withColumn("__block", F.pmod(_salted(seed, "block", F.col("__key")), F.lit(blocks)).cast("int"))
        .drop("__line", "__upto", "__place", "__part")
    )
    # Permute again: rows of a shard fall into blocks at random, and each block is ordered at random.
    again = Window.partitionBy("shard", "__block").orderBy(_salted(seed, "again", F.col("__key")), "__key")
    slots = dealt.withColumn("slot", F.row_number().over(again).cast("bigint") - 1)
    if blocks > 1:
        held = dealt.groupBy("shard", "__block").count()
        before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        held = held.withColumn("__base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
        # A row for each task of the second exchange.
        slots = slots.join(F.broadcast(held), ["shard", "__block"]).withColumn("slot", F.col("slot") + F.col("__base"))
    return slots.select(*[F.col(f"`{c}`") for c in df.columns], "shard", "slot")


def op2_shard_hypergeometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    placed = shard(docs, 24, seed=2)
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))
