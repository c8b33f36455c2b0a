"""Mixing of sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Targets need one row per source. Which documents get one repetition more is a cut through the documents of a source in
a seeded order. The order is split into 256 ranges by its first digits: whole ranges before and after the cut
are settled by their sums, and only the range that holds the cut is sorted. A hot source is no larger a task than that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waterline.llm.store import materialize

WEIGHTS = (5, 2, 1)
#: Words to take, as a share of all words, and repetitions at most.
SHARE = 1.5
EPOCHS = 2
SEED = 5
WORD = r"[^\x20\x09-\x0D]+"
#: Range sums are sent to all executors up to this many rows (256 for each source), and joined by shuffle beyond.
MOST_BROADCAST = 200_000


def targets(sums: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) of (source, source_size): a source's words to take.

    Sources by code point, null last, take the weights in turn. All share `share` of all words by weight; a source stops at
    `epochs` times its words, and what it can't take goes to the others by weight until none is above. One row
    for each source goes through one task.
    """
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    of_turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    capped = sums.withColumn("weight", of_turn).withColumn("cap", F.col("source_size") * float(epochs))
    # By the level at which a source is full: what is left for the others, and the weights that share it.
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    total = F.sum("source_size").over(everything) * float(share)
    full = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = capped.withColumn("level", (total - full) / open_weight)
    settled = F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(everything)
    filled = level.withColumn("settled", settled)
    target = F.coalesce(F.least(F.col("cap"), F.col("settled") * F.col("weight")), F.col("cap"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """All rows of docs (doc_id, text, source, ...) with size, source_size, target, taken, repeats and tail_words.

    size: words of the text (null: 0). taken: words the mix takes of the row, its `repeats` whole copies and the first
    `tail_words` of one copy more, which at most one row of a source has. The words taken of a source are its target,
    rounded; no row gives more than `epochs` times its size. A null source is a source. A null doc_id is an id;
    rows that agree in doc_id and size are interchangeable. An empty table gives no rows. Input columns with the names
    of the results are replaced. Runs agree.
    """
    added = ("size", "source_size", "target", "taken", "repeats", "tail_words")
    docs = docs.drop(*added)
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = (
        docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"))
        .withColumn("__place", place)
        .withColumn("__range", F.substring("__place", 1, 2))
    )
    ranges = materialize(sized.groupBy("source", "__range").agg(F.sum("size").alias("__words")), "ranges")
    sums = ranges.groupBy("source").agg(F.sum("__words").alias("source_size"))
    goals = targets(sums, weights, share, epochs).withColumn("__goal", F.round("target").cast("bigint"))
    whole = F.when(F.col("source_size") > 0, F.expr("__goal div source_size")).otherwise(F.lit(0))
    goals = goals.withColumn("__whole", whole.cast("int"))
    goals = goals.withColumn("__more", F.col("__goal") - F.col("__whole") * F.col("source_size")).drop("__goal")
    before = Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    table = ranges.withColumn("__before", F.coalesce(F.sum("__words").over(before), F.lit(0)))
    table = table.join(goals.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    # What the range may still take beyond whole repetitions.
    table = table.withColumn("__left", F.least(F.greatest(F.col("__more") - F.col("__before"), F.lit(0)), "__words"))
    table = table.drop("__before", "__more").withColumnsRenamed({"source": "__source", "__range": "__r"})
    table = materialize(table, "range-goals")
    if table.count() <= most_broadcast:
        table = F.broadcast(table)
    joined = sized.join(table, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__range") == F.col("__r")))
    cut = (F.col("__left") > 0) & (F.col("__left") < F.col("__words"))
    settled = joined.where(~cut).withColumn("__extra", F.when(F.col("__left") > 0, F.col("size")).otherwise(F.lit(0)))
    order = Window.partitionBy("__source", "__r").orderBy("__place", "size")
    used = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sorted_cut = joined.where(cut).withColumn("__used", used)
    sorted_cut = sorted_cut.withColumn("__extra", F.least(F.greatest(F.col("__left") - F.col("__used"), F.lit(0)), "size"))
    both = settled.unionByName(sorted_cut.drop("__used")).withColumn("__extra", F.col("__extra").cast("bigint"))
    complete = (F.col("__extra") == F.col("size")) & ((F.col("__extra") > 0) | (F.col("__left") > 0))
    return both.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "size",
        "source_size",
        "target",
        (F.col("__whole") * F.col("size") + F.col("__extra")).alias("taken"),
        (F.col("__whole") + F.when(complete, 1).otherwise(0)).cast("int").alias("repeats"),
        F.when(complete, 0).otherwise(F.col("__extra")).cast("bigint").alias("tail_words"),
    )


def mixed_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that a mix takes, each as often as it is taken; a tail's text is its first words, joined by spaces."""
    copies = F.concat(
        F.array_repeat(F.lit(0).cast("bigint"), F.col("repeats")),
        F.when(F.col("tail_words") > 0, F.array(F.col("tail_words"))).otherwise(F.array().cast("array<bigint>")),
    )
    rows = mixed.withColumn("__tail", F.explode(copies))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    text = F.when(F.col("__tail") > 0, F.array_join(F.slice(words, F.lit(1), F.col("__tail").cast("int")), " "))
    rows = rows.withColumn("text", F.coalesce(text, F.col("text")))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__tail") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("bigint"))
    return rows.select(*columns)


def op5_mix_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = rf"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
           md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS place
    FROM documents
), sums AS (
    SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * {float(EPOCHS)} AS cap,
           [{', '.join(f'{float(w)}' for w in WEIGHTS)}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE * {SHARE}
               - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
              / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sums
), goals AS (
    SELECT source, source_size, coalesce(least(cap, max(CASE WHEN cap / weight >= level THEN level END) OVER () * weight), cap) AS target
    FROM levels
), more AS (
    SELECT *, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS whole FROM goals
), placed AS (
    SELECT d.doc_id, d.size, m.source_size, m.target, m.whole, round(m.target)::BIGINT - m.whole * m.source_size AS extra,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
    FROM sized d JOIN more m ON d.source IS NOT DISTINCT FROM m.source
)
SELECT doc_id, size, source_size, target, (whole * size + least(greatest(extra - used, 0), size))::BIGINT AS taken FROM placed
"""
