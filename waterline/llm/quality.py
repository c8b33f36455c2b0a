"""Quality classifier with hierarchical empirical Bayes.

A logistic model gives each document evidence of its own. Documents of one host, and of one path of a host, share a level
of quality: its posterior mean is what the documents there show, shrunk toward the host and toward all documents. How far
follows from the variances within and between sites (one-way random effects), so a sparse site stays near the prior.
A document's own evidence is taken out of its site's before the two are combined.

The levels need one grouped sum over all documents, which combines before the shuffle.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.llm.store import materialize

#: Labelled documents the logistic model is fitted on, at most: those with the least hash of their id.
FIT_ROWS = 20_000
#: Documents below this posterior are rejected.
THRESHOLD = 0.5
RIDGE = 1e-3
#: Site levels are sent to all executors up to this many paths, and joined by shuffle beyond.
MOST_BROADCAST = 200_000
SALTS = 16


def with_counts(docs: DataFrame) -> DataFrame:
    """Counts of a text's kinds of characters and words, each made once; a null text is an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    chars = F.char_length(text)
    # What is gone without the kind; whole runs go at a time.
    kind = lambda run: (chars - F.char_length(F.regexp_replace(text, run, ""))).cast("double")
    return docs.withColumns(
        {
            "__chars": chars.cast("double"),
            "__letters": kind(r"\p{L}+"),
            "__capitals": kind(r"\p{Lu}+"),
            "__symbols": kind(r"[^\p{L}\p{N}\s.,;:'()-]+"),
            "__digits": kind(r"\p{N}+"),
            "__breaks": (chars - F.char_length(F.replace(text, F.lit("\n"), F.lit("")))).cast("double"),
            "__words": F.split(text, r"\s+"),
        }
    ).withColumns(
        {
            "__count": F.size("__words").cast("double"),
            "__distinct": F.size(F.array_distinct("__words")).cast("double"),
        }
    )


COUNTS = ("__chars", "__letters", "__capitals", "__symbols", "__digits", "__breaks", "__words", "__count", "__distinct")


def features() -> list[Column]:
    """What the model sees of a text, from its counts, as doubles."""
    share = lambda n, of: F.col(n) / F.greatest(F.col(of), F.lit(1.0))
    distinct = share("__distinct", "__count")
    raw = [
        share("__symbols", "__chars"),
        share("__capitals", "__letters"),
        share("__digits", "__chars"),
        share("__letters", "__chars"),
        F.log1p("__count"),
        distinct,
        # Long texts repeat words anyway; this compares with what their length lets expect.
        distinct * F.log1p("__count"),
        share("__letters", "__count") / 10,
        share("__breaks", "__count"),
    ]
    return raw + [F.sqrt(raw[i]) for i in (0, 1, 2)]


def fit(samples: np.ndarray, good: np.ndarray, rounds: int = 30) -> list[float]:
    """Weights of a ridge logistic model on standardised features, folded into weights on raw ones; the intercept first."""
    x, y = np.asarray(samples, "f8"), np.asarray(good, "f8")
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return [math.log(rate / (1 - rate))] + [0.0] * x.shape[1]
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-9] = 1.0
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(z.shape[1])
    penalty = RIDGE * len(y) * np.eye(len(w))
    penalty[0, 0] = 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    weights = w[1:] / spread
    return [float(w[0] - weights @ mean), *weights.tolist()]


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> list[float]:
    """Fit on a bounded sample of labelled documents. A document's label is the mean of its labels, at least one half."""
    named = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("good"))
    # At most `rows` ids, so safe to send to all executors.
    sample = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    seen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = with_counts(seen).select("doc_id", "good", F.array(*features()).alias("x")).collect()
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    width = len(features())
    return fit(np.array([r["x"] for r in found]).reshape(-1, width), np.array([r["good"] >= 0.5 for r in found]))


def _site_levels(scored: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Sums of each path and its host, and the shrinkage: prior mean, and what a host and a path must weigh against it."""
    paths = scored.groupBy("__host", "__path").agg(
        F.count("*").alias("__n"), F.sum("__p").alias("__s"), F.sum(F.col("__p") * F.col("__p")).alias("__q")
    )
    paths = materialize(paths, "paths")
    hosts = paths.groupBy(F.col("__host").alias("__h")).agg(
        F.sum("__n").alias("__hn"), F.sum("__s").alias("__hs"), F.sum("__q").alias("__hq")
    )
    hosts = materialize(hosts, "hosts")
    every = hosts.agg(
        F.sum("__hn").alias("n"),
        F.sum("__hs").alias("s"),
        F.sum("__hq").alias("q"),
        F.count("*").alias("groups"),
        F.sum(F.col("__hs") * F.col("__hs") / F.col("__hn")).alias("between"),
        F.sum(F.col("__hn").cast("double") * F.col("__hn")).alias("squares"),
    ).first()
    both = paths.join(hosts, F.col("__host").eqNullSafe(F.col("__h"))).drop("__h", "__q", "__hq")
    inner = both.agg(
        F.count("*").alias("groups"),
        F.sum(F.col("__s") * F.col("__s") / F.col("__n")).alias("between"),
        F.sum(F.col("__n").cast("double") * F.col("__n") / F.col("__hn")).alias("squares"),
    ).first()
    n = float(every["n"] or 0)
    mean = every["s"] / n if n else 0.5

    def weight(within: float, within_df: float, between: float, between_df: float, size: float) -> float:
        """Prior documents: variance within sites over variance between them."""
        noise = max(within / max(within_df, 1.0), 1e-12)
        spread = (between - between_df * noise) / max(size, 1.0)
        return float(min(1e9, noise / spread)) if spread > 0 else 1e9

    if not n:
        return both, {"mean": mean, "host": 1e9, "path": 1e9}
    return both, {
        "mean": mean,
        "host": weight(
            every["q"] - every["between"],
            n - every["groups"],
            every["between"] - every["s"] ** 2 / n,
            every["groups"] - 1,
            n - every["squares"] / n,
        ),
        "path": weight(
            every["q"] - inner["between"],
            n - inner["groups"],
            inner["between"] - every["between"],
            inner["groups"] - every["groups"],
            n - inner["squares"],
        ),
    }


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def classify(
    docs: DataFrame,
    model: list[float],
    host: str = "source",
    path: str = "lang",
    threshold: float = THRESHOLD,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """All rows of docs (text, host, path, ...) with evidence, host_level, path_level, quality_score and keep.

    evidence: the document's own probability of being good. host_level, path_level: posterior means without the document.
    quality_score: the evidence moved by how its path's level differs from the mean of all documents. keep: the score
    reaches the threshold.

    A null text is judged as an empty one; a null host or path is one of its own. Repeated rows count and stay. Columns
    with the names of the results are replaced. An empty table gives no rows. Texts are not shuffled while there are at
    most `most_broadcast` paths.
    """
    results = ("evidence", "host_level", "path_level", "quality_score", "keep")
    docs = docs.drop(*results)
    line = sum((F.lit(w) * x for w, x in zip(model[1:], features())), F.lit(model[0]))
    scored = with_counts(docs).withColumn("__p", 1 / (1 + F.exp(-F.least(F.greatest(line, F.lit(-30.0)), F.lit(30.0))))).drop(*COUNTS)
    scored = scored.withColumn("__host", F.col(host).cast("string")).withColumn("__path", F.col(path).cast("string"))
    sites, prior = _site_levels(scored.select("__host", "__path", "__p"))
    sites = sites.withColumnsRenamed({"__host": "__h", "__path": "__k"})
    at = F.col("__host").eqNullSafe(F.col("__h")) & F.col("__path").eqNullSafe(F.col("__k"))
    if sites.count() <= most_broadcast:
        joined = scored.join(F.broadcast(sites), at)
    else:
        # A path may hold a third of all rows: both sides are salted.
        sites = sites.withColumn("__t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = scored.withColumn("__salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
        joined = salted.join(sites, at & (F.col("__salt") == F.col("__t")))
    mean, by_host, by_path = (F.lit(prior[x]) for x in ("mean", "host", "path"))
    p = F.col("__p")
    host_level = (F.col("__hs") - p + by_host * mean) / (F.col("__hn") - 1 + by_host)
    path_level = (F.col("__s") - p + by_path * F.col("host_level")) / (F.col("__n") - 1 + by_path)
    moved = _logit(p) + _logit(F.col("path_level")) - _logit(mean)
    return joined.withColumn("host_level", host_level).withColumn("path_level", path_level).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        p.alias("evidence"),
        "host_level",
        "path_level",
        (1 / (1 + F.exp(-moved))).alias("quality_score"),
        (1 / (1 + F.exp(-moved)) >= threshold).alias("keep"),
    )


def op8_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, learn(docs, labels)).drop("text")
