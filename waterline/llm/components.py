"""Connected components of a link table, in rounds of joins.

Alternates the large-star and small-star steps of Kiveris et al., "Connected Components in MapReduce and Beyond"
(2014): every node links its neighbours to the least of them, until all links point to the least node of their
component. The number of rounds grows with the logarithm of the longest path. A node with a third of all links costs
a minimum, which combines before the shuffle, and a join, whose skew adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm.store import materialize


def _with_least(links: DataFrame, at: str, other: str) -> DataFrame:
    """Links with `least`: the least of `at` and all its `other`s."""
    least = links.groupBy(F.col(at).alias("__at")).agg(F.min(other).alias("least"))
    joined = links.join(least, F.col(at) == F.col("__at")).drop("__at")
    return joined.withColumn("least", F.least("least", at))


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of links (a, b); the component is its least node.

    Nodes may be of any ordered type. Repeated links and links of a node to itself do no harm; links with a null
    end are ignored; an empty table gives no rows. Each round is written to the shared folder.
    """
    kept = materialize(links.select("a", "b").where("a is not null and b is not null").distinct(), "links")
    ends = kept.select(F.col("a").alias("node")).union(kept.select(F.col("b").alias("node"))).distinct()
    # Each link once, from the larger to the smaller end.
    edges = materialize(
        kept.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = _with_least(large.where("a <> b").distinct(), "a", "b")
        # The neighbours of a node, and the node itself, link to the least of them.
        stars = small.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            small.select("a", F.col("least").alias("b"))
        )
        edges = materialize(stars.where("a <> b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"links did not settle in {most_rounds} rounds")
    root = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return ends.join(root, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
