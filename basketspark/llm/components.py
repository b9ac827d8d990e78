"""Connected components by label exchange along edges and pointer jumping.

Every round is a few joins and aggregations on written tables: nothing is collected but one
count per round, and the rounds grow with the logarithm of the longest path. The edges' own
joins are keyed by nodes of small degree if the caller links each node to few others; the
jump's join is keyed by the present roots, a plain join that Spark can split when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.text import pinned


MAX_ROUNDS = 60


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, root): root is the smallest node reachable. Only nodes with an edge appear.

    Null ends and self-links are ignored; repeated and reversed edges are the same link.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a != b")
    # Both directions from one row, so that the edges are worked out once.
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("w")
    e = pinned(e.select(ways).select("w.*").distinct(), "links")
    labels = pinned(e.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    for _ in range(MAX_ROUNDS):
        seen = labels.select(F.col("node").alias("b"), "root")
        near = e.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        # A node tells its own root, too, of a smaller label next to it.
        told = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("near"))
        offers = told.select(F.explode(F.array(F.struct("node", "near"), F.struct(F.col("root").alias("node"), "near"))).alias("o"))
        hooked = pinned(offers.groupBy("o.node").agg(F.min("o.near").alias("root")), "hooked")
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = hooked.join(up, "root").select("node", F.col("next").alias("root"))
        was = labels.select("node", F.col("root").alias("was"))
        labels = pinned(jumped.join(was, "node").select("node", "root", (F.col("root") != F.col("was")).alias("moved")), "labels")
        moved = labels.where("moved").limit(1).count()
        labels = labels.select("node", "root")
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
