"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a minimum per node (pre-aggregated before the shuffle) and a join of the
edges with it, so a node with a third of all edges costs no task more than a join that
the engine may split.  Each round is written to the shared folder; the number of rounds
grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievecraft.llm.common import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (columns a and b): the smallest node within reach."""
    # Stars point from a node to a smaller one: (node, to).
    stars = edges.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct()
    stars = materialise(stars, "stars")
    state = None
    while True:
        both = stars.unionByName(stars.select(F.col("to").alias("node"), F.col("node").alias("to")))
        least = both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("least"))
        # Large star: larger neighbours move to the least neighbour.
        large = both.filter("to > node").join(least, "node").select(F.col("to").alias("node"), F.col("least").alias("to")).distinct()
        lowest = large.groupBy("node").agg(F.min("to").alias("least"))
        # Small star: smaller neighbours and the node itself do.
        small = large.join(lowest, "node")
        moved = small.filter("to <> least").select(F.col("to").alias("node"), F.col("least").alias("to"))
        before, stars = stars, materialise(moved.unionByName(lowest.select("node", F.col("least").alias("to"))).filter("node <> to").distinct(), "stars")
        discard(before)
        now = stars.agg(F.count("*"), F.sum(F.hash("node", "to")), F.bit_xor(F.xxhash64("node", "to"))).first()
        if now == state:
            break
        state = now
    ends = stars.select(F.col("to").alias("node"), F.col("to").alias("component")).distinct()
    return stars.select("node", F.col("to").alias("component")).unionByName(ends)
