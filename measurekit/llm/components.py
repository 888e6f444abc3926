"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored

#: Passes after which something must be wrong: the number of passes grows with the logarithm of a component's length.
MAX_PASSES = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Large-star and small-star passes: each connects the neighbours of a node to the smallest of them, until every node hangs on
    its component's smallest. Minima are folded before the shuffle and joined back, so a node with very
    many neighbours is split like any skewed join. Each pass is stored in the shared folder. Edges with a null end
    are left out; an edge from a node to itself makes the node known.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    found = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    nodes = found.select(F.col("u").alias("node")).union(found.select("v")).distinct()
    now = found.where("u <> v")
    seen = None
    for _ in range(MAX_PASSES):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours go to the smallest node around
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the node and its smaller neighbours go to the smallest of those
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = stored(moved.distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(now.select(F.col("u").alias("node"), "v"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))
