"""Connected components of a graph that is held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a long, b long).

    Large-star and small-star steps in turn until nothing changes; each halves the distances, and a hub's
    list is never gathered: both steps are a minimum per node and a join on it. Nodes without an
    edge don't appear. An empty table gives an empty one.
    """
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    pairs = materialize(both, "edges")
    last = None
    for _ in range(60):
        # large-star: every larger neighbour of a node goes to the smallest of the node and its neighbours
        sym = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: every smaller neighbour, and the node itself, to the smallest of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        pairs = materialize(small, "edges")
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last or not now[0]:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
