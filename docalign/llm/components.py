"""Connected components by alternating stars, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docalign.llm.common import Stash


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbor of each node ``u``; a partial minimum comes before the exchange."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, stash: Stash) -> DataFrame:
    """Rows ``node, root`` for all nodes of ``edges(u, v)``; the root is the component's smallest node.

    Each round links every node's larger neighbors to its smallest one (large star), then
    its smaller neighbors and itself (small star), until nothing changes. Rounds grow with
    the logarithm of the number of nodes, not with the length of a chain.
    """
    now = stash.save(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where(F.col("v") > F.col("u"))
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        down = stash.save(large, "large")
        small = down.join(_least(down), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(_least(down).select("u", F.col("m").alias("v"))).distinct()
        after = stash.save(small, "small")
        stash.drop(now, down)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
