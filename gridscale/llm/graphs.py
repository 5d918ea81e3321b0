"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.llm.text import stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) can reach.

    Two kinds of rounds take turns: every node hands its larger neighbours, then its smaller ones, the smallest node it
    knows. Each halves the paths at least, whatever their shape, and edges never grow in number.
    Every round's edges are written down, so no lineage builds up.
    """
    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        if larger:
            own = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            own = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = own.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        joined = own.join(least, "a")
        if larger:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
        return out.where("a <> b").distinct()

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    pairs = stored(edges.select("a", "b").where("a <> b").distinct())
    before = state(pairs)
    for _ in range(max_rounds):
        pairs = stored(star(stored(star(pairs, True)), False))
        after = state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
