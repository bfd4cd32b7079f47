"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.storage import cut


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """``pairs (u, v)`` with the smallest neighbour of each ``u``, itself included, as ``m``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return pairs.join(least, F.col("u") == F.col("w")).drop("w")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the smallest node names it.

    Large-star and small-star steps (each node hands its larger, then its smaller neighbours to
    its smallest one) take turns until nothing changes. Every step is written, so that its plan
    does not grow, and edges only ever get fewer.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b")
                                             .alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        small = _to_smallest(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        small = small.select(F.inline(F.expr(
            "array(named_struct('u', v, 'v', m), named_struct('u', u, 'v', m))")))
        edges = cut(small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
