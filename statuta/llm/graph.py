"""Distributed union-find over a table of links, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every vertex of ``links``; component_id is the smallest id reachable.

    Rounds of randomised contraction: a vertex hooks onto the neighbour (or
    itself) with the smallest hash under the round's seed, the links are
    rewritten to the hooks, and loops and repeats go.  A chain of any order
    shrinks by a constant factor a round, so rounds grow with the logarithm of
    the longest path.  In every other round a vertex of one link hooks onto its
    neighbour whatever the hashes, so that a star of any size takes two rounds
    or three.  Every aggregation combines before its shuffle, so that a
    vertex with very many links costs one partial row a task; the joins are
    plain ones that adaptive execution may split.  Each round's tables are
    written to the shared folder, so a lost executor repeats one round at most.
    Null ends and loops are ignored; no links give no rows.
    """
    spark = links.sparkSession
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    edges = stored(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    hooks: list[DataFrame] = []
    while not edges.isEmpty():
        seed = len(hooks)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.min_by("v", F.xxhash64("v", F.lit(seed))).alias("v"), F.count("*").alias("degree"))
        # Two such vertices may swap places, which loses no path; the next round joins them.
        moves = F.xxhash64("v", F.lit(seed)) < F.xxhash64("u", F.lit(seed))
        moves = moves | (F.col("degree") == 1) if seed % 2 == 0 else moves
        hook = best.select("u", F.when(moves, F.col("v")).otherwise(F.col("u")).alias("p"))
        hook = stored(hook, "hooks")
        hooks.append(hook)
        left = edges.join(hook, "u").select(F.col("p").alias("u"), "v")
        moved = left.join(hook.select(F.col("u").alias("v"), "p"), "v").select("u", F.col("p").alias("v")).where("u <> v")
        moved = moved.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        old, edges = edges, stored(moved, "links")
        remove(spark, old)
    if not hooks:
        return edges.select(F.col("u").alias("id"), F.col("u").alias("component_id"))
    label = hooks[-1].select(F.col("u").alias("id"), F.col("p").alias("root"))
    for hook in reversed(hooks[:-1]):
        above = label.select(F.col("id").alias("p"), "root")
        label = hook.join(above, "p", "left").select(F.col("u").alias("id"), F.coalesce("root", "p").alias("root"))
    label = stored(label, "roots")
    smallest = label.groupBy("root").agg(F.min("id").alias("component_id"))
    # A root that hooks onto itself has a row of its own, so the smallest id covers it.
    return label.join(smallest, "root").select("id", "component_id")
