"""Connected components of links between long ids, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow.llm.common import drop_stored, store

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead.

    Also returns the stored table that the result reads.
    """
    both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("node", "next")
    least = store(
        both.groupBy("node").agg(F.least(F.min("node"), F.min("next")).alias("least")), "least"
    )
    linked = both.where("next > node").join(least, "node")
    return linked.select(F.col("next").alias("u"), F.col("least").alias("v")), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour.

    Also returns the stored table that the result reads.
    """
    down = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("next"))
    least = store(down.groupBy("node").agg(F.min("next").alias("least")), "least")
    moved = down.join(least, "node").where("next != least")
    linked = moved.select(F.col("next").alias("u"), F.col("least").alias("v"))
    return linked.union(least.select(F.col("node"), F.col("least"))).distinct(), least


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.max("u"), F.min("v")
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node but the roots; the root is its component's smallest node.

    ``edges`` has long columns ``u`` and ``v``; nulls and links of a node with itself are ignored.
    Each round is written to the shared folder, so a lost executor costs only its tasks. A node with
    very many links is reduced by partial aggregation; the results are stored before they are joined
    back, so that both sides are plain shuffles, whose hot partitions adaptive execution splits.
    """
    current = store(edges.where("u != v").distinct(), "links")
    mark = _mark(current)
    for _ in range(MAX_ROUNDS):
        if mark[0] == 0:
            break
        large, large_least = _large_star(current)
        small, small_least = _small_star(large)
        following = store(small, "links")
        now = _mark(following)
        drop_stored(current, large_least, small_least)
        current = following
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
