"""Connected components of links, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hearthlog.llm.worker import park

_MAX_ROUNDS = 60


def _to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Point the neighbours of every node, and the node, to the least among them.

    With ``larger_only`` only larger neighbours are pointed anew (a large star), else only
    smaller ones are looked at (a small star). The least are parked before they are
    joined: a node with most links is then a skewed join that Spark splits, behind a
    partial minimum.
    """
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    if larger_only:
        around = edges.unionByName(back)
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = park(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    pointed = around.join(least, "a")
    if larger_only:
        moved = pointed.where(F.col("b") > F.col("a"))
        moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        both = [
            F.struct(F.col(end).alias("a"), F.col("least").alias("b")) for end in ("b", "a")
        ]
        moved = pointed.select(F.inline(F.array(*both)))
    return moved.where(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame):
    return edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    ).first()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node reachable, for every node with a link.

    ``links`` holds pairs (``a``, ``b``) of numbers, in any order, repeated or not. Large
    and small stars alternate until nothing moves: then every node points to the least of
    its component. Each round is parked, so a lost executor costs one round.
    """
    edges = park(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "links",
    )
    before = _state(edges)
    for _ in range(_MAX_ROUNDS):
        edges = park(_to_least(edges, True), "links")
        edges = park(_to_least(edges, False), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {_MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
