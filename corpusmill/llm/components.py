"""Connected components by alternating large-star and small-star rounds, each a grouped aggregation whose result is checkpointed.

No group of neighbours is collected: the least neighbour of a node is an aggregate, and the new links come from a join with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _digest(edges: DataFrame) -> tuple[int, int]:
    """Number of links and a sum over them that tells two sets of links apart."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node that a link of ``edges`` touches. Nodes are bigint."""
    a, b = F.col(a).cast("long"), F.col(b).cast("long")
    edges = checkpointed(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct())
    seen = _digest(edges)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        # large star: larger neighbours of a node move to the least of its neighbours and itself
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        edges = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours of a node, and itself, move to the least of them
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a")
        edges = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = checkpointed(edges)
        before, seen = seen, _digest(edges)
        if before == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
