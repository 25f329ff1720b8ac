"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (``u``, ``v``: longs without nulls).

    Each round, every node joins its least neighbour and edges are drawn anew between what
    is left; nodes should be hashes, so that their order is random and each round takes
    away a fixed share. Every round is stored. ``root`` is a node of the component.
    """
    rounds: list[DataFrame] = []
    edges = stored(edges.filter("u <> v").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v"))
        joined = stored(least.select("node", F.least("node", "v").alias("to")), "joined")
        rounds.append(joined)
        left = joined.select(F.col("node").alias("u"), F.col("to").alias("new_u"))
        right = joined.select(F.col("node").alias("v"), F.col("to").alias("new_v"))
        edges = stored(
            edges.join(left, "u")
            .join(right, "v")
            .select(F.col("new_u").alias("u"), F.col("new_v").alias("v"))
            .filter("u <> v")
            .distinct(),
            "edges",
        )
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

    def follow(first: DataFrame, later: DataFrame) -> DataFrame:
        later = later.select(F.col("node").alias("to"), F.col("root").alias("further"))
        return first.join(later, "to", "left").select(
            "node", F.coalesce("further", "to").alias("root")
        )

    last = rounds[-1].select("node", F.col("to").alias("root"))
    return reduce(lambda later, first: follow(first, later), reversed(rounds[:-1]), last)
