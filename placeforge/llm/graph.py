"""Connected components by alternating star contraction, with joins and aggregates that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u moves to the smallest of u and its neighbours. edges: hi > lo."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the smallest of these."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo")))


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Links (a, b) of longs to rows (node, root): root is the smallest node that is reachable; nodes without a link to another are left out.

    A node with very many links stays harmless: minima are combined before the shuffle, and the join that hands them out is one that
    Spark can split. Each round is written to the shared folder. Nulls and loops are ignored; an empty input gives no row.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    edges = cut(edges, "edges")
    state = None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if now[0] == 0 or now == state:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        state = now
        edges = cut(_small_star(_large_star(edges).distinct()).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
