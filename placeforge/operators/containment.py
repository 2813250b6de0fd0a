"""Which names lie within which others, as an equi-join of whole pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of a key that many rows of the larger side may have.
SHARES = 32


def _shared_join(large: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """An equi-join whose large side may hold any share of its rows under one key: they go to 32 shares, the small side's rows to each."""
    one = large.withColumn("__share", F.pmod(F.xxhash64(*large.columns), F.lit(SHARES)))
    two = small.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)).cast("array<bigint>")))
    return one.join(two, [key, "__share"], how).drop("__share")


def _grams(text: Column) -> Column:
    """(at, g) of each trigram, places from 1; none for a text under three characters."""
    places = F.when(F.length(text) >= 3, F.sequence(F.lit(1), F.length(text) - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.substring(text, i, F.lit(3)).alias("g")))


def _short(text: Column) -> Column:
    """The pieces of no, one and two characters."""
    each = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.array_distinct(F.concat(F.array(F.lit("")), each(1), each(2)))


def pieces_within(needles: DataFrame, needle: str, hay: DataFrame, straw: str) -> DataFrame:
    """Distinct (needle, straw) with the needle in the straw; both sides distinct texts, nulls lie in nothing, the empty text in every text.

    A needle is known by its rarest trigram, and needles of one trigram differ by where it stands in them and how long they are. A straw cuts
    out a piece for each of its trigrams and each such shape, and pieces meet needles as whole texts. So rows grow with the straws and the
    shapes, never with needles times straws of a common trigram. Trigrams and pieces that many straws hold are dealt to shares; there is
    no broadcast.
    """
    spread = hay.where(F.col(straw).isNotNull()).select(straw, F.explode(_grams(F.col(straw))).alias("t")).select(straw, "t.at", "t.g")
    often = spread.select(straw, "g").distinct().groupBy("g").agg(F.count("*").alias("n"))
    own = needles.where(F.col(needle).isNotNull()).select(needle, F.explode(_grams(F.col(needle))).alias("t")).select(needle, F.col("t.at").alias("o"), "t.g")
    rare = _shared_join(own, often, "g").withColumn("size", F.length(needle)).groupBy(needle).agg(F.count("*").alias("known"), F.max("size").alias("size"), F.min_by(F.struct("g", "o"), F.struct("n", "g", "o")).alias("r"))
    # a needle with a trigram that no straw has lies in none
    rare = rare.where(F.col("known") == F.col("size") - 2)
    shapes = rare.select("r.g", "r.o", "size").distinct()
    at = F.col("at") - F.col("o") + 1
    long = _shared_join(spread, shapes, "g").where((at >= 1) & (at + F.col("size") - 1 <= F.length(straw))).select(straw, F.substring(F.col(straw), at, F.col("size")).alias(needle))
    brief = hay.where(F.col(straw).isNotNull()).select(straw, F.explode(_short(F.col(straw))).alias(needle))
    return _shared_join(long.unionByName(brief).distinct(), needles.select(needle).distinct(), needle).select(needle, straw)
