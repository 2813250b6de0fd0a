"""Both sides of a distance join dealt so that no cell, however many points it holds, is one task's work."""

from __future__ import annotations

from math import ceil, log, pi, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hot cells hold a side's 4,000th part or more each, so that lists of them are bounded whatever the input (at most 32,000 boxes).
PARTS = 4000
DEALT = ["__sub", "__i", "__j"]


def _east(lng: Column) -> Column:
    """A longitude from -180 up to 180."""
    return F.pmod(lng + 180.0, F.lit(360.0)) - 180.0


def _reaches(angle: float) -> Column:
    """Whether a right point may lie within the angle of a point in the box: never false for one that does."""
    lat, lng = F.col("r_lat"), _east(F.col("r_lng"))
    high = F.greatest(F.col("__lat0") - lat, lat - F.col("__lat1"), F.lit(0.0))
    turn = lambda end: F.least(F.abs(lng - end), 360.0 - F.abs(lng - end))
    wide = F.when(lng.between(F.col("__lng0"), F.col("__lng1")), 0.0).otherwise(F.least(turn(F.col("__lng0")), turn(F.col("__lng1"))))
    shrunk = F.cos(F.radians(lat)) * F.least(F.cos(F.radians("__lat0")), F.cos(F.radians("__lat1")))
    least = F.pow(F.sin(F.radians(high) / 2), 2) + shrunk * F.pow(F.sin(F.radians(wide) / 2), 2)
    return least <= sin(min(angle, pi) / 2) ** 2 * (1 + 1e-6) + 1e-15


def _sub(k: Column) -> Column:
    """The part of a cell cut k times into four in which a left point lies; __fy and __fx tell its place from 0 to 1."""
    n = F.pow(F.lit(2), k)
    at = lambda f: F.greatest(F.least(F.floor(F.col(f) * n), n - 1), F.lit(0))
    return (at("__fy") * n + at("__fx")).cast("long")


def deal(own: DataFrame, other: DataFrame, keys: list[str], angle: float, hot: int | None = 20_000) -> tuple[DataFrame, DataFrame]:
    """own (lat, lng, __fy, __fx, keys) and other (r_lat, r_lng, keys) with the further join keys DEALT; every pair meets under one key.

    Cells in which a side has more than `hot` rows (and a 4,000th of that side's rows) are cut into quarters as often as it takes. A right row
    goes to those parts whose box of left points it may reach. Parts that are still large, such as one place with many rows, become tiles:
    a left row lies in one row of tiles and goes along it, a right row lies in one column. So a key gets about `hot` rows of each side at
    most; of hot cells, rows that reach nothing go. Rows go to tiles by their hash, so rows equal in every column share one. If no cell is hot (or `hot` is
    None), nothing is dealt; to know that, both sides are counted by cell.
    """
    plain = [F.lit(0).cast(t).alias(c) for c, t in zip(DEALT, ("long", "int", "int"))]
    if hot is None:
        return own.select("*", *plain), other.select("*", *plain)
    from placeforge.sources.io import cut  # sources build on these functions

    counts = own.groupBy(*keys).agg(F.count("*").alias("__n")).join(other.groupBy(*keys).agg(F.count("*").alias("__m")), keys, "full").fillna(0, ["__n", "__m"])
    n, m, most_n, most_m = counts.agg(F.sum("__n"), F.sum("__m"), F.max("__n"), F.max("__m")).first()
    if n is None or (most_n <= hot and most_m <= hot):
        return own.select("*", *plain), other.select("*", *plain)
    one, two = max(hot, ceil(n / PARTS)), max(hot, ceil(m / PARTS))
    times = F.greatest(F.col("__n") / one, F.col("__m") / two)
    both = (F.col("__n") > 0) & (F.col("__m") > 0)
    cells = cut(counts.where(times > 1).select(*keys, F.when(both, F.ceil(F.log(times) / log(4))).otherwise(-1).cast("int").alias("__k")), "hot_cells")  # -1: nothing to meet
    cut_own = own.join(F.broadcast(cells), keys, "left").withColumn("__sub", F.coalesce(_sub(F.col("__k")), F.lit(0).cast("long")))
    ends = [f(c).alias(f"__{a}{k}") for a, c in (("lat", F.col("lat")), ("lng", _east(F.col("lng")))) for k, f in enumerate((F.min, F.max))]
    boxes = cut(cut_own.where("__k >= 0").groupBy(*keys, "__sub").agg(F.count("*").alias("__n"), *ends), "hot_boxes")
    reached = other.join(F.broadcast(boxes), keys).where(_reaches(angle)).groupBy(*keys, "__sub").agg(F.count("*").alias("__m"))
    rows, columns = F.ceil(F.col("__n") / one).cast("int").alias("__a"), F.ceil(F.col("__m") / two).cast("int").alias("__b")
    tiles = cut(boxes.join(reached, [*keys, "__sub"]).select(*keys, "__sub", rows, columns, *[f"__{a}{k}" for a in ("lat", "lng") for k in (0, 1)]), "hot_tiles")
    share = lambda df, of: F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.coalesce(of, F.lit(1))).cast("int")
    along = lambda of: F.explode(F.sequence(F.lit(0), F.coalesce(of, F.lit(1)) - 1))
    first = cut_own.join(F.broadcast(tiles.select(*keys, "__sub", "__a", "__b")), [*keys, "__sub"], "left").where("__k is null or __a is not null")
    first = first.select(*own.columns, "__sub", share(own, F.col("__a")).alias("__i"), along(F.col("__b")).alias("__j"))
    second = other.join(F.broadcast(cells), keys, "left").join(F.broadcast(tiles), keys, "left")
    second = second.where(F.col("__k").isNull() | (F.col("__sub").isNotNull() & _reaches(angle)))
    second = second.select(*other.columns, F.coalesce("__sub", F.lit(0).cast("long")).alias("__sub"), along(F.col("__a")).alias("__i"), share(other, F.col("__b")).alias("__j"))
    return first, second
