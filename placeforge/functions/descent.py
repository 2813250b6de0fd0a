"""The nearest place by boxes that are cut smaller round by round, without the pairs of all places."""

from __future__ import annotations

from math import pi, sin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
#: Distances this share, or this much on a globe of radius 1, apart are told by the places themselves.
SLACK, LEAST = 1e-9, 1e-14
#: A round cuts a box into 8 along each axis, at most 13 times.
BITS, DEEPEST = 3, 13


def _on_globe(lat: str, lng: str) -> list[Column]:
    phi, lam = F.radians(lat), F.radians(lng)
    return [(F.cos(phi) * F.cos(lam)).alias("x"), (F.cos(phi) * F.sin(lam)).alias("y"), F.sin(phi).alias("z")]


def _cell(depth: int, finest: int = DEEPEST) -> list[Column]:
    """The box of a depth that holds the one of the finer depth in the columns cx, cy, cz."""
    return [F.shiftright(f"c{c}", BITS * (finest - depth)).alias(f"c{c}") for c in AXES]


def nearest_places(left: DataFrame, right: DataFrame, order: str, radius_m: float | None, few: int = 8) -> DataFrame:
    """(lat, lng, n) for each place of left: n is the nearest right row and its distance_m; of equal distances the least `order`.

    Rows at one place are asked once, and of right rows at one place only the least counts. Boxes on a globe of radius 1 are told by the ends of
    what they hold: a box whose nearest end is farther than the farthest end of another one (or than the radius) goes, the others are cut
    until they hold `few` places or less. So a place goes on with the boxes around its nearest one, however many there are elsewhere. Where
    a round has few boxes they are repeated in shares, so that no box is one task's work.
    """
    from placeforge.functions.spatial import EARTH_M, haversine_m
    from placeforge.sources.io import cut  # sources build on these functions

    limit = 2.0 if radius_m is None else 2 * sin(min(radius_m / EARTH_M / 2, pi / 2))
    limit = limit * (1 + SLACK) + LEAST
    whole = lambda a, b: F.expr(f"{a} is not null and {b} is not null and not isnan({a}) and not isnan({b})")
    spots = right.where(whole("r_lat", "r_lng")).groupBy("r_lat", "r_lng").agg(F.min_by(F.struct(*right.columns), F.struct(order)).alias("row"))
    finest = [F.least(F.floor((F.col(c) + 1) * 2.0 ** (BITS * DEEPEST - 1)), F.lit(2.0 ** (BITS * DEEPEST) - 1)).cast("long").alias(f"c{c}") for c in AXES]
    spots = cut(spots.select("row", "r_lat", "r_lng", *_on_globe("r_lat", "r_lng")).select("*", *finest), "spots")
    asked = left.where(whole("lat", "lng")).select("lat", "lng").distinct().select("lat", "lng", *_on_globe("lat", "lng"))
    cell = [f"c{c}" for c in AXES]
    kept = cut(asked.select("*", *[F.lit(0).cast("long").alias(c) for c in cell], F.lit(0).alias("depth"), F.lit(False).alias("last"), F.lit(0.0).alias("near"), F.lit(4.0).alias("far")), "asked")
    ends = [f(c).alias(f"{c}{k}") for c in AXES for k, f in enumerate((F.min, F.max))]
    near = sum((F.pow(F.greatest(F.col(f"{c}0") - F.col(c), F.col(c) - F.col(f"{c}1"), F.lit(0.0)), F.lit(2)) for c in AXES), F.lit(0.0))
    far = sum((F.pow(F.greatest(F.abs(F.col(c) - F.col(f"{c}0")), F.abs(F.col(c) - F.col(f"{c}1"))), F.lit(2)) for c in AXES), F.lit(0.0))
    for depth in range(1, DEEPEST + 1):
        boxes = cut(spots.select(*AXES, *_cell(depth)).groupBy(*cell).agg(F.count("*").alias("n"), *ends), "boxes")
        shares = max(1, min(64, 100_000 // max(1, boxes.count())))
        last = (F.col("n") <= few) | F.lit(depth == DEEPEST)
        inner = boxes.select(*[F.col(c).alias(f"__{c}") for c in cell], *[F.shiftright(c, BITS).alias(c) for c in cell], last.alias("__last"), *[f"{c}{k}" for c in AXES for k in (0, 1)], F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("__share"))
        own = kept.where("not last").withColumn("__share", F.pmod(F.xxhash64("lat", "lng"), F.lit(shares)).cast("int")).drop("near", "far", "last", "depth")
        cut_on = own.hint("merge").join(inner, [*cell, "__share"]).select("lat", "lng", *AXES, *[F.col(f"__{c}").alias(c) for c in cell], F.lit(depth).alias("depth"), F.col("__last").alias("last"), F.sqrt(near).alias("near"), F.sqrt(far).alias("far"))
        bound = F.least(F.min("far").over(Window.partitionBy("lat", "lng")) * (1 + SLACK) + LEAST, F.lit(limit))
        kept = cut(kept.where("last").unionByName(cut_on.where(F.col("near") <= limit)).withColumn("__bound", bound).where("near <= __bound").drop("__bound"), "kept")
        if kept.where("not last").isEmpty():
            break
    placed = spots.select("row", F.explode(F.array(*[F.struct(F.lit(k).alias("depth"), *_cell(k)) for k in range(1, depth + 1)])).alias("c")).select("row", "c.*")
    pairs = kept.select("lat", "lng", "depth", *cell).hint("merge").join(placed, ["depth", *cell]).select("lat", "lng", "row.*").withColumn("distance_m", haversine_m(F.col("lat"), F.col("lng"), F.col("r_lat"), F.col("r_lng")))
    if radius_m is not None:
        pairs = pairs.where(F.col("distance_m") <= radius_m)
    return pairs.groupBy("lat", "lng").agg(F.min_by(F.struct(*right.columns, "distance_m"), F.struct("distance_m", order)).alias("n"))
