"""Distances and joins by distance, blocked by grid cells so that they stay equi-joins."""

from __future__ import annotations

from math import degrees, pi, sin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.functions.descent import nearest_places
from placeforge.functions.hotcells import DEALT, deal

EARTH_M = 6_371_000.0


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """F12."""
    dlat, dlng = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng / 2), 2)
    return F.lit(2 * EARTH_M) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def _cells(radius_m: float):
    """The band of a latitude, how many cells a band has around the globe, and the cell of a longitude in it.

    Bands are as high as the radius; a band's cells are as wide as the radius at the band's side towards the pole and one band beyond.
    """
    angle = radius_m / EARTH_M * 1.001
    high = max(degrees(angle), 1e-9)
    band = lambda lat: F.floor(lat / high).cast("long")
    farthest = lambda y: F.least(F.greatest(F.abs(y), F.abs(y + 1)) * high + high, F.lit(90.0))
    wide = lambda y: F.degrees(F.asin(F.least(F.lit(sin(min(angle, pi / 2))) / F.greatest(F.cos(F.radians(farthest(y))), F.lit(1e-12)), F.lit(1.0))))
    count = lambda y: F.when(farthest(y) >= 90.0, 1).otherwise(F.greatest(F.floor(F.lit(360.0) / wide(y)), F.lit(1))).cast("long")
    cell = lambda lng, n: F.pmod(F.floor((lng + 180.0) / (F.lit(360.0) / n)).cast("long"), n)
    return band, count, cell


def celled(left: DataFrame, right: DataFrame, radius_m: float, on: list[str] | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Left rows in their cell, right rows in theirs and the eight around it, and the columns that tell the cell."""
    band, count, cell = _cells(radius_m)
    own = left.withColumn("__cy", band(F.col("lat"))).withColumn("__cx", cell(F.col("lng"), count(F.col("__cy"))))
    high = max(degrees(radius_m / EARTH_M * 1.001), 1e-9)
    along = (F.col("lng") + 180.0) / (F.lit(360.0) / count(F.col("__cy")))
    own = own.withColumn("__fy", F.col("lat") / high - F.col("__cy")).withColumn("__fx", along - F.floor(along))

    def row(y: Column) -> Column:
        n = count(y)
        return F.transform(F.array_distinct(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda x: F.pmod(cell(F.col("r_lng"), n) + x, n))), lambda x: F.struct(y.alias("y"), x.alias("x")))

    around = F.explode(F.flatten(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda dy: row(band(F.col("r_lat")) + dy))))
    other = right.withColumn("__c", around).withColumn("__cy", F.col("__c.y")).withColumn("__cx", F.col("__c.x")).drop("__c")
    return own, other, ["__cy", "__cx", *(on or [])]


def distance_join(left: DataFrame, right: DataFrame, radius_m: float, strict: bool = False, on: list[str] | None = None, hot: int | None = 20_000) -> DataFrame:
    """Pairs of left (lat, lng, ..) and right (r_lat, r_lng, ..) within the radius, with distance_m; `on`: further columns that must agree.

    Anywhere on the globe: cells get wider in degrees towards the poles, and the last of a band lies beside the first. The right side goes to
    its cell and the eight around it; that factor is fixed, and the join is by equal cells. Cells with more than `hot` rows of a side are cut
    further and dealt to tiles (hotcells.deal).
    """
    own, other, keys = celled(left, right, radius_m, on)
    own, other = deal(own, other, keys, radius_m / EARTH_M, hot)
    # sizes are told from a scan's columns and do not know that rows are repeated, so a broadcast would be judged small that is not
    pairs = own.drop("__fy", "__fx").hint("merge").join(other, [*keys, *DEALT]).withColumn("distance_m", haversine_m(F.col("lat"), F.col("lng"), F.col("r_lat"), F.col("r_lng")))
    return pairs.where((F.col("distance_m") < radius_m) if strict else (F.col("distance_m") <= radius_m)).drop("__cy", "__cx", *DEALT)


def nearest(left: DataFrame, right: DataFrame, key: str, order: str, radius_m: float | None, hot: int | None = 20_000) -> DataFrame:
    """For each left key the nearest right row within the radius (None: however far); of equal distances the least `order`.

    Boxes are cut smaller around each place (descent.nearest_places), so pairs within the radius are never listed and `hot` has no work left.
    Rows without a place have no nearest.
    """
    found = left.hint("merge").join(nearest_places(left, right, order, radius_m), ["lat", "lng"])
    return found.groupBy(key).agg(F.min_by("n", F.struct("n.distance_m", f"n.{order}")).alias("n")).select(key, "n.*")


def nearest_anywhere(left: DataFrame, right: DataFrame, key: str, order: str, first_m: float = 1000.0, factor: float = 4.0, hot: int | None = 20_000) -> DataFrame:
    """For each left key the nearest right row, however far; of equal distances the least `order`.

    Rings of `first_m` that grow by `factor` met every place at last; boxes (see nearest) need none, and the parameters change nothing now.
    """
    return nearest(left, right, key, order, None)


def first_in_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")
