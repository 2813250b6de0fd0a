"""Links that hold together what lies near, in as many rows as points."""

from __future__ import annotations

from itertools import product
from math import pi, sin, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.functions import spatial as G
from placeforge.sources.io import cut

AXES = ("x", "y", "z")
#: Chords this share off the radius are told by the points themselves.
SLACK = 1e-9


def _box() -> Column:
    """The box around a group's points, one of its places, and how many points there are."""
    ends = [f(c).alias(f"{c}{k}") for c in AXES for k, f in enumerate((F.min, F.max))]
    return F.struct(*ends, F.min("lat").alias("lat"), F.min("lng").alias("lng"), F.count("*").alias("n"))


def _judged(pairs: DataFrame, radius_m: float, chord: float) -> DataFrame:
    """Adds `near` and `open` to pairs of boxes p and q: surely two points less than the radius apart, or not known yet."""
    p, q = F.col("p"), F.col("q")
    gap = sum((F.pow(F.greatest(q[f"{c}0"] - p[f"{c}1"], p[f"{c}0"] - q[f"{c}1"], F.lit(0.0)), F.lit(2)) for c in AXES), F.lit(0.0))
    span = sum((F.pow(F.greatest(q[f"{c}1"] - p[f"{c}0"], p[f"{c}1"] - q[f"{c}0"]), F.lit(2)) for c in AXES), F.lit(0.0))
    one = F.lit(True)
    for b, c in product((p, q), AXES):
        one = one & (b[f"{c}0"] == b[f"{c}1"])
    exact = G.haversine_m(p["lat"], p["lng"], q["lat"], q["lng"]) < radius_m
    near = F.when(one, exact).otherwise(span < (chord * (1 - SLACK)) ** 2)
    return pairs.withColumn("near", near).withColumn("open", ~one & ~F.col("near") & (gap <= (chord * (1 + SLACK)) ** 2))


def near_links(points: DataFrame, radius_m: float, split: int = 4, few: int = 100_000, max_rounds: int = 60) -> DataFrame:
    """Links (id, other) of points (id, lat, lng, key) whose components are those of all pairs of one key less than radius_m apart.

    On a globe of radius 1 points fall into cubes that are smaller than the radius, so a cube's points all hang on its least id. Two cubes
    need one link if any two of their points are near. That is asked of the boxes around their points: boxes that are near at their farthest
    have such points, boxes that are apart at their nearest have none, and others are cut into smaller ones and asked again, down to single
    places, whose distance is exact. So rows grow with the points and not with the pairs, however many points a cube holds: once the pairs of
    points in the boxes still asked are no more than `few`, or than the points themselves (never with `few` 0), they are looked at one by one. Points without
    id or place have no link.
    """
    chord = 2 * sin(min(radius_m / G.EARTH_M / 2, pi / 2))
    side = chord / sqrt(3) * 0.999
    cell = ["key", *(f"c{c}" for c in AXES)]
    phi, lam = F.radians("lat"), F.radians("lng")
    own = points.where("id is not null and lat is not null and lng is not null").select("id", "key", "lat", "lng", (F.cos(phi) * F.cos(lam)).alias("x"), (F.cos(phi) * F.sin(lam)).alias("y"), F.sin(phi).alias("z"))
    own = cut(own.select("*", *[F.floor(F.col(c) / side).cast("long").alias(f"c{c}") for c in AXES]), "points")
    cubes = cut(own.groupBy(*cell).agg(F.min("id").alias("head"), _box().alias("box")), "cubes")
    stars = own.hint("merge").join(cubes.select(*cell, "head"), cell).where("id <> head").select("id", F.col("head").alias("other"))
    # the cubes around, each pair once, as far as the globe's surface runs through them
    offsets = [o for o in product(range(-2, 3), repeat=3) if o > (0, 0, 0)]
    around = F.explode(F.array(*[F.struct(*[F.lit(k).alias(c) for c, k in zip(AXES, o)]) for o in offsets])).alias("o")
    moved = cubes.select("key", F.col("head").alias("a"), F.col("box").alias("p"), *[f"c{c}" for c in AXES], around).select("key", "a", "p", *[(F.col(f"c{c}") + F.col(f"o.{c}")).alias(f"c{c}") for c in AXES])
    lows = [F.col(f"c{c}") * F.lit(side) for c in AXES]
    least = sum((F.pow(F.greatest(x, -(x + side), F.lit(0.0)), F.lit(2)) for x in lows), F.lit(0.0))
    most = sum((F.pow(F.greatest(F.abs(x), F.abs(x + side)), F.lit(2)) for x in lows), F.lit(0.0))
    beside = moved.where((least <= 1 + SLACK) & (most >= 1 - SLACK)).hint("merge").join(cubes.withColumnsRenamed({"head": "b", "box": "q"}), cell)
    pairs = beside.select("a", "b", F.lit("").alias("pn"), F.lit("").alias("qn"), "p", "q")
    members = own.hint("merge").join(cubes.select(*cell, "head"), cell).select("head", F.lit("").alias("name"), "lat", "lng", *AXES).distinct()
    links, most = stars, None
    for _ in range(max_rounds):
        judged = cut(_judged(pairs, radius_m, chord).where("near or open"), "pairs")
        near = judged.where("near").select(F.col("a").alias("id"), F.col("b").alias("other")).distinct()
        links = links.unionByName(near)
        rest = judged.where("open").hint("merge").join(near, (F.col("a") == F.col("id")) & (F.col("b") == F.col("other")), "left_anti").select("a", "b", "pn", "qn", "p", "q")
        left_open, work = rest.agg(F.count("*"), F.sum(F.col("p.n") * F.col("q.n"))).first()
        if not left_open:
            return links.distinct()
        if most is None:
            most = few and max(few, cubes.agg(F.sum("box.n")).first()[0])
        if work <= most:
            one, two = (members.select(F.col("head").alias(h), F.col("name").alias(n), F.col("lat").alias(f"{h}_lat"), F.col("lng").alias(f"{h}_lng")) for h, n in (("a", "pn"), ("b", "qn")))
            each = rest.select("a", "b", "pn", "qn").hint("merge").join(one, ["a", "pn"]).hint("merge").join(two, ["b", "qn"]).where(G.haversine_m(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng")) < radius_m)
            return links.unionByName(each.select(F.col("a").alias("id"), F.col("b").alias("other"))).distinct()
        rest = cut(rest, "open")
        asked = rest.select(F.col("a").alias("head"), F.col("pn").alias("name"), F.col("p").alias("box")).unionByName(rest.select(F.col("b").alias("head"), F.col("qn").alias("name"), F.col("q").alias("box"))).distinct()
        place = lambda c: F.least(F.floor((F.col(c) - F.col(f"box.{c}0")) / (F.col(f"box.{c}1") - F.col(f"box.{c}0")) * split), F.lit(split - 1))
        part = [F.when(F.col(f"box.{c}0") < F.col(f"box.{c}1"), place(c)).otherwise(0).cast("int").cast("string") for c in AXES]
        members = cut(members.hint("merge").join(asked, ["head", "name"]).select("head", F.col("name").alias("of"), F.concat("name", *part).alias("name"), "lat", "lng", *AXES), "members")
        boxes = cut(members.groupBy("head", "of", "name").agg(_box().alias("box")), "boxes")
        members = members.drop("of")
        left = boxes.select(F.col("head").alias("a"), F.col("of").alias("pn"), F.col("name").alias("p_name"), F.col("box").alias("p"))
        right = boxes.select(F.col("head").alias("b"), F.col("of").alias("qn"), F.col("name").alias("q_name"), F.col("box").alias("q"))
        pairs = rest.select("a", "b", "pn", "qn").hint("merge").join(left, ["a", "pn"]).hint("merge").join(right, ["b", "qn"]).select("a", "b", F.col("p_name").alias("pn"), F.col("q_name").alias("qn"), "p", "q")
    raise RuntimeError(f"boxes did not settle in {max_rounds} rounds")
