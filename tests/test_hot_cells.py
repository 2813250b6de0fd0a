"""Distance joins and containment where one cell, trigram or name holds a great share of the rows."""

import random
from statistics import median

from pyspark.sql import functions as F

from placeforge.functions import hotcells
from placeforge.functions import spatial as G
from placeforge.operators import containment
from placeforge.operators import resolve as R


def _points(spark, n, seed, key, prefix=""):
    """Half of the points in one cell, a fifth at one place, some at the date line and the poles, one without a place."""
    draw, rows = random.Random(seed), []
    for i in range(n):
        kind = draw.random()
        if kind < 0.5:
            rows.append((i, 1.3 + draw.random() * 0.006, 103.8 + draw.random() * 0.006))
        elif kind < 0.7:
            rows.append((i, 1.301, 103.801))
        elif kind < 0.8:
            rows.append((i, 10 + draw.random() * 0.01, draw.choice([179.999, -179.999, 180.0, -180.0]) + draw.random() * 0.0005))
        elif kind < 0.9:
            rows.append((i, draw.choice([89.999, -89.999]), draw.random() * 360 - 180))
        else:
            rows.append((i, draw.random() * 170 - 85, draw.random() * 360 - 180))
    rows.append((n, None, None))
    return spark.createDataFrame(rows, f"{key} long, {prefix}lat double, {prefix}lng double")


def _rows(df):
    return sorted((r.a, r.b, r.distance_m) for r in df.collect())


def test_hot_cells_lose_and_double_nothing(spark):
    left, right = _points(spark, 700, 1, "a"), _points(spark, 900, 2, "b", "r_")
    for radius in (40.0, 800.0):
        plain = _rows(G.distance_join(left, right, radius, hot=None))
        assert plain and _rows(G.distance_join(left, right, radius, hot=25)) == plain
    every = left.crossJoin(right).withColumn("distance_m", G.haversine_m(F.col("lat"), F.col("lng"), F.col("r_lat"), F.col("r_lng"))).where("distance_m <= 800")
    assert _rows(every) == plain


def test_hot_cells_with_further_keys_and_one_side_hot(spark):
    left, right = _points(spark, 30, 3, "a").withColumn("kind", F.col("a") % 2), _points(spark, 900, 4, "b", "r_").withColumn("kind", F.col("b") % 2)
    plain = _rows(G.distance_join(left, right, 500.0, on=["kind"], hot=None))
    assert plain and _rows(G.distance_join(left, right, 500.0, on=["kind"], hot=20)) == plain
    other = right.withColumnsRenamed({"b": "a", "r_lat": "lat", "r_lng": "lng"}), left.withColumnsRenamed({"a": "b", "lat": "r_lat", "lng": "r_lng"})
    plain = _rows(G.distance_join(*other, 500.0, on=["kind"], hot=None))
    assert plain and _rows(G.distance_join(*other, 500.0, on=["kind"], hot=20)) == plain
    assert G.distance_join(left.limit(0), right, 500.0, hot=20).count() == 0


def test_no_key_holds_a_hot_cell(spark):
    """Half of 8,000 points in one cell: a key's work is at most five times the median of those that have a like share."""
    left, right = _points(spark, 8000, 5, "a"), _points(spark, 8000, 6, "b", "r_")
    own, other, keys = G.celled(left, right, 800.0, None)
    own, other = own.where("lat is not null").cache(), other.where("r_lat is not null").cache()
    most = own.groupBy(*keys).count().agg(F.max("count")).first()[0]
    one, two = hotcells.deal(own, other, keys, 800.0 / G.EARTH_M, 200)
    assert most > 2000
    for side in (one, two):
        sizes = [r["count"] for r in side.groupBy(*keys, *hotcells.DEALT).count().collect()]
        dealt = [n for n in sizes if n >= 20]
        assert max(sizes) <= 300 and max(sizes) <= 5 * median(dealt)


def test_nearest_from_a_hot_cell(spark):
    left, right = _points(spark, 200, 7, "a"), _points(spark, 600, 8, "b", "r_")
    plain = sorted(map(tuple, G.nearest(left, right, "a", "b", 800.0).collect()))
    far = {r[0]: r for r in map(tuple, G.nearest_anywhere(left, right, "a", "b", 800.0, 500.0, hot=30).collect())}
    assert len(far) == 200 and all(far[r[0]] == r for r in plain)


def test_pieces_within_is_containment(spark):
    draw = random.Random(9)
    words = ["AVE", "AVENUE", "A", "ST", "BT", "BUKIT", "PANJANG", "1", "12", "ÄÖ", "AAAA"]
    names = sorted({" ".join(draw.choice(words) for _ in range(draw.randint(1, 4))) for _ in range(150)} | {"", "A", "AA", "AAA", "AAAAA"})
    needles = names[::2] + ["XYZ", "AVE 1 NOT"]
    got = containment.pieces_within(spark.createDataFrame([(x,) for x in [*needles, None]], "needle string"), "needle", spark.createDataFrame([(x,) for x in [*names, None]], "straw string"), "straw").collect()
    assert sorted(map(tuple, got)) == sorted((n, s) for n in set(needles) for s in names if n in s)


def test_containment_of_a_common_trigram_has_linear_rows(spark):
    """2,000 needles and 2,000 straws of one trigram: pieces are as many as straws and shapes, and there is no broadcast and no cross join."""
    needles = spark.range(2000).select(F.format_string("AVE %04d", "id").alias("needle"))
    straws = spark.range(2000).select(F.format_string("AVE %04d", "id").alias("straw"))
    pairs = containment.pieces_within(needles, "needle", straws, "straw")
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert pairs.count() == 2000 and "broadcast" not in plan.lower() and "Cartesian" not in plan


def test_anti_join_keeps_what_touches_no_name(spark):
    a = spark.createDataFrame([("BUKIT PANJANG MRT STATION",), ("ANG MO KIO MRT STATION",), (None,)], "name string")
    b = spark.createDataFrame([("BUKIT PANJANG LRT STATION", 1), ("SENJA LRT STATION", 2), ("SENJA LRT STATION", 3)], "name string, x int")
    assert sorted(r.x for r in R.containment_anti_join(b, a).collect()) == [2, 3]
