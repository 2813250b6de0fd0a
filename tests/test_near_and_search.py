"""Links of near points against all pairs, in dense cells and anywhere on the globe; search of titles against all titles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placeforge.functions.spatial import EARTH_M
from placeforge.operators import consolidate as C
from placeforge.operators.near import near_links
from placeforge.operators.resolve import resolve_url
from placeforge.operators.search import search_titles, title_words


def metres(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * EARTH_M * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def brute_roots(points, radius):
    root = {p[0]: p[0] for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(points):
        for b in points[:i]:
            if a[3] == b[3] and metres(a, b) < radius:
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    return {p[0]: find(p[0]) for p in points}


def cloud(rng, lat, lng, spread, n, key, start):
    out = []
    for k in range(n):
        y = max(-90.0, min(90.0, lat + rng.uniform(-1, 1) * spread))
        x = lng + rng.uniform(-1, 1) * spread / max(0.01, math.cos(math.radians(y)))
        out.append((start + k, y, (x + 180) % 360 - 180, key))
    return out


@pytest.mark.parametrize("few", [0, 100_000])
@pytest.mark.parametrize("lat,lng,spread", [(1.3, 103.8, 0.02), (1.3, 103.8, 0.004), (60.0, 179.999, 0.01), (89.995, 10.0, 0.01), (-90.0, 0.0, 0.01)])
def test_near_links_have_the_components_of_all_pairs(spark, lat, lng, spread, few):
    rng = random.Random(9)
    points = cloud(rng, lat, lng, spread, 120, "a", 0) + cloud(rng, lat, lng, spread, 40, "b", 500) + cloud(rng, lat, lng, spread / 30, 60, "a", 900)
    points += [(2000 + k, *points[k][1:]) for k in range(5)]  # copies of a place
    df = spark.createDataFrame(points, "id long, lat double, lng double, key string")
    links = near_links(df, 200.0, few=few)
    assert links.count() <= 40 * len(points)
    assert {r.id: r.root for r in C.components(df, links).collect()} == brute_roots(points, 200.0)
    odd = spark.createDataFrame([(None, 1.0, 1.0, "a"), (1, None, 1.0, "a"), (2, 1.0, 1.0, None)], df.schema)
    assert near_links(odd, 200.0).count() == 0 and near_links(df.limit(0), 200.0).count() == 0


def test_near_links_stay_linear_in_a_dense_cell(spark):
    n = 100_000
    k = F.col("id")
    # two clouds of one name in one cell and beside it, 10 m apart at their nearest, and a third one that is too far
    df = spark.range(n).select("id", (F.lit(1.3) + (k * 7919 % 10007) / 10007.0 * 0.003).alias("lat"), (F.lit(103.8) + (k * 104729 % 9973) / 9973.0 * 0.002 + (k % 3) * 0.00209 + F.when(k % 3 == 2, 0.009).otherwise(0.0)).alias("lng"), F.lit("one name").alias("key"))
    links = near_links(df, 800.0).cache()
    assert links.count() < 2 * n
    roots = C.components(df, links).groupBy("root").count().collect()
    assert sorted((r.root, r["count"]) for r in roots) == [(0, n - n // 3), (2, n // 3)]


def test_search_against_all_titles(spark):
    rng = random.Random(4)
    words = ["mrt", "station", "bay", "gardens", "north", "south", "pier", "one", "green", "harbour", "é"] + [f"w{k}" for k in range(30)]
    base = "https://x.org/wiki"
    titles = sorted({"_".join(rng.choice(words) for _ in range(rng.randint(1, 5))) + rng.choice(["", "_MRT_Station", "%2Dx"]) for _ in range(150)})
    names = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) + rng.choice(["", " MRT STATION"])) for k in range(120)] + [(500, ""), (501, None), (502, "!?"), (503, "unknown")]
    pages = spark.createDataFrame([(f"{base}/{x}",) for x in titles] + [(None,), ("https://y.org/z",), (f"{base}/{titles[0]}",)], "url string")
    got = {r.id: (r.search_url, r.search_score) for r in search_titles(spark.createDataFrame(names, "id long, name string"), pages, "id", "name", base).collect()}
    split = {r.x: r.w for r in spark.createDataFrame([(x,) for x in [n for _, n in names if n] + [x.replace("_", " ").replace("%2D", "-") for x in titles]], "x string").select("x", title_words(F.col("x")).alias("w")).collect()}
    held = {x: set(split[x.replace("_", " ").replace("%2D", "-")]) for x in titles}
    n = {}
    for ws in held.values():
        for w in ws:
            n[w] = n.get(w, 0) + 1
    want = {}
    for k, name in names:
        own = split.get(name, [])
        weight = {w: math.floor(1000 * math.log(1 + len(held) / n.get(w, 1))) for w in own}
        best = min(((-sum(weight[w] for w in own if w in ws), len(ws), f"{base}/{x}") for x, ws in held.items()), default=None)
        if own and -best[0] >= sum(weight.values()) / 2:
            want[k] = (best[2], -best[0])
    assert got == want and len(want) > 40


def test_search_is_the_step_behind_the_candidates(spark):
    base = "https://x.org/wiki"
    names = spark.createDataFrame([(1, "GARDENS BY THE BAY MRT STATION"), (2, "BAY GARDENS MRT STATION"), (3, "NOWHERE MRT STATION"), (4, "BAY MRT/LRT STATION")], "id long, name string")
    pages = spark.createDataFrame([(f"{base}/Gardens_by_the_Bay_MRT_Station",), *[(f"{base}/Harbour_{k}_MRT_Station",) for k in range(40)]], "url string")
    none = spark.createDataFrame([], "map_key string, url string, rank int"), spark.createDataFrame([], "key string, url string, cached_at timestamp")
    got = {r.id: (r.url, r.resolution_source) for r in resolve_url(names, pages, *none, F.current_timestamp(), base).collect()}
    assert got[1] == got[2][:1] + ("candidate",) and got[2][1] == "search" and got[3][1] == "naive" and got[4][1] == "interchange"


def test_nearest_anywhere_goes_on_until_all_have_one(spark):
    from placeforge.functions.spatial import nearest_anywhere

    rng = random.Random(3)
    own = [(k, rng.uniform(-89, 89), rng.uniform(-180, 180)) for k in range(40)] + [(90, None, 1.0)]
    places = [(k, rng.uniform(-60, 60), rng.uniform(100, 130)) for k in range(25)] + [(70, None, None), (71, 5.0, 110.0), (72, 5.0, 110.0)]
    left, right = spark.createDataFrame(own, "id long, lat double, lng double"), spark.createDataFrame(places, "place long, r_lat double, r_lng double")
    got = {r.id: r.place for r in nearest_anywhere(left, right, "id", "place", first_m=100_000.0, factor=10.0).collect()}
    assert got == {a[0]: min((metres(a, p), p[0]) for p in places if p[1] is not None)[1] for a in own if a[1] is not None}
    assert nearest_anywhere(left, right.limit(0), "id", "place").count() == 0 and nearest_anywhere(left.limit(0), right, "id", "place").count() == 0


@pytest.mark.parametrize("radius", [None, 900.0, 3_000_000.0])
def test_nearest_is_that_of_all_pairs(spark, radius):
    """Clouds, one place with many rows, both poles and the date line; ties go to the least order."""
    from placeforge.functions.spatial import haversine_m, nearest

    draw = random.Random(4)

    def points(n):
        kinds = [lambda: (1.3 + draw.randint(0, 30) / 5000, 103.8 + draw.randint(0, 30) / 5000), lambda: (1.301, 103.801), lambda: (draw.choice([90.0, -90.0, 89.99]), draw.random() * 360 - 180), lambda: (10.0, draw.choice([180.0, -180.0, 179.999])), lambda: (draw.random() * 170 - 85, draw.random() * 360 - 180)]
        return [(i, *draw.choice(kinds)()) for i in range(n)]

    left = spark.createDataFrame([*points(150), (900, None, 1.0), (901, float("nan"), 1.0)], "a long, lat double, lng double")
    right = spark.createDataFrame([*points(260), (902, None, None)], "b long, r_lat double, r_lng double")
    every = left.where("a < 900").crossJoin(right.where("b < 900")).withColumn("d", haversine_m(F.col("lat"), F.col("lng"), F.col("r_lat"), F.col("r_lng")))
    best = (every if radius is None else every.where(F.col("d") <= radius)).groupBy("a").agg(F.min_by("b", F.struct("d", "b")).alias("b"), F.min("d").alias("d"))
    assert sorted((r.a, r.b, r.distance_m) for r in nearest(left, right, "a", "b", radius).collect()) == sorted(map(tuple, best.collect()))


def test_nearest_lists_no_pairs_of_far_clouds(spark):
    """4,000 places far from a cloud of 4,000: rings met all 16,000,000 pairs in the end; boxes leave a few for each place."""
    from placeforge.functions.descent import nearest_places

    left = spark.range(4000).select((40 + F.col("id") / 4000).alias("lat"), (F.col("id") * 37 % 4000 / 4000).alias("lng"))
    right = spark.range(4000).select(F.col("id").alias("b"), (F.col("id") * 7 % 4000 / 100_000 + 1.3).alias("r_lat"), (F.col("id") / 100_000 + 103.8).alias("r_lng"))
    found = nearest_places(left, right, "b", None)
    found.collect()
    rows = []
    stack = [found._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if node.nodeName().startswith(("ShuffleQueryStage", "ResultQueryStage")):
            node = node.plan()
        if "Join" in node.nodeName():
            rows.append(node.metrics().apply("numOutputRows").value())
        stack += [node.children().apply(k) for k in range(node.children().size())]
    assert rows and max(rows) < 200_000


def test_consolidation_pairs_of_copies_are_all_pairs(spark):
    """Rows alike in name, codes and place, more than a spot takes, one id twice, rows without a code, name or place."""
    draw = random.Random(6)
    rows = [(i, draw.choice(["ROSE MRT STATION", "ROSE LRT STATION", "HILL MRT STATION", None]), draw.choice([["A1"], ["A1", "B2"], ["C3"], [], None]), 1.3 + draw.choice([0, 0, 0.003, 0.01]), 103.8 + draw.choice([0, 0, 0.004])) for i in range(120)]
    rows += [(200, "ROSE MRT STATION", ["A1"], None, None), (5, "HILL MRT STATION", ["A1"], 1.3, 103.8)]
    for near_m, same_name_m in ((800.0, 300.0), (300.0, 1200.0)):
        expected = set()
        for i, name, codes, *p in rows:
            for j, other, more, *q in rows:
                if i < j and None not in (*p, *q):
                    base = lambda x: x and x.replace(" MRT STATION", "").replace(" LRT STATION", "")
                    d = metres((0, *p), (0, *q))
                    if d < near_m and (set(codes or []) & set(more or []) or (name and base(name) == base(other))) or d < same_name_m and name and name == other:
                        expected.add((i, j))
        got = C.consolidation_pairs(spark.createDataFrame(rows, "id long, name string, codes array<string>, lat double, lng double"), near_m, same_name_m, most=4).collect()
        assert expected and sorted(map(tuple, got)) == sorted(expected)


def test_joins_by_distance_broadcast_nothing(spark):
    """A right side that is repeated nine times is judged as small as its scan; it must not go through the driver."""
    from placeforge.functions.spatial import distance_join

    left = spark.range(500).select("id", (F.col("id") / 50_000 + 1.3).alias("lat"), F.lit(103.8).alias("lng"))
    pairs = distance_join(left, left.withColumnsRenamed({"id": "other", "lat": "r_lat", "lng": "r_lng"}), 100.0)
    assert pairs.count() and "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()


def _supplied(spark):
    names = ["ROSE", "ROSE HILL", None, ""]
    groups = spark.createDataFrame([(i, names[i % 4], 1.3 + i % 3 / 1000, 103.8) for i in range(40)] + [(50, "ROSE", None, 1.0)], "id long, name string, lat double, lng double")
    hits = spark.createDataFrame([(900 - j, ["HILL ROSE (NS1)", "ROSE (EW2)", None, "ROSE HILL"][j % 4], 1.3 + j % 5 / 400, 103.8) for j in range(100)], "r_key long, building string, r_lat double, r_lng double")
    return groups, hits


def test_hits_and_best_of_equal_places_are_those_of_all_pairs(spark):
    from placeforge.operators import resolve as R

    groups, hits = _supplied(spark)
    pairs = R.match_candidates(groups, hits)
    counted = pairs.groupBy("id").agg(F.count("*").alias("n_hits"), F.min("distance_m").alias("distance_m"))
    assert sorted(map(tuple, R.hits_in_range(groups, hits, "id").collect())) == sorted(map(tuple, counted.collect())) != []
    best = sorted(map(tuple, R.best_candidate(pairs, "id", "name", "building", "r_key").collect()), key=str)
    assert sorted(map(tuple, R.best_in_range(groups, hits, "id", "name", "building", "r_key").collect()), key=str) == best != []


def test_a_name_and_building_are_scored_once(spark, monkeypatch):
    """40 groups of 4 names and 100 hits of 4 buildings are some thousand pairs, but 16 texts."""
    from placeforge.operators import resolve as R

    seen, plain = spark.sparkContext.accumulator(0), R.name_score
    monkeypatch.setattr(R, "name_score", lambda a, b: plain(F.udf(lambda x: seen.add(1) or x)(a), b))
    groups, hits = _supplied(spark)
    R.best_candidate(R.match_candidates(groups, hits), "id", "name", "building", "r_key").collect()
    assert 0 < seen.value <= 16


def test_search_joins_two_words_where_both_are_in_every_hit(spark):
    """Names of two rare words and a common one against 900 titles of 30 x 30 words; titles longer than `long`, which go by one word, are found, too."""
    base = "https://x"
    pages = spark.range(900).select(F.concat(F.lit(f"{base}/a"), (F.col("id") % 30).cast("string"), F.lit("_b"), F.floor(F.col("id") / 30).cast("string"), F.lit("_stop")).alias("url"))
    names = spark.range(900).select("id", F.concat(F.lit("a"), (F.col("id") % 30).cast("string"), F.lit(" b"), F.floor(F.col("id") / 30).cast("string"), F.lit(" stop")).alias("name"))
    full = [search_titles(names, pages, "id", "name", base, 0.7, long) for long in (40, 2)]
    got = [sorted((r.id, r.search_url) for r in x.collect()) for x in full]
    assert got[0] == got[1] and got[0] == sorted((i, f"{base}/a{i % 30}_b{i // 30}_stop") for i in range(900))


def test_names_without_a_rare_word_of_a_title_meet_no_title(spark, monkeypatch):
    """800 names share two common words with all of 700 titles, but these weigh too little for a hit; one name more has a hit and alone asks."""
    from placeforge.operators import search

    seen, plain = {}, search.cut
    monkeypatch.setattr(search, "cut", lambda df, name: seen.setdefault(name, plain(df, name)))
    base = "https://x"
    pages = spark.range(700).select(F.concat(F.lit(f"{base}/of"), F.col("id").cast("string"), F.lit("_MRT_Station")).alias("url"))
    names = spark.range(800).select("id", F.concat(F.lit("by"), F.col("id").cast("string"), F.lit(" MRT STATION")).alias("name")).unionByName(spark.sql("SELECT 900L AS id, 'of7 MRT STATION' AS name"))
    found = search.search_titles(names, pages, "id", "name", base)
    assert [(r.id, r.search_url) for r in found.collect()] == [(900, f"{base}/of7_MRT_Station")]
    assert [r.asked for r in seen["probes"].collect()] == [["mrt", "of7", "station"]]


def test_links_and_components_broadcast_nothing(spark):
    """Tables that are written and read again are judged by their packed files; they must not go through the driver."""
    df = spark.range(300).select("id", F.lit("k").alias("key"), (F.col("id") / 50_000 + 1.3).alias("lat"), F.lit(103.8).alias("lng"))
    links = near_links(df, 30.0)
    for x in (links, C.components(df, links)):
        assert "Broadcast" not in x._jdf.queryExecution().executedPlan().toString()
