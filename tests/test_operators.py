"""Joins, components, merging, ledger, rules and sources on small tables, against brute force where there is one."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from placeforge import schemas
from placeforge.functions import spatial as G
from placeforge.operators import consolidate as C
from placeforge.operators import ledger as L
from placeforge.operators import merge as M
from placeforge.operators import pages as P
from placeforge.operators import quality as Q
from placeforge.operators import resolve as R
from placeforge.operators import responses as J
from placeforge.sources import io


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def test_distance_join_is_brute_force(spark):
    rng = random.Random(1)
    a = [(i, 1.2 + rng.random() * 0.1, 103.6 + rng.random() * 0.1) for i in range(60)]
    b = [(i, 1.2 + rng.random() * 0.1, 103.6 + rng.random() * 0.1) for i in range(200)]
    got = G.distance_join(spark.createDataFrame(a, "i long, lat double, lng double"), spark.createDataFrame(b, "j long, r_lat double, r_lng double"), 800.0)
    assert {(r.i, r.j) for r in got.collect()} == {(x[0], y[0]) for x in a for y in b if metres(x[1:], y[1:]) <= 800}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_components_are_union_find(spark):
    rng = random.Random(2)
    n, edges = 80, [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]
    root = list(range(n))
    for _ in range(n):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    pairs = spark.createDataFrame([(min(e), max(e)) for e in edges if e[0] != e[1]], "id long, other long").distinct()
    got = {r.id: r.root for r in C.components(spark.range(n), pairs).collect()}
    assert got == dict(enumerate(root))


def test_containment_anti_join(spark):
    a, b = ["Alpha Beta LRT STATION", "AB", None, "Q MRT STATION"], ["alpha MRT STATION", "gamma MRT STATION", "xABx", "q MRT STATION", "AL"]
    df = lambda v: spark.createDataFrame([(x,) for x in v], "name string")
    dg = [x.upper().replace(" LRT STATION", " MRT STATION") for x in a if x]

    def base(x):
        for s in (" MRT/LRT STATION", " MRT STATION", " LRT STATION", " STATION"):
            x = x.replace(s, "")
        return x.strip()

    want = {x for x in b if not any(base(x.upper()) in g or g in x.upper() for g in dg)}
    assert {r.name for r in R.containment_anti_join(df(b), df(a)).collect()} == want


def test_merge_exits_last_wins_and_never_adds(spark):
    exits = "array<struct<exit_code:string,lat:double,lng:double>>"
    e = spark.createDataFrame([("S1", [("Exit A", 1.3, 103.8), ("", 1.3, 103.8), ("B", 1.3, 103.8)])], f"station_id string, exits {exits}")
    rich = [("a", None, ["old"], [], None), ("EXIT A", [("1", "NS1", "NSL")], ["new"], [], []), ("C", None, ["x"], None, None)]
    n = spark.createDataFrame([("S1", "success", rich, ["note"], None)], f"station_id string, extraction_result string, exits array<{schemas.ENRICHED_EXIT}>, accessibility_notes array<string>, extraction_timestamp timestamp")
    row = M.merge_entities(e, n).first()
    assert [x.exit_code for x in row.exits] == ["Exit A", "B"]
    assert row.exits[0].accessibility == ["new"] and row.exits[0].bus_stops is None and row.exits[1].accessibility is None
    assert row.lines_served == ["NSL"] and row.accessibility_notes == ["note"]
    failed = M.merge_entities(e, n.withColumn("extraction_result", F.lit("failed"))).first()
    assert failed.lines_served is None and failed.exits[0].accessibility is None


def test_ledger(spark):
    schema = "entity_id string, status string, permanent boolean, attempts int, error string, reason string, ts timestamp"
    at = lambda k: __import__("datetime").datetime(2024, 1, 1, 0, k)
    led = spark.createDataFrame([("NS1", "success", False, 1, None, None, at(0)), ("NS2", "failed", True, 3, "x", None, at(0)), ("NS3", "failed", False, 1, "x", None, at(0))], schema)
    own = spark.createDataFrame([("NS1",), ("NS2",), ("NS3",), ("NS4",)], "entity_id string")
    ids = lambda df: sorted(r.entity_id for r in df.collect())
    assert ids(L.select_pending(own, led, "fresh")) == ["NS1", "NS2", "NS3", "NS4"]
    assert ids(L.select_pending(own, led, "resume")) == ["NS3", "NS4"]
    assert ids(L.select_pending(own, led, "retry")) == ["NS2", "NS3", "NS4"]
    new = L.apply_outcomes(led, spark.createDataFrame([("NS3", "failed", False, 1, "y", None, at(1)), ("NS2", "skipped", False, 0, None, "gone", at(1))], schema))
    rows = {r.entity_id: (r.status, r.attempts) for r in new.collect()}
    assert rows == {"NS1": ("success", 1), "NS2": ("skipped", 0), "NS3": ("failed", 2)}
    assert L.broken_disjointness(new).count() == 0
    turns = [("NS3", "success", False, 1, None, None, at(2)), ("NS3", "failed", False, 1, "z", None, at(3)), ("NS2", "failed", False, 1, "z", None, at(3))]
    rows = {r.entity_id: (r.status, r.attempts) for r in L.apply_outcomes(new, spark.createDataFrame(turns, schema)).collect()}
    assert rows == {"NS1": ("success", 1), "NS2": ("failed", 1), "NS3": ("failed", 1)}  # attempts count since the success or skip


def test_rules(spark):
    good = ("NS13", "YISHUN MRT STATION", "Yishun", ["NS13"], ["NSL"], "mrt", [("A", 1.429, 103.835, "onemap")], "u", "pending")
    bad = ("invalid", "X", "X", [], ["NSL"], "bus", [("A", 0.0, 100.0, "odd")], "u", "pending")
    ok, out = Q.quarantine(spark.createDataFrame([good, bad], schemas.ENTITY), schemas.ENTITY_RULES)
    assert [r.station_id for r in ok.collect()] == ["NS13"]
    assert set(out.first().violations) == {"station_id", "official_name", "mrt_codes", "station_type", "exit_bounds", "exit_source"}


def test_digest_is_brute_force(spark):
    rows = [str(i % 7) for i in range(40)]
    hashes = {}
    for r in rows:
        h = hashlib.sha256(r.encode()).hexdigest()
        hashes[h] = hashes.get(h, 0) + 1
    level = {}
    for h, c in hashes.items():
        level.setdefault(h[:4], []).append(f"{h}:{c}")
    level = {k: hashlib.sha256("".join(sorted(v)).encode()).hexdigest() for k, v in level.items()}
    up = {}
    for k in sorted(level):
        up.setdefault(k[:2], []).append(level[k])
    top = "".join(hashlib.sha256("".join(up[k]).encode()).hexdigest() for k in sorted(up))
    got = Q.dataset_digest(spark.createDataFrame([(r,) for r in rows], "s string").repartition(3), F.col("s")).first()
    assert got.digest == hashlib.sha256(top.encode()).hexdigest() and got.n_bytes == 40


def test_sections(spark):
    html = "<body><nav><h2>Exits</h2></nav><h2>Station Exits</h2><p>Exit A here</p><h3>Random Section</h3><p>x</p><h2>Nearby Bus Stops</h2><table><tr><td>Service 14</td></tr></table></body>"
    pages = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "<h2>unclosed")], "page_id long, url string, html string")
    routed = P.routed_sections(P.sections(pages))
    got = {(r.page_id, r.section, r.text) for r in routed.collect()}
    assert (1, "exits", "Exit A here") in got and (1, "page", "") in got and (1, "other", "x") in got and (1, "bus_stops", "Service 14") in got
    out = {r.page_id: r.content for r in P.format_sections(routed, pages.select("page_id", F.lit("N").alias("name"))).collect()}
    assert out[1] == "<h1>N</h1> <h2>Exits</h2> <p>Exit A here</p> <h2>Bus Stops</h2> <table><tr><td>Service 14</td></tr></table>" and out[2] == out[3] == ""


def test_noise_and_containers(spark):
    cases = {
        '<nav>a<nav>b</nav>c</nav>d<div class="x ad-slot">e<div>f</div></div>g': ("dg", None),
        '<body>a<p class="content">b</p><article>c<article>d</article>e</article></body>': ('<body>a<p class="content">b</p><article>c<article>d</article>e</article></body>', "c<article>d</article>e"),
        '<body><article>c</article><div class="mw-parser-output">m<aside>n</aside>o</div></body>': ('<body><article>c</article><div class="mw-parser-output">mo</div></body>', "mo"),
        '<body><div id="content">\nb<br/>c<p title="a > b">d</div></body>': ('<body><div id="content">\nb<br/>c<p title="a > b">d</div></body>', '\nb<br/>c<p title="a > b">d'),
        "a<script>1 < 2</script>b<header>c": ("ab", None),
        "": ("", None),
        None: (None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "h string").select("h", P.strip_noise(F.col("h")).alias("s"), P.main_content(F.col("h")).alias("m"))
    assert {r.h: (r.s, r.m) for r in df.collect()} == cases


def test_responses(spark):
    cases = {'```json\n{"exits": [{"exit_code": "A", "bus_stops": [{"code": "1"}]}]}\n```': True, "no": False, '{"x": 1}': False, '{"exits": "A"}': False, '{"exits": [{"code": "A"}]}': False, '{"exits": [{"exit_code": "A", "bus_stops": [{"x": 1}]}]}': False, '{"exits": []}': True}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.ok for r in df.select("s", J.response_is_valid(J.parse_response(F.col("s"))).alias("ok")).collect()}
    assert got == cases


def test_geojson_and_state(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"features": [{"properties": {"STATION_NA": "X", "EXIT_CODE": "A"}, "geometry": {"coordinates": [103.8, 1.3]}}, {"properties": {"EXIT_CODE": "B"}}]}')
    rows = io.read_geojson(spark, str(tmp_path / "g.json")).orderBy("ord").collect()
    assert (rows[0].latitude, rows[0].longitude, rows[1].latitude, rows[1].station_na) == (1.3, 103.8, 0.0, None)
    assert io.read_state(spark, str(tmp_path / "none")) is None
    io.write_state(spark.range(3), str(tmp_path / "s"), 1)
    io.write_state(spark.range(0), str(tmp_path / "s"), 2)
    assert io.read_state(spark, str(tmp_path / "s")).count() == 3


def test_distance_join_anywhere_on_the_globe(spark):
    import random
    from math import asin, cos, radians, sin, sqrt

    from placeforge.functions import spatial as G

    rng = random.Random(4)
    places = [(i, lat + rng.uniform(-0.02, 0.02), (lng + rng.uniform(-0.02, 0.02) + 180) % 360 - 180) for i, (lat, lng) in enumerate([(1.3, 103.8), (0.0, 180.0), (75.0, -180.0), (-89.99, 40.0), (89.985, -120.0), (60.0, 0.0)] * 40)]
    places = [(i, max(-90.0, min(90.0, lat)), lng) for i, lat, lng in places] + [(1000 + k, 89.995, -180.0 + 15 * k) for k in range(24)]
    far = lambda a, b: 2 * 6_371_000.0 * asin(min(1, sqrt(sin(radians(b[1] - a[1]) / 2) ** 2 + cos(radians(a[1])) * cos(radians(b[1])) * sin(radians(b[2] - a[2]) / 2) ** 2)))
    left = spark.createDataFrame(places, "id long, lat double, lng double")
    right = left.toDF("r_id", "r_lat", "r_lng")
    got = [(r.id, r.r_id) for r in G.distance_join(left, right, 800.0).collect()]
    want = {(a[0], b[0]) for a in places for b in places if far(a, b) <= 800.0}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > len(places)


def test_extract_with_goes_on_behind_a_bad_row(spark):
    from placeforge.operators import responses as J

    def fn(prompts):
        if any("bad" in p for p in prompts):
            raise ValueError("no")
        return [p.upper() for p in prompts]

    rows = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "id long, prompt string").coalesce(1)
    assert [(r.id, r.response, r.error) for r in J.extract_with(rows, fn, "id").orderBy("id").collect()] == [(1, "A", None), (2, None, "no"), (3, "C", None)]


def test_pages_of_one_partition_are_dealt_and_parsed_once(spark):
    """A small file is one partition however many pages it holds; parsing is dealt to tasks, happens once, and leaves in batches of many pages."""
    html = F.concat(F.lit("<body><h2>Exits</h2><p>Exit "), F.col("page_id").cast("string"), F.lit("</p><table><tr><td>exit</td></tr></table></body>"))
    pages = spark.range(400).coalesce(1).withColumnRenamed("id", "page_id").withColumn("html", html)
    found = P.sections(pages)
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    routed = P.routed_sections(found)
    assert routed._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert routed.groupBy("section").count().where("section in ('page', 'exits')").agg(F.sum("count")).first()[0] == 1200


def test_page_parts_leave_arrow_batches_alone(spark):
    """An Arrow batch of 10,000 pages lies in Python with both results; rows that come by the hundred do not."""
    df = spark.createDataFrame([("<body>a<nav>b</nav></body>",)], "h string").select(P.strip_noise(F.col("h")).alias("s"), P.main_content(F.col("h")).alias("m"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython") == 1 and "ArrowEvalPython" not in plan
