"""Driver queries over the given tables, each beside the SQL that must give the same rows.

The tables have no coordinates or codes; both sides derive them from keys in the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placeforge.functions import scalars as S
from placeforge.functions.canonical import canonical_json, check_sealed, sealed
from placeforge.functions import spatial as G
from placeforge.operators import consolidate as C
from placeforge.operators import ledger as L
from placeforge.operators import merge as M
from placeforge.operators import pages as P
from placeforge.operators import quality as Q
from placeforge.operators import resolve as R
from placeforge.operators.near import near_links
from placeforge.operators import responses as J
from placeforge.operators import rules as V
from placeforge.schemas import ENRICHED_EXIT, ENRICHMENT_FIELDS, ENRICHMENT_RULES, ENTITY, ENTITY_FIELDS, ENTITY_RULES
from placeforge.sources import io, state

BASE_URL = "https://wiki.example.org/wiki"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def lat(k: Column) -> Column:
    return F.lit(1.2) + (k * 7919 % 3000) / 10000


def lng(k: Column) -> Column:
    return F.lit(103.6) + (k * 104729 % 4000) / 10000


def sql_point(k: str) -> str:
    return f"1.2 + (({k} * 7919) % 3000) / 10000.0::DOUBLE AS lat, 103.6 + (({k} * 104729) % 4000) / 10000.0::DOUBLE AS lng"


def sql_m(a: str, b: str) -> str:
    h = f"(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2))"
    return f"(2 * 6371000.0 * atan2(sqrt({h}), sqrt(1 - {h})))"


def _points(df: DataFrame, key: str, *cols: str, prefix: str = "") -> DataFrame:
    return df.select(key, *cols, lat(F.col(key)).alias(f"{prefix}lat"), lng(F.col(key)).alias(f"{prefix}lng"))


SUPPLIERS = f"s AS (SELECT s_suppkey, s_name, {sql_point('s_suppkey')} FROM supplier)"
PARTS = f"p AS (SELECT p_partkey, p_name, p_brand, {sql_point('p_partkey')} FROM part)"


@query(f"""WITH {SUPPLIERS}, {PARTS}, m AS (SELECT s_suppkey, p_partkey, {sql_m('s', 'p')} AS d FROM s, p WHERE abs(s.lat - p.lat) < 0.01 AND abs(s.lng - p.lng) < 0.01)
SELECT s_suppkey, count(*) AS n_hits, cast(round(min(d)) AS BIGINT) AS nearest_m FROM m WHERE d <= 800 GROUP BY s_suppkey""")
def match_radius(spark, d):
    """J2, F12."""
    found = R.hits_in_range(_points(t(spark, d, "supplier"), "s_suppkey"), _points(t(spark, d, "part"), "p_partkey", prefix="r_"), "s_suppkey")
    return found.select("s_suppkey", "n_hits", F.round("distance_m").cast("long").alias("nearest_m"))


@query("SELECT s_name AS station_na, cast(s_suppkey % 7 AS VARCHAR) AS exit_code, CASE WHEN s_suppkey % 5 = 0 THEN 0.0 ELSE s_suppkey / 100.0::DOUBLE END AS latitude, CASE WHEN s_suppkey % 5 = 0 THEN 0.0 ELSE s_suppkey / 10.0::DOUBLE END AS longitude FROM supplier")
def geojson_flatten(spark, d):
    """SRC1."""
    k = F.col("s_suppkey")
    coords = F.when(k % 5 != 0, F.struct(F.array(k / 10.0, k / 100.0).alias("coordinates")))
    doc = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("s_name").alias("STATION_NA"), (k % 7).cast("string").alias("EXIT_CODE")).alias("properties"), coords.alias("geometry"))).alias("features")))
    return io.flatten_features(t(spark, d, "supplier").select(io.parse_geojson(doc).alias("x")).select("x.features")).drop("ord")


_BUILDING = "upper(p_name) || ' MRT STATION (' || CASE WHEN p_partkey % 3 = 0 THEN 'A1' ELSE list_element(['NS', 'EW', 'DT', 'BP'], (p_partkey % 4 + 1)::INT) || (p_partkey % 40) END || ')'"


def _hits(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    code = F.when(k % 3 == 0, "A1").otherwise(F.concat(F.element_at(F.array(*map(F.lit, ("NS", "EW", "DT", "BP"))), (k % 4 + 1).cast("int")), (k % 40).cast("string")))
    return t(spark, d, "part").select("p_partkey", F.concat(F.upper("p_name"), F.lit(" MRT STATION ("), code, F.lit(")")).alias("building"), lat(k).alias("latitude"), lng(k).alias("longitude"), k.alias("ord"))


@query(f"""WITH h AS (SELECT p_partkey, {_BUILDING} AS building FROM part),
e AS (SELECT *, trim(regexp_replace(building, '\\(.*?\\)', '', 'g')) AS name, list_sort(list_distinct(regexp_extract_all(building, '\\b((?:NS|EW|NE|CC|CE|DT|TE|CG|BP|SW|SE|PW|PE|STC|PTC)\\d+)\\b', 1))) AS codes FROM h WHERE contains(building, 'MRT STATION'))
SELECT name, array_to_string(codes, ',') AS codes, p_partkey FROM e WHERE len(codes) > 0 QUALIFY row_number() OVER (PARTITION BY name ORDER BY p_partkey) = 1""")
def gazetteer_entities(spark, d):
    """SRC4, P3, F4, F8."""
    return R.gazetteer_entities(_hits(spark, d)).select("name", F.array_join("codes", ",").alias("codes"), "p_partkey")


_EXITS = "SELECT s_suppkey AS ord, 'N' || (s_suppkey % 40) AS name, CASE WHEN s_suppkey % 4 = 0 THEN chr((65 + s_suppkey % 3)::INT) ELSE cast(s_suppkey % 16 AS VARCHAR) END AS exit_code FROM supplier"


@query(f"""WITH x AS ({_EXITS}), e AS (SELECT DISTINCT 'N' || (p_partkey % 60) AS name FROM part), f AS (SELECT x.name, exit_code, ord, 'found' AS origin FROM x SEMI JOIN e USING (name) WHERE ord % 4 = 0),
pr AS (SELECT name, exit_code, min(ord) AS ord, 'probed' AS origin FROM x WHERE ord % 4 <> 0 AND try_cast(exit_code AS INT) BETWEEN 1 AND 14 AND name IN (SELECT name FROM e) AND name NOT IN (SELECT name FROM f) GROUP BY ALL),
b AS (SELECT e.name, 'A' AS exit_code, -1::BIGINT AS ord, 'bare' AS origin FROM e WHERE name NOT IN (SELECT name FROM f) AND name NOT IN (SELECT name FROM pr))
SELECT * FROM f UNION ALL SELECT * FROM pr UNION ALL SELECT * FROM b""")
def gazetteer_exits(spark, d):
    """SRC5, SRC6, SRC7."""
    k = F.col("s_suppkey")
    code = F.when(k % 4 == 0, F.chr(65 + k % 3)).otherwise((k % 16).cast("string"))
    hits = t(spark, d, "supplier").select(F.concat(F.lit("N"), (k % 40).cast("string"), F.lit(" EXIT "), code).alias("building"), lat(k).alias("latitude"), lng(k).alias("longitude"), k.alias("ord"))
    entities = t(spark, d, "part").select(F.concat(F.lit("N"), (F.col("p_partkey") % 60).cast("string")).alias("name")).distinct()
    found = R.gazetteer_exits(hits.where("ord % 4 = 0"), entities)
    probed = R.probe_numbered_exits(entities, found, hits.where("ord % 4 <> 0"))
    have = found.select("name", "exit_code", "ord").withColumn("origin", F.lit("found")).unionByName(probed.select("name", "exit_code", "ord").withColumn("origin", F.lit("probed")))
    lacking = entities.join(have.select("name").distinct(), "name", "left_anti").select("name", F.array(F.lit("X1")).alias("codes"), F.lit(1.0).alias("lat"), F.lit(103.0).alias("lng"))
    bare = R.missing_exit_rows(lacking, found.select("name", "exit_code", "latitude", "longitude"))
    return have.unionByName(bare.select("name", "exit_code", F.lit(-1).cast("long").alias("ord"), F.lit("bare").alias("origin")))


@query("""WITH a AS (SELECT DISTINCT replace(upper(c_mktsegment) || ' ' || c_nationkey % 6 || ' LRT STATION', ' LRT STATION', ' MRT STATION') AS dg FROM customer),
b AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'building ' || s_suppkey % 9 || ' MRT STATION' WHEN s_suppkey % 3 = 1 THEN 'zone ' || s_suppkey || ' LRT STATION' ELSE 'new automobile ' || s_suppkey % 8 || ' MRT STATION' END AS name FROM supplier),
m AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE contains(dg, trim(replace(replace(upper(b.name), ' MRT STATION', ''), ' LRT STATION', ''))) OR contains(upper(b.name), dg)))
SELECT name, s_suppkey, 'b' AS origin FROM m UNION ALL SELECT dg AS name, -1::BIGINT AS s_suppkey, 'a' AS origin FROM a""")
def source_union(spark, d):
    """U1, J1, F23."""
    a = t(spark, d, "customer").select(F.concat("c_mktsegment", F.lit(" "), (F.col("c_nationkey") % 6).cast("string"), F.lit(" LRT STATION")).alias("name"))
    k = F.col("s_suppkey")
    s = lambda c: c.cast("string")
    b = t(spark, d, "supplier").select(k, F.when(k % 3 == 0, F.concat(F.lit("building "), s(k % 9), F.lit(" MRT STATION"))).when(k % 3 == 1, F.concat(F.lit("zone "), s(k), F.lit(" LRT STATION"))).otherwise(F.concat(F.lit("new automobile "), s(k % 8), F.lit(" MRT STATION"))).alias("name"))
    missing = R.containment_anti_join(b, a).select("name", "s_suppkey", F.lit("b").alias("origin"))
    return R.augment(missing, a.select(S.source_name(F.col("name")).alias("name")).distinct().select("name", F.lit(-1).cast("long").alias("s_suppkey"), F.lit("a").alias("origin")))


@query(f"""WITH o AS (SELECT o_custkey, o_orderkey, {sql_point('o_orderkey')} FROM orders)
SELECT o_custkey, round(avg(lat) + 1e-9, 6) AS lat, round(avg(lng) + 1e-9, 6) AS lng, string_agg(cast(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS exits FROM o GROUP BY o_custkey""")
def group_centroid(spark, d):
    """A1, A2."""
    o = _points(t(spark, d, "orders"), "o_orderkey", "o_custkey")
    c = C.centroid(o, "o_custkey").join(C.group_exits(o, "o_custkey", "o_orderkey", ["o_orderkey"]), "o_custkey")
    return c.select("o_custkey", F.round(F.col("lat") + 1e-9, 6).alias("lat"), F.round(F.col("lng") + 1e-9, 6).alias("lng"), F.array_join(F.transform("exits", lambda x: x["o_orderkey"].cast("string")), ",").alias("exits"))


_NAMES = ("SMALL RING", "HOT BOLT MRT STATION", "RING OF SMALL THINGS", "GEAR GREEN", "OLD ANVIL LRT STATION (BP6) BY THE NEW WIDGET PLATE", "R", "")
#: The longest common subsequence of x and y as the table of its lengths, row by row.
_LCS = """coalesce(list_last(list_reduce(list_prepend(list_transform(range(0, length(x) + 1), lambda i: 0::BIGINT), list_transform(string_split(y, ''), lambda c: [ord(c)::BIGINT])),
lambda above, c: list_reduce(list_prepend([0::BIGINT], list_transform(range(1, length(x) + 1), lambda i: [i])), lambda own, i: list_append(own, CASE WHEN ord(substr(x, i[1], 1)) = c[1] THEN above[i[1]] + 1 ELSE greatest(above[i[1] + 1], own[-1]) END)))), 0)"""


@query(f"""WITH {SUPPLIERS}, {PARTS}, m AS (SELECT s_suppkey, p_partkey, list_element({list(_NAMES)}, s_suppkey % 7 + 1) AS a, upper(p_name) || CASE p_partkey % 3 WHEN 0 THEN ' MRT STATION' WHEN 1 THEN ' RING RING' ELSE '' END AS b FROM s, p WHERE abs(s.lat - p.lat) < 0.01 AND abs(s.lng - p.lng) < 0.01 AND {sql_m('s', 'p')} <= 800),
w AS (SELECT a, b, list_sort(list_filter(string_split(a, ' '), lambda z: z <> '')) AS ta, list_sort(list_filter(string_split(b, ' '), lambda z: z <> '')) AS tb FROM (SELECT DISTINCT a, b FROM m) WHERE a <> '' AND b <> ''),
v AS (SELECT *, array_to_string(ta, ' ') AS ja, array_to_string(tb, ' ') AS jb, array_to_string(list_sort(list_distinct(list_filter(ta, lambda z: list_contains(tb, z)))), ' ') AS k, array_to_string(list_sort(list_distinct(list_filter(ta, lambda z: NOT list_contains(tb, z)))), ' ') AS da, array_to_string(list_sort(list_distinct(list_filter(tb, lambda z: NOT list_contains(ta, z)))), ' ') AS db, len(list_distinct(ta)) < len(ta) OR len(list_distinct(tb)) < len(tb) AS twice, greatest(length(a), length(b))::DOUBLE / least(length(a), length(b)) AS times FROM w),
f AS (SELECT a, b, 'whole' AS kind, a AS x, b AS y FROM v UNION ALL SELECT a, b, 'sorted', ja, jb FROM v UNION ALL SELECT a, b, 'rest', da, db FROM v),
c AS (SELECT a, b, kind, length(x) AS nx, length(y) AS ny, CASE WHEN x = '' OR y = '' THEN 0 ELSE {_LCS} END AS n FROM f),
u AS (SELECT a, b, kind, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS x, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS t FROM f UNION SELECT a, b, kind, y, x FROM f WHERE length(x) = length(y)),
g AS (SELECT a, b, kind, x, substr(t, greatest(i, 0)::INT + 1, (least(i, 0) + length(x))::INT) AS y FROM (SELECT *, unnest(range(1 - length(x), length(t))) AS i FROM u WHERE x <> '')),
e AS (SELECT a, b, kind, max(200.0::DOUBLE * {_LCS} / (length(x) + length(y))) AS best FROM g GROUP BY a, b, kind),
h AS (SELECT v.*, length(k) AS n, CASE WHEN k <> '' THEN 1 ELSE 0 END AS gap, (SELECT 200.0::DOUBLE * c.n / (nx + ny) FROM c WHERE c.a = v.a AND c.b = v.b AND kind = 'whole') AS whole, (SELECT 200.0::DOUBLE * c.n / (nx + ny) FROM c WHERE c.a = v.a AND c.b = v.b AND kind = 'sorted') AS in_order, (SELECT nx + ny - 2 * c.n FROM c WHERE c.a = v.a AND c.b = v.b AND kind = 'rest') AS apart,
(SELECT best FROM e WHERE e.a = v.a AND e.b = v.b AND kind = 'whole') AS part, (SELECT best FROM e WHERE e.a = v.a AND e.b = v.b AND kind = 'sorted') AS part_sorted, coalesce((SELECT best FROM e WHERE e.a = v.a AND e.b = v.b AND kind = 'rest'), 0) AS part_rest FROM v),
y AS (SELECT a, b, CASE WHEN times < 1.5 THEN greatest(whole, 0.95::DOUBLE * CASE WHEN k <> '' AND (da = '' OR db = '') THEN 100 ELSE greatest(in_order, 100 - 100.0::DOUBLE * apart / (2 * (n + gap) + length(da) + length(db)), CASE WHEN k <> '' THEN greatest(100 - 100.0::DOUBLE * (1 + length(da)) / (2 * n + 1 + length(da)), 100 - 100.0::DOUBLE * (1 + length(db)) / (2 * n + 1 + length(db))) ELSE 0 END) END)
ELSE greatest(whole, part * s, 0.95::DOUBLE * s * CASE WHEN k <> '' THEN 100 ELSE greatest(part_sorted, CASE WHEN twice THEN part_rest ELSE 0 END) END) END AS score FROM (SELECT *, CASE WHEN times <= 8 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS s FROM h))
SELECT s_suppkey, m.b AS matched_name, round(coalesce(score, 0), 6) AS score FROM m LEFT JOIN y ON m.a = y.a AND m.b = y.b QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY round(coalesce(score, 0), 6) DESC, p_partkey) = 1""")
def best_match(spark, d):
    """Scores of names of all length ratios against the written-out table."""
    k = F.col("r_key")
    own = _points(t(spark, d, "supplier"), "s_suppkey").withColumn("name", F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("s_suppkey") % 7 + 1).cast("int")))
    hits = _points(t(spark, d, "part"), "p_partkey", "p_name", prefix="r_").withColumnRenamed("p_partkey", "r_key").withColumn("building", F.concat(F.upper("p_name"), F.when(k % 3 == 0, " MRT STATION").when(k % 3 == 1, " RING RING").otherwise("")))
    return R.best_in_range(own, hits, "s_suppkey", "name", "building", "r_key").select("s_suppkey", "matched_name", F.round("score", 6).alias("score"))


@query(f"""WITH c AS (SELECT c_custkey, {sql_point('c_custkey')} FROM customer WHERE c_custkey % 3 <> 0), {SUPPLIERS},
m AS (SELECT c_custkey, s_suppkey, {sql_m('c', 's')} AS d FROM c, s WHERE abs(c.lat - s.lat) < 0.03 AND abs(c.lng - s.lng) < 0.03)
SELECT c_custkey, s_suppkey, cast(round(d) AS BIGINT) AS distance_m FROM m WHERE d <= 2000 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) = 1""")
def nearest_fallback(spark, d):
    """J4, P7."""
    c = _points(t(spark, d, "customer"), "c_custkey")
    matched = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit("X"))).otherwise(F.array().cast("array<string>")).alias("codes"))
    return R.nearest_fallback(R.drop_unresolved(matched), c, _points(t(spark, d, "supplier"), "s_suppkey", prefix="r_"), "c_custkey", "s_suppkey", 2000.0).select("c_custkey", "s_suppkey", F.round("distance_m").cast("long").alias("distance_m"))


_FAR = "c_custkey % 11 * 30 - 150 + c_custkey % 7"


@query(f"""WITH c AS (SELECT c_custkey, (c_custkey % 13 * 13 - 80)::DOUBLE AS lat, ({_FAR})::DOUBLE AS lng FROM customer WHERE c_custkey % 3 <> 0), {SUPPLIERS}, m AS (SELECT c_custkey, s_suppkey, {sql_m('c', 's')} AS d FROM c, s)
SELECT c_custkey, s_suppkey, cast(round(d) AS BIGINT) AS distance_m FROM m QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) = 1""")
def nearest_anywhere(spark, d):
    """Groups all around the globe take the nearest place, in rings that grow."""
    k = F.col("c_custkey")
    c = t(spark, d, "customer").select(k, (k % 13 * 13 - 80).cast("double").alias("lat"), (k % 11 * 30 - 150 + k % 7).cast("double").alias("lng"))
    matched = c.where(k % 3 == 0).select("c_custkey", F.array(F.lit("X")).alias("codes"))
    return R.nearest_fallback(matched, c, _points(t(spark, d, "supplier"), "s_suppkey", prefix="r_"), "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey", F.round("distance_m").cast("long").alias("distance_m"))


@query("""SELECT p_brand, array_to_string(list_sort(list_distinct(flatten(list(regexp_extract_all(upper('ns' || p_partkey % 9 || ' x, dt, a1 ' || p_size), '\\b((?:NS|EW|NE|CC|CE|DT|TE|CG|BP|SW|SE|PW|PE|STC|PTC)\\d*)\\b', 1))))), ',') AS codes FROM part GROUP BY p_brand""")
def codes_union(spark, d):
    """A3, F7, O2."""
    text = F.concat(F.lit("ns"), (F.col("p_partkey") % 9).cast("string"), F.lit(" x, dt, a1 "), F.col("p_size").cast("string"))
    return C.union_codes(t(spark, d, "part").select("p_brand", S.codes_loose(text).alias("codes")), "p_brand", "codes").select("p_brand", F.array_join("codes", ",").alias("codes"))


_ENTITY = f"e AS (SELECT p_partkey AS id, upper(p_name) || CASE WHEN p_partkey % 2 = 0 THEN ' MRT STATION' ELSE ' LRT STATION' END AS full_name, upper(p_name) AS base, 'NS' || p_partkey % 50 AS code, {sql_point('p_partkey')} FROM part)"
_PAIRS = f"pairs AS (SELECT a.id, b.id AS other FROM e a JOIN e b ON a.id < b.id AND abs(a.lat - b.lat) < 0.01 AND abs(a.lng - b.lng) < 0.01 WHERE ((a.code = b.code OR a.base = b.base) AND {sql_m('a', 'b')} < 800) OR (a.full_name = b.full_name AND {sql_m('a', 'b')} < 300))"


def _entities(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    return t(spark, d, "part").select(k.alias("id"), F.concat(F.upper("p_name"), F.when(k % 2 == 0, " MRT STATION").otherwise(" LRT STATION")).alias("name"), F.array(F.concat(F.lit("NS"), (k % 50).cast("string"))).alias("codes"), lat(k).alias("lat"), lng(k).alias("lng"))


@query(f"WITH {_ENTITY}, {_PAIRS} SELECT id, other FROM pairs")
def consolidation_pairs(spark, d):
    """J5."""
    return C.consolidation_pairs(_entities(spark, d))


_DENSE = f"d AS (SELECT o_orderkey AS id, o_orderpriority AS key, 1.3 + (o_orderkey * 7919 % 401) / 401.0::DOUBLE * 0.03 AS lat, 103.8 + (o_orderkey * 104729 % 389) / 389.0::DOUBLE * (CASE WHEN o_custkey % 2 = 0 THEN 0.004 ELSE 0.05 END) AS lng FROM orders WHERE o_orderkey % 8 = 1)"


@query(f"""WITH RECURSIVE {_DENSE}, linked AS (SELECT a.id AS a, b.id AS b FROM d a JOIN d b ON a.key = b.key AND a.id <> b.id AND abs(a.lat - b.lat) < 0.002 AND abs(a.lng - b.lng) < 0.002 WHERE {sql_m('a', 'b')} < 60),
reach AS (SELECT id, id AS r FROM d UNION SELECT reach.id, linked.b FROM reach JOIN linked ON reach.r = linked.a) SELECT id, min(r) AS root FROM reach GROUP BY id""")
def near_groups(spark, d):
    """What hangs together by steps under 60 m, in cells of many points of one key."""
    k = F.col("o_orderkey")
    wide = F.when(F.col("o_custkey") % 2 == 0, 0.004).otherwise(0.05)
    points = t(spark, d, "orders").where(k % 8 == 1).select(k.alias("id"), F.col("o_orderpriority").alias("key"), (F.lit(1.3) + (k * 7919 % 401) / 401.0 * 0.03).alias("lat"), (F.lit(103.8) + (k * 104729 % 389) / 389.0 * wide).alias("lng"))
    return C.components(points, near_links(points, 60.0))


@query(f"""WITH RECURSIVE {_ENTITY}, {_PAIRS}, linked AS (SELECT id AS a, other AS b FROM pairs UNION SELECT other, id FROM pairs), reach AS (SELECT id, id AS r FROM e UNION SELECT reach.id, linked.b FROM reach JOIN linked ON reach.r = linked.a), roots AS (SELECT id, min(r) AS root FROM reach GROUP BY id)
SELECT root, min_by(full_name, e.id) AS name, array_to_string(list_sort(list_distinct(list(code))), ',') AS codes, count(DISTINCT 'X' || e.id % 4) AS n_exits FROM roots JOIN e USING (id) GROUP BY root""")
def consolidate(spark, d):
    """A4, W1, O1."""
    e = _entities(spark, d)
    x = e.select("id", F.concat(F.lit("Exit X"), (F.col("id") % 4).cast("string")).alias("exit_code"), "lat", "lng", F.col("id").alias("ord"))
    return C.consolidate(e, x).select("root", "name", F.array_join("codes", ",").alias("codes"), F.size("exits").cast("long").alias("n_exits"))


_HUB = "SELECT n_nationkey, n_name || ' MRT STATION' AS official_name, [list_element(['NS', 'BP', 'PE', 'DT'], n_nationkey % 4 + 1) || n_nationkey] AS codes FROM nation"


@query(f"""WITH h AS ({_HUB}), u AS (SELECT n_nationkey, official_name, CASE WHEN n_nationkey % 5 = 0 THEN list_sort(list_distinct(list_concat(codes, ['STC', 'NE1']))) ELSE codes END AS codes FROM h)
SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN replace(official_name, ' MRT', ' MRT/LRT') ELSE official_name END AS official_name, array_to_string(codes, ',') AS codes,
array_to_string(list_sort(list_distinct(list_transform(codes, lambda c: CASE WHEN c = 'STC' THEN 'SKL' ELSE list_element(['NSL', 'BPL', 'PGL', 'DTL', 'NEL'], list_position(['NS', 'BP', 'PE', 'DT', 'NE'], regexp_replace(c, '[^A-Z]', '', 'g'))) END))), ',') AS lines,
CASE WHEN n_nationkey % 5 = 0 THEN 'mrt' ELSE 'lrt' END AS station_type FROM u""")
def hub_and_rename(spark, d):
    """J15, J16, F9, F10."""
    k = F.col("n_nationkey")
    code = F.concat(F.element_at(F.array(*map(F.lit, ("NS", "BP", "PE", "DT"))), k % 4 + 1), k.cast("string"))
    n = t(spark, d, "nation").select(k, F.concat("n_name", F.lit(" MRT STATION")).alias("official_name"), F.col("n_name").alias("display_name"), F.array(code).alias("codes"), F.lit("lrt").alias("station_type"))
    own = n.where(k % 5 == 0)
    hubs = own.select(F.col("official_name").alias("hub_name"), F.array(F.lit("STC"), F.lit("NE1")).alias("hub_codes"))
    names = own.select(F.upper("display_name").alias("base"), F.concat("display_name", F.lit(" MRT/LRT STATION")).alias("canonical"))
    out = R.rename_interchange(R.add_hub_codes(n, hubs), names)
    return out.select("n_nationkey", "official_name", F.array_join("codes", ",").alias("codes"), F.array_join(S.detect_lines(F.col("codes")), ",").alias("lines"), "station_type")


@query(f"""WITH n AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN 'alpha beta' || p_partkey || ' MRT/LRT STATION' ELSE 'alpha of' || p_partkey || ' MRT STATION' END AS name FROM part)
SELECT id, CASE WHEN id % 7 = 0 THEN '{BASE_URL}/Alpha_Beta' || id || '_MRT/LRT_Station' WHEN id % 11 = 0 THEN 'map' || id WHEN id % 13 = 0 THEN 'cache' || id WHEN id % 5 = 0 THEN '{BASE_URL}/alpha_of' || id || '_MRT_Station' ELSE '{BASE_URL}/Alpha_Of' || id || '_MRT_Station' END AS url,
CASE WHEN id % 7 = 0 THEN 'interchange' WHEN id % 11 = 0 THEN 'mapping' WHEN id % 13 = 0 THEN 'cache' WHEN id % 5 = 0 THEN 'candidate' ELSE 'naive' END AS resolution_source FROM n""")
def url_resolution(spark, d):
    """J10-J13, F13-F16, F19, F20."""
    k, s = F.col("id"), F.col("id").cast("string")
    n = t(spark, d, "part").select(F.col("p_partkey").alias("id")).withColumn("name", F.when(k % 7 == 0, F.concat(F.lit("alpha beta"), s, F.lit(" MRT/LRT STATION"))).otherwise(F.concat(F.lit("alpha of"), s, F.lit(" MRT STATION"))))
    mapping = n.where("id % 11 = 0").select(F.upper("name").alias("map_key"), F.concat(F.lit("map"), s).alias("url"), F.lit(1).alias("rank"))
    now = F.lit("2024-03-01 00:00:00").cast("timestamp")
    cache = n.where("id % 13 in (0, 1)").select(S.cache_key(F.col("name")).alias("key"), F.concat(F.lit("cache"), s).alias("url"), F.when(k % 13 == 0, now - F.expr("interval 29 days")).otherwise(now - F.expr("interval 30 days")).alias("cached_at"))
    pages = n.where("id % 5 = 0").select(F.concat(F.lit(f"{BASE_URL}/alpha_of"), s, F.lit("_MRT_Station")).alias("url"))
    return R.resolve_url(n, pages, mapping, cache, now, BASE_URL).select("id", "url", "resolution_source")


_WORDS = "list_sort(list_distinct(regexp_extract_all(lower({}), '[a-z0-9]+')))"


@query(f"""WITH p AS (SELECT p_partkey AS id, p_name || ' ' || p_partkey % 97 || ' ' || p_brand AS name FROM part),
pages AS (SELECT DISTINCT '{BASE_URL}/' || replace(CASE WHEN id % 3 = 0 THEN 'The ' || name || ' stop' ELSE name || ' MRT Station' END, ' ', '_') AS url FROM p WHERE id % 4 = 0),
titles AS (SELECT url, {_WORDS.format(f"replace(substr(url, {len(BASE_URL) + 2}), '_', ' ')")} AS ws FROM pages), total AS (SELECT count(*) AS total FROM titles), posts AS (SELECT url, len(ws) AS size, unnest(ws) AS w FROM titles), often AS (SELECT w, count(*) AS n FROM posts GROUP BY w),
asked AS (SELECT id, unnest({_WORDS.format("name || ' lift MRT STATION'")}) AS w FROM p), weighed AS (SELECT id, w, cast(floor(1000 * ln(1 + total::DOUBLE / coalesce(n, 1))) AS BIGINT) AS x FROM asked LEFT JOIN often USING (w), total),
need AS (SELECT id, sum(x) / 2.0 AS need FROM weighed GROUP BY id), hits AS (SELECT id, url, size, sum(x)::BIGINT AS score FROM weighed JOIN posts USING (w) GROUP BY ALL),
best AS (SELECT id, url, score FROM hits JOIN need USING (id) WHERE score >= need QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, size, url) = 1)
SELECT p.id, b.url AS search_url, CASE WHEN b.url IS NULL THEN 'naive' ELSE 'search' END AS resolution_source FROM p LEFT JOIN best b ON p.id = b.id""")
def url_search(spark, d):
    """Names that no page's address spells are searched among the titles; rank and share of weight are held against SQL."""
    n = t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", F.col("p_partkey") % 97, "p_brand").alias("own"))
    title = F.when(F.col("id") % 3 == 0, F.concat(F.lit("The "), F.col("own"), F.lit(" stop"))).otherwise(F.concat("own", F.lit(" MRT Station")))
    pages = n.where("id % 4 = 0").select(F.concat(F.lit(f"{BASE_URL}/"), F.replace(title, F.lit(" "), F.lit("_"))).alias("url"))
    names = n.select("id", F.concat("own", F.lit(" lift MRT STATION")).alias("name"))
    none = spark.createDataFrame([], "map_key string, url string, rank int"), spark.createDataFrame([], "key string, url string, cached_at timestamp")
    found = R.resolve_url(names, pages, *none, F.current_timestamp(), BASE_URL)
    return found.select("id", F.when(F.col("resolution_source") == "search", F.col("url")).alias("search_url"), "resolution_source")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name || '!' ELSE s_name END AS s_name FROM supplier")
def corrected(spark, d):
    """The corrected table; a correction that changes nothing, and rows without one, stay."""
    s = t(spark, d, "supplier").select("s_suppkey", "s_name")
    given = s.where("s_suppkey % 3 < 2").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.concat("s_name", F.lit("!"))).otherwise(F.col("s_name")).alias("new_value"))
    return R.apply_corrections(s, given, "s_suppkey", "s_name").select("s_suppkey", "s_name")


@query("""SELECT 'feature' AS kind, s_name AS id, s_nationkey || '|' || CASE WHEN s_suppkey % 5 = 0 THEN '0.0|0.0' ELSE (s_suppkey / 4.0::DOUBLE) || '|' || (s_suppkey / 8.0::DOUBLE) END AS value FROM supplier
UNION ALL SELECT 'entity', 'NS' || s_suppkey, s_name || '|' || s_suppkey % 3 FROM supplier UNION ALL SELECT CASE s_suppkey % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' ELSE 'skipped' END, 'NS' || s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE '' END FROM supplier
UNION ALL SELECT 'broken', k, '{"cut": [' FROM (SELECT unnest(['features', 'entities', 'enrichment']) AS k)""")
def documents_read_back(spark, d):
    """SRC1-SRC3: documents of each kind are written, one for each nation and a broken one among them, and read again."""
    s, base = t(spark, d, "supplier"), io.shared_folder(spark, "documents")
    k, none = F.col("s_suppkey"), F.lit(None).cast("string")
    place = F.when(k % 5 == 0, F.lit(None)).otherwise(F.struct(F.array((k / 8.0).cast("double"), (k / 4.0).cast("double")).alias("coordinates")))
    feature = F.struct(F.struct(F.col("s_name").alias("STATION_NA"), F.col("s_nationkey").cast("string").alias("EXIT_CODE")).alias("properties"), place.alias("geometry"))
    exits = F.transform(F.sequence(F.lit(1), (k % 3).cast("int"), F.lit(1)), lambda i: F.struct(i.cast("string").alias("exit_code")))
    name = F.concat(F.lit("NS"), k.cast("string"))
    entity = F.struct(name.alias("station_id"), F.col("s_name").alias("official_name"), F.when(k % 3 > 0, exits).otherwise(F.array().cast("array<struct<exit_code:string>>")).alias("exits"))
    pick = lambda r, value: F.filter(F.collect_list(F.when(k % 3 == r, value)), lambda x: x.isNotNull())
    result = F.map_from_entries(pick(0, F.struct(name.alias("key"), F.struct(name.alias("station_id"), F.col("s_name").alias("official_name")).alias("value"))))
    listed = [pick(r, F.struct(name.alias("station_id"))).alias(c) for r, c in ((1, "failed_stations"), (2, "skipped_stations"))]
    for kind, parts in (("features", [F.collect_list(feature).alias("features")]), ("entities", [F.collect_list(entity).alias("stations")]), ("enrichment", [result.alias("stations"), *listed])):
        good = s.groupBy("s_nationkey").agg(F.to_json(F.struct(*parts)).alias("value"))
        bad = spark.range(1).select(F.lit(-1).alias("s_nationkey"), F.lit('{"cut": [').alias("value"))
        good.unionByName(bad).repartition("s_nationkey").write.partitionBy("s_nationkey").text(f"{base}/{kind}")
    geo = io.read_geojson(spark, f"{base}/features").select(F.lit("feature").alias("kind"), F.col("station_na").alias("id"), F.concat_ws("|", "exit_code", F.col("latitude").cast("string"), F.col("longitude").cast("string")).alias("value"))
    ent = io.read_entities(spark, f"{base}/entities").select(F.lit("entity").alias("kind"), F.col("station_id").alias("id"), F.concat_ws("|", "official_name", F.size("exits").cast("string")).alias("value"))
    enr = io.read_enrichment(spark, f"{base}/enrichment").select(F.col("status").alias("kind"), F.col("station_id").alias("id"), F.coalesce("result.official_name", F.lit("")).alias("value"))
    out = geo.unionByName(ent).unionByName(enr)
    for kind, schema in (("features", io.FEATURES), ("entities", io.SAVED_ENTITIES), ("enrichment", io.SAVED_ENRICHMENT)):
        out = out.unionByName(io.read_documents(spark, f"{base}/{kind}", schema)[1].select(F.lit("broken").alias("kind"), F.lit(kind).alias("id"), S.strip(F.col("document")).alias("value")))
    return out


@query("""SELECT 'entity' AS kind, s_suppkey AS id, s_name AS value FROM supplier UNION ALL SELECT 'run', s_suppkey % 5, count(*)::VARCHAR FROM supplier GROUP BY s_suppkey % 5 UNION ALL SELECT 'alert', s_suppkey, 'coverage below 70 %' FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT 'lookup', 0, x FROM (SELECT unnest(['CCL', 'NSL']) AS x) UNION ALL SELECT 'empty', 0, 'low|No relevant content found|0'""")
def written_read_back(spark, d):
    """SNK1, SNK4, SNK5, SRC8, L5: entities written and written over, runs and alerts appended twice, each read again."""
    s, base = t(spark, d, "supplier"), io.shared_folder(spark, "written")
    own = s.select(F.concat(F.lit("NS"), F.col("s_suppkey").cast("string")).alias("station_id"), F.col("s_name").alias("official_name"))
    io.write_entities(own.limit(3), f"{base}/entities")
    io.write_entities(own, f"{base}/entities")
    back = spark.read.schema(ENTITY).json(f"{base}/entities").select(F.lit("entity").alias("kind"), F.substring("station_id", 3, 20).cast("long").alias("id"), F.col("official_name").alias("value"))
    for half in (0, 1):
        part = F.col("s_suppkey") % 2 == half
        io.append_run(s.where(part).groupBy((F.col("s_suppkey") % 5).alias("run")).agg(F.count("*").alias("n")), f"{base}/runs")
        io.append_alerts(s.where(part & (F.col("s_suppkey") % 4 == 0)).select("s_suppkey", F.lit("coverage below 70 %").alias("message")), f"{base}/alerts")
    runs = spark.read.parquet(f"{base}/runs").groupBy("run").agg(F.sum("n").alias("n")).select(F.lit("run").alias("kind"), F.col("run").cast("long").alias("id"), F.col("n").cast("string").alias("value"))
    alerts = spark.read.parquet(f"{base}/alerts").where("ts is not null").select(F.lit("alert").alias("kind"), F.col("s_suppkey").cast("long").alias("id"), F.col("message").alias("value"))
    lines = io.lookup_table(spark, {k: v for k, v in S.LINES.items() if k in ("NS", "CC")}, "code", "line").select(F.lit("lookup").alias("kind"), F.lit(0).cast("long").alias("id"), F.col("line").alias("value"))
    e = J.empty_content_result()
    empty = s.where("s_suppkey = 1").select(F.lit("empty").alias("kind"), F.lit(0).cast("long").alias("id"), F.concat_ws("|", e["extraction_confidence"], F.array_join(e["accessibility_notes"], ","), F.size(e["exits"]).cast("string")).alias("value"))
    out = back
    for x in (runs, alerts, lines, empty):
        out = out.unionByName(x)
    return out


@query("SELECT s_suppkey, s_name AS old_value, CASE WHEN s_suppkey % 2 = 0 THEN s_name || '!' ELSE s_name END AS new_value FROM supplier WHERE s_suppkey % 2 = 0")
def corrections_log(spark, d):
    """J17."""
    s = t(spark, d, "supplier").select("s_suppkey", "s_name")
    return R.corrections_log(s, s.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.concat("s_name", F.lit("!"))).otherwise(F.col("s_name")).alias("new_value")), "s_suppkey", "s_name")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 0)")
def drop_skipped(spark, d):
    """J6."""
    return M.drop_skipped(t(spark, d, "documents").select("doc_id", "lang"), t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 0, "skipped").otherwise("success").alias("status")), "doc_id")


def _enrichment(l: DataFrame, key: str, exit_key: Column) -> DataFrame:
    platform = F.struct(F.lit("1").alias("platform_code"), F.lit("NS1").alias("towards_code"), F.when(F.col("toxic") == 1, "DTL").otherwise("NSL").alias("line_code"))
    exits = F.array(F.struct(exit_key.alias("exit_code"), F.array(platform).alias("platforms"), F.array(F.lit("lift")).alias("accessibility"), F.array().cast("array<struct<code:string,services:array<string>>>").alias("bus_stops"), F.array().cast("array<string>").alias("nearby_landmarks")))
    return l.select(key, F.when(F.col("quality") == 1, "success").otherwise("failed").alias("extraction_result"), exits.alias("exits"), F.array(F.lit("note")).alias("accessibility_notes"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("extraction_timestamp"))


def _owned(df: DataFrame, key: str) -> DataFrame:
    exits = F.array(*[F.struct(F.lit(c).alias("exit_code"), F.lit(1.3).alias("lat"), F.lit(103.8).alias("lng")) for c in ("Exit A", "B")])
    return df.select(key, exits.alias("exits"))


@query("""SELECT d.doc_id, CASE WHEN quality = 1 THEN CASE WHEN toxic = 1 THEN 'DTL' ELSE 'NSL' END END AS lines, CASE WHEN quality = 1 THEN 'note' END AS notes, CASE WHEN quality = 1 THEN 'lift' END AS exit_a FROM documents d LEFT JOIN labels l USING (doc_id)""")
def merge_entities(spark, d):
    """J7, J8, A5."""
    m = M.merge_entities(_owned(t(spark, d, "documents"), "doc_id"), _enrichment(t(spark, d, "labels"), "doc_id", F.lit("EXIT A")), "doc_id")
    return m.select("doc_id", F.array_join("lines_served", ",").alias("lines"), F.array_join("accessibility_notes", ",").alias("notes"), F.array_join(F.get("exits", F.lit(0))["accessibility"], ",").alias("exit_a"))


@query("""WITH e AS (SELECT 'Exit ' || l_linenumber AS exit_code, l_orderkey, last(l_partkey ORDER BY l_partkey, l_suppkey) AS part FROM lineitem GROUP BY ALL), o AS (SELECT o_orderkey, unnest([1, 2, 3, 4]) AS n FROM orders)
SELECT o_orderkey, cast(n AS VARCHAR) AS exit_code, cast(part AS VARCHAR) AS landmark FROM o LEFT JOIN e ON o_orderkey = l_orderkey AND exit_code = 'Exit ' || n""")
def merge_exits(spark, d):
    """Duplicate codes, the last wins."""
    li = t(spark, d, "lineitem")
    one = F.struct("l_partkey", "l_suppkey", F.concat(F.lit("Exit "), F.col("l_linenumber").cast("string")).alias("exit_code"), F.array(F.col("l_partkey").cast("string")).alias("nearby_landmarks"))
    rich = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(one)).alias("rich"))
    exits = F.array(*[F.struct(F.lit(str(k)).alias("exit_code"), F.lit(1.3).alias("lat"), F.lit(103.8).alias("lng")) for k in (1, 2, 3, 4)])
    joined = t(spark, d, "orders").select("o_orderkey", exits.alias("exits")).join(rich, "o_orderkey", "left")
    merged = M.merged_exits(F.col("exits"), F.coalesce("rich", F.array().cast(rich.schema["rich"].dataType)), ("nearby_landmarks",))
    return joined.select("o_orderkey", F.explode(merged).alias("x")).select("o_orderkey", "x.exit_code", F.get("x.nearby_landmarks", F.lit(0)).alias("landmark"))


@query("SELECT l_orderkey, 'Exit ' || l_linenumber AS exit_code, l_partkey FROM lineitem WHERE l_linenumber > 5 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def unmatched_enrichment(spark, d):
    """J9."""
    exits = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.array(*[F.lit(f"exit {k}") for k in range(1, 6)])).alias("exit_code"))
    return M.unmatched_enrichment(exits, t(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("Exit "), F.col("l_linenumber").cast("string")).alias("exit_code"), "l_partkey"), "l_orderkey")


@query("SELECT s_name AS official_name, CASE WHEN s_suppkey % 2 = 0 THEN 'NSL' END AS lines FROM supplier")
def merge_by_name(spark, d):
    """J18."""
    s = t(spark, d, "supplier").withColumn("official_name", F.col("s_name"))
    e = _enrichment(s.select("official_name", (F.col("s_suppkey") % 2 == 0).cast("int").alias("quality"), F.lit(0).alias("toxic")), "official_name", F.lit("EXIT A"))
    return M.merge_by_name(_owned(s, "official_name"), e).select("official_name", F.array_join("lines_served", ",").alias("lines"))


@query("""WITH x AS (SELECT DISTINCT l_orderkey, CASE WHEN l_linenumber > 3 THEN chr((60 + l_linenumber)::INT) ELSE cast(l_linenumber * 5 AS VARCHAR) END AS c FROM lineitem)
SELECT l_orderkey, string_agg('Exit ' || c, ',' ORDER BY CASE WHEN try_cast(c AS BIGINT) IS NULL THEN 0 ELSE 1 END, coalesce(try_cast(c AS BIGINT), 0), c) AS exits FROM x GROUP BY l_orderkey""")
def exit_labels_sorted(spark, d):
    """F2, O1."""
    n = F.col("l_linenumber")
    x = t(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("EXIT "), F.when(n > 3, F.chr(60 + n)).otherwise((n * 5).cast("string"))).alias("c")).distinct()
    return x.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(S.exit_order(F.col("c")).alias("o"), S.exit_label(F.col("c")).alias("l")))), lambda e: e["l"]), ",").alias("exits"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1")
def first_wins(spark, d):
    """W1."""
    return C.dedupe_first(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"], [F.col("l_partkey"), F.col("l_suppkey")])


@query("SELECT user_id, max_by(event_type, event_id) AS event_type, max(event_id) AS event_id, min(event_id) AS first_pos FROM events GROUP BY user_id")
def last_wins(spark, d):
    """W2."""
    e = t(spark, d, "events").select("user_id", "event_type", "event_id", F.col("event_id").alias("pos"))
    return C.dedupe_last(e, ["user_id"], "pos").select("user_id", "event_type", "event_id", "first_pos")


@query("""WITH g AS (SELECT o_custkey, list(cast(o_orderkey AS VARCHAR) ORDER BY o_orderkey) AS l, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS latest FROM orders GROUP BY o_custkey)
SELECT o_custkey, array_to_string(l[1:5], ', ') || CASE WHEN len(l) > 5 THEN ' and ' || (len(l) - 5) || ' more' ELSE '' END AS listed, latest FROM g""")
def topn_and_latest(spark, d):
    """O3, O4."""
    o = t(spark, d, "orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")).alias("l"), F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest"))
    return o.select("o_custkey", C.top_n_with_rest(F.col("l")).alias("listed"), "latest")


@query("SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def duplicates(spark, d):
    """A7."""
    return Q.duplicate_keys(t(spark, d, "part"), "p_name")


@query("SELECT c_nationkey, count(*) AS n, count(*) <> 60 AS mismatch, count(*) < 60 AS shortfall FROM customer GROUP BY c_nationkey")
def count_check(spark, d):
    """A15, for each nation."""
    g = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return g.select("c_nationkey", "n", (F.col("n") != 60).alias("mismatch"), (F.col("n") < 60).alias("shortfall"))


@query("""SELECT lang, count(*) AS total, count(quality) AS enriched, count(*) - count(quality) AS skipped, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS coverage, avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) < 0.7 AS warn FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def run_summary(spark, d):
    """A6, A10, for each language."""
    j = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    share = F.try_divide(F.count_if(F.col("quality") == 1), F.count("*"))
    return j.groupBy("lang").agg(F.count("*").alias("total"), F.count("quality").alias("enriched"), (F.count("*") - F.count("quality")).alias("skipped"), F.round(share, 6).alias("coverage"), (share < 0.7).alias("warn"))


_METRIC_ROWS = "SELECT length(html) % 10 > 0 AS content_ok, length(html) % 10 > 0 AND length(html) % 4 > 0 AS llm_ok, list_element(['high', 'medium', 'low', 'odd'], (length(html) % 4 + 1)::INT) AS confidence, length(html) % 3 AS n_exits, length(html) AS size_before, length(html) // 2 AS size_after FROM pages"


@query(f"""WITH m AS ({_METRIC_ROWS}) SELECT count(*) AS total, count(*) FILTER (content_ok) AS content_ok, count(*) FILTER (NOT content_ok) AS content_failed, count(*) FILTER (llm_ok) AS llm_ok, count(*) FILTER (NOT llm_ok) AS llm_failed,
round(count(*) FILTER (content_ok) * 100.0::DOUBLE / count(*), 1) AS content_rate, round(count(*) FILTER (llm_ok) * 100.0::DOUBLE / count(*), 1) AS llm_rate, count(*) FILTER (llm_ok AND confidence = 'high') AS high, count(*) FILTER (llm_ok AND confidence = 'medium') AS medium, count(*) FILTER (llm_ok AND confidence NOT IN ('high', 'medium')) AS low,
round(count(*) FILTER (n_exits = 0) * 100.0::DOUBLE / count(*), 1) AS empty_exit_rate, round(avg(size_before), 1) AS avg_before, round(avg(size_after), 1) AS avg_after, round((sum(size_before) - sum(size_after)) * 100.0::DOUBLE / sum(size_before), 1) AS reduction_percent FROM m""")
def extraction_metrics(spark, d):
    """A8, P8, F17."""
    n = F.length("html")
    rows = t(spark, d, "pages").select((n % 10 > 0).alias("content_ok"), ((n % 10 > 0) & (n % 4 > 0)).alias("llm_ok"), F.element_at(F.array(*map(F.lit, ("high", "medium", "low", "odd"))), n % 4 + 1).alias("confidence"), (n % 3).alias("n_exits"), n.alias("size_before"), F.floor(n / 2).alias("size_after"))
    return Q.extraction_metrics(rows).drop("message")


@query("SELECT count(*) AS exits_total, count(*) FILTER (quality = 1) AS with_platforms, count(*) FILTER (toxic = 1) AS with_accessibility, 0::BIGINT AS with_bus_stops FROM labels")
def enrichment_stats(spark, d):
    """A9."""
    some = lambda c: F.when(F.col(c) == 1, F.array(F.lit("x")))
    return Q.enrichment_stats(t(spark, d, "labels").select(some("quality").alias("platforms"), some("toxic").alias("accessibility"), F.lit(None).cast("array<string>").alias("bus_stops")))


@query(f"""WITH {SUPPLIERS} SELECT count(*) AS total, count(*) FILTER (s_suppkey % 5 > 0) AS with_exits, count(*) FILTER (s_suppkey % 5 = 0) AS without_exits, cast(sum(s_suppkey % 5) AS BIGINT) AS total_exits, count(*) FILTER (NOT (lat BETWEEN 1.3 AND 1.4 AND lng BETWEEN 103.7 AND 103.9)) AS out_of_range, count(*) FILTER (s_suppkey % 10 = 0) AS missing_fields FROM s""")
def quality_report(spark, d):
    """A11, P1, P5."""
    s = _points(t(spark, d, "supplier"), "s_suppkey", "s_name").withColumn("n_exits", F.col("s_suppkey") % 5).withColumn("s_name", F.when(F.col("s_suppkey") % 10 > 0, F.col("s_name")))
    return Q.quality_report(s, "n_exits", "lat", "lng", ["s_name"], (1.3, 1.4, 103.7, 103.9))


@query(f"WITH {PARTS} SELECT (SELECT count(*) FROM p WHERE NOT (lat BETWEEN 1.3 AND 1.4 AND lng BETWEEN 103.7 AND 103.9)) AS n_out_of_bounds, (SELECT count(*) FROM (SELECT p_name FROM p GROUP BY 1 HAVING count(*) > 1)) AS n_duplicate_keys, count(*) AS n_rows, greatest(5000 - count(*), 0)::BIGINT AS shortfall FROM p")
def sanity_report(spark, d):
    """V3, V4."""
    p = _points(t(spark, d, "part"), "p_partkey", "p_name")
    return Q.sanity(p, "p_name", bounds=(1.3, 1.4, 103.7, 103.9)).crossJoin(Q.completeness(p, 5000, ["p_name"]).select("n_rows", F.col("shortfall").cast("long").alias("shortfall")))


@query("SELECT sum(octet_length(encode(c_custkey || '|' || c_name)))::BIGINT AS n_bytes, sum(octet_length(encode(c_custkey || '|' || c_name))) <= 5242880 AS size_ok, count(*) = 1500 AS count_ok FROM customer")
def digest_check(spark, d):
    """Bytes and checks; the digest's own value is held against brute force in the tests."""
    c, canon = t(spark, d, "customer"), F.concat_ws("|", "c_custkey", "c_name")
    return Q.dataset_digest(c, canon).select("n_bytes").crossJoin(Q.package_check(c, canon, 1500).drop("digest_ok"))


@query("SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal < 0 THEN 'balance' END, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'segment' END, CASE WHEN c_nationkey > 20 THEN 'nation' END], lambda x: x IS NOT NULL), ',') AS violations FROM customer WHERE c_acctbal < 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY') OR c_nationkey > 20")
def quarantine(spark, d):
    """V1, V2, V6."""
    bad = Q.quarantine(t(spark, d, "customer"), {"balance": "c_acctbal >= 0", "segment": "c_mktsegment in ('BUILDING', 'MACHINERY')", "nation": "c_nationkey <= 20"})[1]
    return bad.select("c_custkey", F.array_join("violations", ",").alias("violations"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'checksum' END AS lacking FROM supplier")
def metadata_check(spark, d):
    """V5."""
    m = F.when(F.col("s_suppkey") % 2 == 0, F.create_map(F.lit("version"), F.lit("1"), F.lit("checksum"), F.lit("x"))).otherwise(F.create_map(F.lit("version"), F.lit("1")))
    return t(spark, d, "supplier").select("s_suppkey", F.array_join(Q.check_metadata(m, ["version", "checksum"]), ",").alias("lacking"))


@query("""WITH m AS (SELECT user_id % 50 AS k, avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END) AS coverage, count(*) AS n, bool_or(value > 99) AS bad FROM events GROUP BY 1), a AS (SELECT 'warning' AS level FROM m WHERE coverage < 0.7 UNION ALL SELECT 'error' FROM m WHERE n < 200 UNION ALL SELECT 'critical' FROM m WHERE bad)
SELECT count(*) AS total, count(*) FILTER (level = 'info') AS info, count(*) FILTER (level = 'warning') AS warning, count(*) FILTER (level = 'error') AS error, count(*) FILTER (level = 'critical') AS critical, coalesce(bool_or(level = 'critical'), false) AS any_critical FROM a""")
def alerts_from_metrics(spark, d):
    """V8, A13."""
    m = t(spark, d, "events").groupBy((F.col("user_id") % 50).alias("k")).agg((F.count_if(F.col("event_type") != "error") / F.count("*")).alias("coverage"), F.count("*").alias("n"), F.lit(200).alias("expected"), F.bool_or(F.col("value") > 99).alias("stage_failed"))
    return Q.alert_counts(Q.alert_rules(m))


_STRIPPED = "html"
for _tag in P.NOISE_TAGS:
    _STRIPPED = f"regexp_replace({_STRIPPED}, '<{_tag}\\b[^>]*>.*?</{_tag}\\s*>', '', 'gis')"


@query(f"""WITH x AS (SELECT page_id, length(html) AS b, length({_STRIPPED}) AS a, regexp_extract({_STRIPPED}, '<article\\b[^>]*>(.*)</article\\s*>', 1, 'is') AS main FROM pages)
SELECT page_id, b AS size_before, a AS size_after, CASE WHEN b > 0 THEN round((b - a) * 100.0::DOUBLE / b, 1) ELSE 0.0 END AS reduction_percent, round(b / greatest(a, 1)::DOUBLE, 1) AS reduction_ratio, length(main) AS n_main FROM x""")
def html_strip(spark, d):
    """H1, H2, H7."""
    p = t(spark, d, "pages").select("page_id", "html", P.strip_noise(F.col("html")).alias("clean"), P.main_content(F.col("html")).alias("main"))
    stats = P.extraction_stats(F.col("html"), F.col("clean"))
    return p.select("page_id", *[c.cast("long").alias(n) if n.startswith("size") else c for c, n in zip(stats, ("size_before", "size_after", "", ""))], F.length("main").cast("long").alias("n_main"))


@query()
def html_sections(spark, d):
    """H3-H6 over the pages table, whose h1 is made an h2 so that sections exist. SQL can't parse such pages; built_sections has SQL."""
    p = t(spark, d, "pages").withColumn("html", F.regexp_replace("html", r"<(/?)h1>", "<$1h2>"))
    return P.format_sections(P.routed_sections(P.sections(p)), p.select("page_id", F.col("url").alias("name")))


@query("""SELECT page_id, array_to_string(list_filter([CASE WHEN length(html) < 500 THEN 'too_short' END, CASE WHEN NOT contains(lower(html), 'exit') THEN 'missing_exit' END, CASE WHEN NOT contains(lower(html), 'platform') THEN 'missing_platform' END, CASE WHEN NOT contains(lower(html), 'line') THEN 'missing_line' END, CASE WHEN NOT contains(lower(html), 'station') THEN 'missing_station' END, CASE WHEN NOT contains(lower(html), '<table') THEN 'no_table' END], lambda x: x IS NOT NULL), ',') AS issues FROM pages""")
def content_quality(spark, d):
    """H8."""
    return t(spark, d, "pages").select("page_id", F.array_join(P.content_issues(F.col("html")), ",").alias("issues"))


@query("""SELECT event_id, event_id % 4 = 0 OR event_id % 4 = 1 AS valid, CASE event_id % 4 WHEN 3 THEN 'no_result' WHEN 2 THEN 'exit_0:no_exit_code' WHEN 1 THEN 'no_exits' ELSE '' END AS issues, CASE event_id % 4 WHEN 0 THEN 'high' WHEN 3 THEN NULL ELSE 'medium' END AS confidence FROM events""")
def responses(spark, d):
    """L1-L6."""
    k = F.col("event_id") % 4
    body = F.when(k == 0, F.concat(F.lit('```json\n{"exits": [{"exit_code": "'), F.col("event_id").cast("string"), F.lit('"}], "extraction_confidence": "high"}\n```'))).when(k == 1, '{"exits": []}').when(k == 2, '```{"exits": [{"code": 1}]}```').otherwise("not json")
    e = t(spark, d, "events").select("event_id", J.parse_response(body).alias("v"))
    return e.select("event_id", J.response_is_valid(F.col("v")).alias("valid"), F.array_join(J.result_issues(F.col("v"))["issues"], ",").alias("issues"), F.when(F.col("v").isNotNull(), J.to_enrichment(F.col("v"))["extraction_confidence"]).alias("confidence"))


@query("SELECT page_id, 'Extract exits, platforms and bus stops of ' || url || ' as JSON.' || chr(10) || substr(html, 1, 150000) AS prompt FROM pages")
def requests(spark, d):
    """L7, F18."""
    return J.build_requests(t(spark, d, "pages"), "page_id", "url", "html")


_FOUND_EXITS = "list_transform(regexp_extract_all(prompt, 'Exit ([A-Z0-9][A-Z0-9]?)\\b', 1), lambda x: '{{\"exit_code\": \"' || x || '\"}}')"


@query(f"""WITH p AS (SELECT page_id, 'Extract exits, platforms and bus stops of ' || url || ' as JSON.' || chr(10) || substr(html, 1, 150000) AS prompt FROM pages),
x AS (SELECT page_id, {_FOUND_EXITS.format()} AS found FROM p)
SELECT page_id, '{{"exits": [' || array_to_string(list_transform(list_filter(range(1, len(found) + 1), lambda i: list_position(found, found[i]) = i), lambda i: found[i]), ', ') || '], "extraction_confidence": "medium"}}' AS response, NULL::VARCHAR AS error FROM x""")
def extract_job(spark, d):
    """L8."""
    return J.extract_with(J.build_requests(t(spark, d, "pages"), "page_id", "url", "html"), J.table_parser, "page_id")


_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'success' END"


def _attempts(e: DataFrame) -> DataFrame:
    return e.select(F.col("user_id").alias("entity_id"), F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "skipped").otherwise("success").alias("status"), "event_id", F.col("ts").cast("timestamp").alias("ts"))


_LATEST = f"SELECT user_id AS entity_id, max_by({_STATUS}, (ts, event_id)) AS status, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id"


@query(_LATEST)
def latest_state(spark, d):
    """W3."""
    return L.latest_state(_attempts(t(spark, d, "events")), order=("ts", "event_id")).select("entity_id", "status", "event_id")


@query("""WITH f AS (SELECT user_id AS entity_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS attempt_no FROM events WHERE event_type = 'error')
SELECT entity_id, event_id, attempt_no, attempt_no >= 3 AS permanent, CASE WHEN attempt_no >= 3 THEN 'Failed after 3 retry attempts' END AS error, date_diff('second', ts, ts + to_seconds((5 * pow(2, attempt_no))::BIGINT))::BIGINT AS wait_s FROM f""")
def retry_schedule(spark, d):
    """W5, T4, T5."""
    f = L.number_attempts(_attempts(t(spark, d, "events")).where("status = 'failed'"), order=("ts", "event_id"))
    return f.select("entity_id", "event_id", F.col("attempt_no").cast("long").alias("attempt_no"), "permanent", "error", F.round(F.col("next_retry_at").cast("double") - F.col("ts").cast("double")).cast("long").alias("wait_s"))


def _ledger(e: DataFrame) -> DataFrame:
    last = L.latest_state(_attempts(e), order=("ts", "event_id"))
    return last.select("entity_id", "status", (F.col("event_id") % 2 == 0).alias("permanent"), F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("reason"), "ts")


@query(f"""WITH l AS ({_LATEST}) SELECT c_custkey AS entity_id, 'resume' AS mode FROM customer WHERE c_custkey NOT IN (SELECT entity_id FROM l WHERE status <> 'failed' OR event_id % 2 = 0)
UNION ALL SELECT c_custkey, 'retry' FROM customer WHERE c_custkey NOT IN (SELECT entity_id FROM l WHERE status <> 'failed')""")
def pending(spark, d):
    """T2, T3, J14, U3."""
    own, led = t(spark, d, "customer").select(F.col("c_custkey").alias("entity_id")), _ledger(t(spark, d, "events"))
    led = led.withColumn("permanent", (F.col("status") == "failed") & F.col("permanent"))
    return L.select_pending(own, led, "resume").withColumn("mode", F.lit("resume")).unionByName(L.select_pending(own, L.reset_failed(led), "retry").withColumn("mode", F.lit("retry")))


@query(f"""WITH e AS (SELECT user_id AS entity_id, {_STATUS} AS status, event_id, ts FROM events), done AS (SELECT DISTINCT entity_id FROM e WHERE status = 'success'), skipped AS (SELECT DISTINCT entity_id FROM e WHERE status = 'skipped'), failed AS (SELECT * FROM e WHERE status = 'failed')
SELECT entity_id, 'kept' AS kind, -1::BIGINT AS event_id FROM done WHERE entity_id NOT IN (SELECT entity_id FROM skipped) UNION ALL SELECT entity_id, 'failure', max_by(event_id, (ts, event_id)) FROM failed WHERE entity_id NOT IN (SELECT entity_id FROM done) GROUP BY entity_id
UNION ALL SELECT entity_id, 'overlap', -1 FROM done WHERE entity_id IN (SELECT entity_id FROM skipped) UNION ALL SELECT entity_id, 'processed', -1 FROM (SELECT DISTINCT entity_id FROM e) UNION ALL SELECT entity_id, 'broken', -1 FROM e GROUP BY entity_id HAVING count(DISTINCT status) > 1
UNION ALL SELECT entity_id, 'skip', min_by(event_id, (ts, event_id)) FROM e WHERE status = 'skipped' GROUP BY entity_id""")
def ledger_repair(spark, d):
    """T6-T9, U2, U4, U5."""
    e = _attempts(t(spark, d, "events"))
    done, skipped, failed = (e.where(F.col("status") == s) for s in ("success", "skipped", "failed"))
    first = L.dedupe_skipped(skipped, order=("ts", "event_id"))
    done, skipped = done.select("entity_id").distinct(), first.select("entity_id")
    none = F.lit(-1).cast("long").alias("event_id")
    out = L.resolve_overlap(done, skipped).select("entity_id", F.lit("kept").alias("kind"), none)
    for kind, df in (("failure", L.drop_recovered_failures(failed, done, order=("ts", "event_id"))), ("overlap", L.overlap(done, skipped)), ("processed", L.rebuild_processed([("success", done), ("failed", failed), ("skipped", skipped)])), ("broken", L.broken_disjointness(e)), ("skip", first)):
        out = out.unionByName(df.select("entity_id", F.lit(kind).alias("kind"), F.col("event_id") if kind in ("failure", "skip") else none))
    return out


@query(f"""WITH l AS ({_LATEST}) SELECT CASE WHEN status = 'skipped' THEN 'failed' ELSE status END AS status, count(*) AS n FROM l WHERE entity_id % 10 <> 0 GROUP BY 1""")
def requeue_and_forget(spark, d):
    """T10, T11, A12."""
    led = _ledger(t(spark, d, "events"))
    return L.forget(L.requeue_skipped(led), led.where("entity_id % 10 = 0")).groupBy("status").agg(F.count("*").alias("n"))


@query(f"""WITH l AS ({_LATEST}) SELECT count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed' AND event_id % 2 = 0) AS permanent_failures, count(*) FILTER (status = 'skipped') AS skipped, count(*) AS total FROM l""")
def status_summary(spark, d):
    """A12."""
    return Q.status_summary(_ledger(t(spark, d, "events")))


@query("""SELECT p_partkey, trim(upper(p_name)) AS base, upper(p_name) || ' MRT STATION' AS official, upper(p_name) || ' (BP' || p_size || ') LRT STATION' AS inner_suffix, upper(p_name) || 'MRT STATION MRT STATION' AS glued, p_name AS display, upper(p_name) || ' MRT STATION' AS source, lower(replace(p_name, ' ', '_')) AS cache_key FROM part""")
def name_scalars(spark, d):
    """F3, F5, F6, F16, F23."""
    n = F.col("p_name")
    return t(spark, d, "part").select("p_partkey", S.base_name(F.concat(n, F.lit(" LRT Station"))).alias("base"), S.official_name(F.concat(F.lit(" "), F.upper(n), F.lit(". "))).alias("official"), S.official_name(F.concat(F.upper(n), F.lit(" LRT STATION (BP"), F.col("p_size").cast("string"), F.lit(")"))).alias("inner_suffix"), S.official_name(F.concat(F.upper(n), F.lit("MRT STATION"))).alias("glued"), S.display_name(F.concat(n, F.lit(" MRT STATION"))).alias("display"), S.source_name(F.concat(n, F.lit(" LRT STATION"))).alias("source"), S.cache_key(n).alias("cache_key"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS version, strftime(o_orderdate, '%Y%m%d') AS compact FROM orders")
def data_versions(spark, d):
    """F22."""
    return t(spark, d, "orders").select("o_orderkey", S.data_version(F.col("o_orderdate")).alias("version"), S.data_version(F.col("o_orderdate"), True).alias("compact"))


@query("""WITH x AS (SELECT p_partkey, [list_element(['NS', 'BP', 'XX', 'DT'], (p_partkey % 4 + 1)::INT) || p_partkey % 30, CASE WHEN p_partkey % 3 = 0 THEN 'PTC' ELSE 'SE1' END] AS c FROM part)
SELECT p_partkey, c[1] AS primary_code, p_partkey % 4 <> 2 AS valid, p_partkey % 4 IN (0, 3) AS interchange, array_to_string(list_sort(list_distinct(list_filter([CASE p_partkey % 4 WHEN 0 THEN 'NSL' WHEN 1 THEN 'BPL' WHEN 3 THEN 'DTL' END, CASE WHEN p_partkey % 3 = 0 THEN 'PGL' ELSE 'SKL' END], lambda v: v IS NOT NULL))), ',') AS lines FROM x""")
def code_scalars(spark, d):
    """F10, F11, P2, P6, SRC8."""
    k = F.col("p_partkey")
    c = F.array(F.concat(F.element_at(F.array(*map(F.lit, ("NS", "BP", "XX", "DT"))), (k % 4 + 1).cast("int")), (k % 30).cast("string")), F.when(k % 3 == 0, "PTC").otherwise("SE1"))
    x = t(spark, d, "part").select("p_partkey", c.alias("c"))
    c = F.col("c")
    return x.select("p_partkey", S.primary_code(c).alias("primary_code"), S.valid_codes(c).alias("valid"), S.is_interchange(c).alias("interchange"), F.array_join(S.detect_lines(c), ",").alias("lines"))


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'not_found' ELSE 'failed' END AS outcome, page_id % 3 = 0 AS has_html, url = '' OR url IS NULL AS needs_url FROM pages")
def page_fetch_status(spark, d):
    """SRC10, P9."""
    k = F.col("page_id") % 3
    s = P.page_status(F.when(k == 0, 200).when(k == 1, 404).otherwise(500), F.col("html"))
    return t(spark, d, "pages").select("page_id", s["outcome"].alias("outcome"), s["html"].isNotNull().alias("has_html"), S.needs_url(F.col("url")).alias("needs_url"))


@query("SELECT (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0) AS added, (SELECT count(*) FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 5 <> 0) AS removed, (SELECT count(*) FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 2 = 0) AS changed")
def repair_counts(spark, d):
    """A16."""
    c, k = t(spark, d, "customer").select("c_custkey", "c_name"), F.col("c_custkey")
    return Q.change_counts(c.where(k % 5 != 0), c.where((k % 7 != 0) | (k % 5 == 0)).withColumn("c_name", F.when(k % 2 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))), "c_custkey", ["c_name"])


@query("SELECT s_suppkey AS entity_id, s_name AS name FROM supplier")
def roundtrip(spark, d):
    """SNK2-SNK4, SRC9: written, versioned, snapshotted and read again."""
    s, base = t(spark, d, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("name")), io.shared_folder(spark, "roundtrip")
    io.write_version(s.where("false"), f"{base}/v", "2024-01-01")
    io.write_version(s, f"{base}/v", "2024-02-01")
    io.write_state(io.read_latest(spark, f"{base}/v").drop("data_version"), f"{base}/state", 1)
    io.write_state(s.where("false"), f"{base}/state", 2)
    io.append_run(spark.range(1), f"{base}/runs")
    return io.read_state(spark, f"{base}/state")


@query("SELECT l_orderkey, 'Exit ' || l_linenumber AS exit_code, l_returnflag || l_linestatus AS line_code, cast(l_suppkey AS VARCHAR) AS platform_code, cast(l_partkey AS VARCHAR) AS towards_code FROM lineitem")
def platform_edges(spark, d):
    """SNK6."""
    p = F.struct(F.col("l_suppkey").cast("string").alias("platform_code"), F.col("l_partkey").cast("string").alias("towards_code"), F.concat("l_returnflag", "l_linestatus").alias("line_code"))
    e = F.struct(F.concat(F.lit("Exit "), F.col("l_linenumber").cast("string")).alias("exit_code"), F.array(p).alias("platforms"))
    return M.platform_edges(t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(e).alias("exits")), "l_orderkey")


@query(_LATEST)
def enrich_stream(spark, d):
    """The events come as a stream of files."""
    from placeforge.streaming.enrich import enrich_stream as run

    base = io.shared_folder(spark, "stream")
    events = t(spark, d, "events")
    events.repartition(3).write.parquet(f"{base}/in")
    run(spark, f"{base}/in", events.schema, f"{base}/ledger", f"{base}/checkpoint", lambda e: _attempts(e).withColumn("attempts", F.lit(1)), order=("ts", "event_id"))
    return state.read_buckets(spark, f"{base}/ledger").select("entity_id", "status", "event_id")


@query("""WITH x AS (SELECT p_partkey, list_element(['CR', 'JS', 'JW', 'JE', 'NS'], (p_partkey % 5 + 1)::INT) || (p_partkey % 9 + 1) AS code FROM part)
SELECT p_partkey, code AS loose, code AS strict, list_element(['CRL', 'JRL', 'JRL', 'JRL', 'NSL'], (p_partkey % 5 + 1)::INT) AS line FROM x""")
def future_codes(spark, d):
    """F7, F8, F10 (where an unknown code is an error), for lines still to come."""
    k = F.col("p_partkey")
    x = t(spark, d, "part").select(k, F.concat(F.lit("at "), F.element_at(F.array(*map(F.lit, ("cr", "js", "jw", "je", "ns"))), (k % 5 + 1).cast("int")), (k % 9 + 1).cast("string"), F.lit(" and zz3")).alias("said"))
    strict = S.codes_strict(F.col("said"))
    return x.select(k, F.array_join(S.codes_loose(F.col("said")), ",").alias("loose"), F.array_join(strict, ",").alias("strict"), F.array_join(S.detect_lines_strict(strict), ",").alias("line"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'mrt' WHEN 1 THEN 'lrt' ELSE 'mrt' END AS kind FROM part""")
def station_types(spark, d):
    """F9."""
    k = F.col("p_partkey")
    name = F.concat(F.upper("p_name"), F.when(k % 3 == 0, " MRT/LRT STATION").when(k % 3 == 1, " LRT STATION").otherwise(" MRT STATION"))
    return t(spark, d, "part").select(k, S.station_type(name).alias("kind"))


@query("""SELECT doc_id, coalesce(quality, 0) <> 1 OR doc_id % 3 = 0 AS failed FROM documents LEFT JOIN labels USING (doc_id)""")
def failed_extractions(spark, d):
    """A row without success, or without an exit, has failed."""
    j = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    exits = F.slice(F.array(F.lit("A"), F.lit("B")), 1, (F.col("doc_id") % 3).cast("int"))
    return j.select("doc_id", S.is_failed_extraction(F.when(F.col("quality") == 1, "success"), exits).alias("failed"))


@query("""SELECT o_custkey, CASE WHEN count(*) % 2 = 0 THEN 'listed' WHEN min(o_orderkey) % 2 = 0 THEN '' ELSE 'name' END AS absent FROM orders GROUP BY o_custkey""")
def missing_lists(spark, d):
    """P5: an empty list and an empty string are missing."""
    g = t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"))
    g = g.select("o_custkey", F.when(F.col("n") % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("x"))).alias("listed"), F.when((F.col("n") % 2 == 1) & (F.col("least") % 2 == 1), "").otherwise("y").alias("name"))
    return g.select("o_custkey", F.array_join(S.missing(["listed", "name"]), ",").alias("absent"))


@query("""SELECT count(*) AS total, count(quality) AS enriched, (SELECT count(*) FROM documents) - count(*) AS skipped, round(count(*) FILTER (quality = 1) * 1.0::DOUBLE / count(*), 6) AS coverage, count(*) FILTER (quality = 1) * 1.0::DOUBLE / count(*) < 0.7 AS warn FROM labels""")
def merge_totals(spark, d):
    """A6, A10 of the labelled documents."""
    labels = t(spark, d, "labels")
    n = t(spark, d, "documents").agg(F.count("*")).scalar()
    return Q.merge_summary(labels, n, "quality").crossJoin(Q.coverage(labels, F.col("quality") == 1))


@query("""SELECT count(*) AS n, count(*) <> 187 AS mismatch, count(*) < 187 AS shortfall FROM supplier""")
def expected_count(spark, d):
    """A15."""
    return Q.count_check(t(spark, d, "supplier"), 187)


@query("""SELECT max_by('v' || o_orderkey, (o_orderdate, o_orderkey)) AS path FROM orders""")
def newest_version(spark, d):
    """O4."""
    o = t(spark, d, "orders").select(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("path"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    return C.latest_version(o, "path", "at")


@query("""WITH x AS (SELECT p_partkey AS page_id, p_name AS name, p_partkey % 3 AS k, '<table class="t"><tr><td>' || CASE p_partkey % 3 WHEN 0 THEN 'Exit' WHEN 1 THEN 'Bus service' ELSE 'Bus</td><td>stop' END || '</td><td>' || p_partkey || '</td></tr></table>' AS cells FROM part)
SELECT page_id, '<h1>' || name || '</h1>' || ' <h2>Exits</h2> <p>Exit <b>A</b> &amp; ' || page_id || '</p>' || CASE WHEN k = 0 THEN ' ' || cells ELSE '' END || ' <h2>Platforms</h2> <div>' || name || '</div> ' || cells || CASE WHEN k = 1 THEN ' <h2>Bus Stops</h2> ' || cells ELSE '' END AS content FROM x""")
def built_sections(spark, d):
    """H3-H6 of pages built around the parts: noise by name and class, loose text, a section of no class, tables that go to other sections,
    words that stand in two cells and so are none."""
    k, key = F.col("p_partkey"), F.col("p_partkey").cast("string")
    word = F.when(k % 3 == 0, "Exit").when(k % 3 == 1, "Bus service").otherwise("Bus</td><td>stop")
    cells = F.concat(F.lit('<table class="t"><tr><td>'), word, F.lit("</td><td>"), key, F.lit("</td></tr></table>"))
    html = F.concat(
        F.lit('<body><p>outside</p><div class="x mw-parser-output"><nav><h2>Exits</h2><nav>in</nav><p>menu</p></nav><h3><i>Station</i> Exits</h3>loose<p>Exit <b>A</b> &amp; '),
        key, F.lit('<span class="ad-slot">buy</span></p><h2>History</h2><p>old</p><h2>Platforms</h2><div>'), F.col("p_name"), F.lit("</div>\n"), cells, F.lit("</div></body>"),
    )
    pages = t(spark, d, "part").select(k.alias("page_id"), F.col("p_name").alias("name"), html.alias("html"))
    return P.format_sections(P.routed_sections(P.sections(pages)), pages.select("page_id", "name"))


@query(f"""WITH e AS (SELECT user_id AS entity_id, {_STATUS} AS status, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
g AS (SELECT entity_id, arg_max(status, n) AS status, max(n) AS n, max(n) FILTER (status <> 'failed') AS done FROM e GROUP BY entity_id)
SELECT entity_id, status, CASE WHEN status = 'failed' THEN n - coalesce(done, 0) ELSE 1 END AS attempts FROM g""")
def ledger_upserts(spark, d):
    """SNK3, T1, T13: two batches into buckets, the second one twice; the third touches one entity in a hundred."""
    e = _attempts(t(spark, d, "events")).withColumn("attempts", F.lit(1))
    e = e.crossJoin(F.broadcast(e.agg(F.avg(F.col("ts").cast("double")).alias("mid"))))  # one row
    early, rare = F.col("ts").cast("double") < F.col("mid"), F.col("entity_id") % 100 == 0
    base = io.shared_folder(spark, "upserts")
    for version, part in ((0, early), (1, ~early & ~rare), (1, ~early & ~rare), (2, ~early & rare)):
        state.upsert_buckets(e.where(part).drop("mid"), base, version, order=("ts", "event_id"))
    return state.read_buckets(spark, base).select("entity_id", "status", F.col("attempts").cast("long").alias("attempts"))


@query("""WITH s AS (SELECT s_suppkey AS k FROM supplier), r AS (SELECT k, CASE k % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' ELSE 'skipped' END AS state FROM s)
SELECT 'whole' AS given, 'main' AS link, k AS entity_id, state FROM r WHERE k % 2 = 0 UNION ALL SELECT 'empty main', 'backup', k, state FROM r WHERE k % 5 = 0
UNION ALL SELECT 'backup of results', 'backup', k, state FROM r WHERE k % 7 = 0 UNION ALL SELECT 'no backup', 'rebuilt', k, state FROM r UNION ALL SELECT 'only final', 'final', k, 'success' FROM r WHERE state = 'success'""")
def recovery_chain(spark, d):
    """SRC9, T6: the main state, its backup, what can be rebuilt and the final output, each where those before it fail."""
    k = F.col("entity_id")
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("entity_id"))
    r = s.withColumn("status", F.when(k % 3 == 0, "success").when(k % 3 == 1, "failed").otherwise("skipped"))
    base, none = io.shared_folder(spark, "recovery"), s.where("false")
    for name, own, results in (("whole", s.where(k % 2 == 0), r), ("empty", none, r), ("backup", s.where(k % 5 == 0), r), ("results", none, r.where(k % 7 == 0)), ("final", none, r.where("status = 'success'"))):
        state.write_saved(own, results, f"{base}/{name}")
    at = lambda name: state.read_saved(spark, f"{base}/{name}")
    cases = {"whole": ("whole", "backup", "final"), "empty main": ("empty", "backup", "final"), "backup of results": ("empty", "results", "final"), "no backup": ("empty", "nothing", "final"), "only final": ("nothing", "nothing", "final"), "none": ("nothing", "nothing", "nothing")}
    out = None
    for given, names in cases.items():
        if (found := state.recover(*map(at, names))) is not None:
            one = found[1].select(F.lit(given).alias("given"), F.lit(found[0]).alias("link"), "entity_id", "state")
            out = one if out is None else out.unionByName(one)
    return out


_ORDER_JSON = """'{"o_orderkey":' || o_orderkey || ',"price":' || o_totalprice::DOUBLE || ',"text":"' || replace(replace(replace(o_orderpriority || chr(233) || chr(128512) || chr(10) || '"', '"', chr(92) || '"'), chr(10), chr(92) || 'n'), chr(233) || chr(128512), chr(92) || 'u00e9' || chr(92) || 'ud83d' || chr(92) || 'ude00') || '","void":null}'"""


@query(f"""WITH j AS (SELECT o_custkey, count(*) AS n, string_agg({_ORDER_JSON}, ',' ORDER BY o_orderkey) AS s FROM orders GROUP BY o_custkey), x AS (SELECT *, '{{"metadata":{{"data_version":"2024-02-14","file_size_bytes":' AS a, ',"station_count":' || n || '}},"stations":[' || s || ']}}' AS b FROM j)
SELECT o_custkey, strlen(a || '0' || b) AS n_bytes, sha256(a || strlen(a || '0' || b) || b) AS checksum, true AS holds, false AS changed_holds FROM x""")
def sealed_documents(spark, d):
    """A document for each customer, its bytes and checksum by canonical JSON, and the check that finds a change."""
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.struct(F.concat("o_orderpriority", F.lit('\u00e9\U0001f600\n"')).alias("text"), F.col("o_totalprice").cast("double").alias("price"), "o_orderkey", F.lit(None).cast("string").alias("void")).alias("s"))
    docs = o.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "s"))), lambda x: x["s"]).alias("stations"))
    meta = F.struct(F.lit("2024-02-14").alias("data_version"), F.size("stations").alias("station_count"), F.lit(0).cast("long").alias("file_size_bytes"), F.lit(None).cast("string").alias("checksum_sha256"))
    docs = docs.select("o_custkey", F.struct("stations", meta.alias("metadata")).alias("d"))
    kind = docs.schema["d"].dataType
    n_bytes, checksum = sealed(F.col("d"), kind)
    docs = docs.withColumn("n_bytes", n_bytes).withColumn("checksum", checksum)
    stored = F.struct(F.col("d.stations").alias("stations"), F.struct(F.col("d.metadata.data_version").alias("data_version"), F.col("d.metadata.station_count").alias("station_count"), F.col("n_bytes").alias("file_size_bytes"), F.col("checksum").alias("checksum_sha256")).alias("metadata"))
    docs = docs.withColumn("stored", stored)
    changed = F.col("stored").withField("metadata.station_count", F.col("stored.metadata.station_count") + 1)
    return docs.select("o_custkey", "n_bytes", "checksum", check_sealed(F.col("stored"), kind).alias("holds"), check_sealed(changed, kind).alias("changed_holds"))


def _station_rows(spark, d) -> DataFrame:
    """Entities of the suppliers with faults in one of eleven: id, name, type, no exit, and of exits place and source."""
    k = F.col("s_suppkey")
    exits = F.transform(F.sequence(F.lit(0), (k % 3).cast("int")), lambda i: F.struct(F.chr(i + 65).alias("exit_code"), F.when((k % 11 == 4) & (i == 1), 7.5).otherwise(1.3).alias("lat"), F.lit(103.8).alias("lng"), F.when((k % 11 == 5) & (i == 0), "guess").otherwise("onemap").alias("source")))
    return t(spark, d, "supplier").select(
        F.concat(F.when(k % 11 == 1, "ns").otherwise("NS"), k.cast("string")).alias("station_id"), F.concat("s_name", F.when(k % 11 == 2, " STOP").otherwise(" MRT STATION")).alias("official_name"), F.col("s_name").alias("display_name"),
        F.when(k % 11 == 6, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("NS"), k.cast("string")))).alias("mrt_codes"), F.array(F.lit("NSL")).alias("lines"), F.when(k % 11 == 3, "tram").otherwise("mrt").alias("station_type"),
        F.when(k % 11 != 7, exits).alias("exits"), F.lit(None).cast("string").alias("fandom_url"), F.lit("pending").alias("extraction_status"),
    )


_FAULTS = """s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 11 = 1 THEN 'ns' ELSE 'NS' END || s_suppkey AS station_id, s_name FROM supplier), f AS (SELECT station_id, 'station_id' AS path, station_id AS value, 'station_id' AS rule FROM s WHERE k % 11 = 1 UNION ALL SELECT station_id, 'official_name', s_name || ' STOP', 'official_name' FROM s WHERE k % 11 = 2
UNION ALL SELECT station_id, 'station_type', 'tram', 'station_type' FROM s WHERE k % 11 = 3 UNION ALL SELECT station_id, 'exits[1].lat', '7.5', 'exit_bounds' FROM s WHERE k % 11 = 4 AND k % 3 > 0 UNION ALL SELECT station_id, 'exits[0].source', 'guess', 'exit_source' FROM s WHERE k % 11 = 5
UNION ALL SELECT station_id, 'mrt_codes', '[]', 'mrt_codes' FROM s WHERE k % 11 = 6 UNION ALL SELECT station_id, 'exits', NULL, 'exits' FROM s WHERE k % 11 = 7)"""


@query(f"WITH {_FAULTS} SELECT station_id, path, value FROM f")
def entity_violations(spark, d):
    """Each violation with the place of the field, also within the exits."""
    return V.violations(_station_rows(spark, d), "station_id", ENTITY_FIELDS)


@query(f"WITH {_FAULTS} SELECT station_id, rule FROM f UNION ALL SELECT station_id, unnest(['exit_bounds', 'exit_source']) FROM s WHERE k % 11 = 7")
def entity_rules(spark, d):
    """V1: the names of broken rules; null exits break those of the exits, too."""
    return Q.check_rules(_station_rows(spark, d), ENTITY_RULES).select("station_id", F.explode("violations").alias("rule"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (s_suppkey % 11 IN (1, 2, 3, 5, 6, 7) OR s_suppkey % 11 = 4 AND s_suppkey % 3 > 0) AS n_invalid, count(*) FILTER (s_suppkey % 11 IN (1, 2, 3, 5, 6, 7) OR s_suppkey % 11 = 4 AND s_suppkey % 3 > 0) = 0 AS passed FROM supplier UNION ALL SELECT count(*), 0, count(*) > 0 FROM supplier WHERE s_suppkey % 11 = 0 UNION ALL SELECT 0, 0, false")
def output_check(spark, d):
    """V2: all entities, those without a fault, and none."""
    s = _station_rows(spark, d)
    parts = (s, s.where("cast(regexp_extract(station_id, '[0-9]+', 0) as long) % 11 = 0"), s.where("false"))
    checks = [Q.check_output(x, ENTITY_RULES) for x in parts]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query("""WITH l AS (SELECT l_orderkey, l_linenumber AS n, CASE WHEN l_partkey % 7 = 0 THEN 'x' ELSE 'NSL' END AS line, CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN '1A' ELSE 'NS1' END AS towards, lpad((l_suppkey % 100000)::VARCHAR, CASE WHEN l_suppkey % 9 = 0 THEN 4 ELSE 5 END, '0') AS stop FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1),
x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n) - 1 AS i FROM l)
SELECT l_orderkey, 'exits[' || i || '].platforms[0].line_code' AS path, line AS value FROM x WHERE line = 'x' UNION ALL SELECT l_orderkey, 'exits[' || i || '].platforms[0].towards_code', towards FROM x WHERE towards = '1A' UNION ALL SELECT l_orderkey, 'exits[' || i || '].bus_stops[0].code', stop FROM x WHERE length(stop) <> 5
UNION ALL SELECT DISTINCT l_orderkey, 'extraction_result', 'maybe' FROM x WHERE l_orderkey % 13 = 0""")
def enrichment_violations(spark, d):
    """V1: enriched exits with platforms and bus stops, three levels deep; the rules by name tell the same rows apart."""
    k = F.col("l_partkey")
    l = t(spark, d, "lineitem").withColumn("c", F.count("*").over(Window.partitionBy("l_orderkey", "l_linenumber"))).where("c = 1")
    platform = F.struct(F.lit("P").alias("platform_code"), F.when(k % 5 == 0, None).when(k % 5 == 1, "1A").otherwise("NS1").alias("towards_code"), F.when(k % 7 == 0, "x").otherwise("NSL").alias("line_code"))
    code = (F.col("l_suppkey") % 100000).cast("string")
    stop = F.struct(F.when(F.col("l_suppkey") % 9 == 0, F.lpad(code, 4, "0")).otherwise(F.lpad(code, 5, "0")).alias("code"), F.array().cast("array<string>").alias("services"))
    none = F.array().cast("array<string>")
    own = F.struct(F.concat(F.lit("Exit "), F.col("l_linenumber").cast("string")).alias("exit_code"), F.array(platform).alias("platforms"), none.alias("accessibility"), F.array(stop).alias("bus_stops"), none.alias("nearby_landmarks")).cast(ENRICHED_EXIT)
    rows = l.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", own.alias("e")))), lambda x: x["e"]).alias("exits"))
    rows = rows.withColumn("extraction_result", F.when(F.col("l_orderkey") % 13 == 0, "maybe").otherwise("success")).withColumn("extraction_confidence", F.lit("high"))
    found = V.violations(rows, "l_orderkey", ENRICHMENT_FIELDS)
    named = Q.check_rules(rows, ENRICHMENT_RULES).where(F.size("violations") > 0).select("l_orderkey")
    return found.join(named, "l_orderkey", "left_semi")


@query(f"WITH {_FAULTS} SELECT regexp_replace(path, '[0-9]+', '') AS rule, count(*) AS n FROM f GROUP BY 1")
def violation_totals(spark, d):
    """How often each rule is broken."""
    return V.violation_counts(V.violations(_station_rows(spark, d), "station_id", ENTITY_FIELDS))


@query(f"""WITH e AS (SELECT user_id AS entity_id, {_STATUS} AS status, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
g AS (SELECT entity_id, arg_max(status, n) AS status, max(n) AS n, max(n) FILTER (status <> 'failed') AS done FROM e GROUP BY entity_id)
SELECT entity_id, status, CASE WHEN status = 'failed' THEN n - coalesce(done, 0) ELSE 1 END AS attempts FROM g""")
def outcomes(spark, d):
    """The later half of the events is applied to the ledger of the earlier half."""
    e = _attempts(t(spark, d, "events")).withColumn("attempts", F.lit(1))
    e = e.crossJoin(F.broadcast(e.agg(F.avg(F.col("ts").cast("double")).alias("mid"))))  # one row
    early = F.col("ts").cast("double") < F.col("mid")
    ledger = L.apply_outcomes(None, e.where(early).drop("mid"), order=("ts", "event_id"))
    return L.apply_outcomes(ledger, e.where(~early).drop("mid"), order=("ts", "event_id")).select("entity_id", "status", F.col("attempts").cast("long").alias("attempts"))
