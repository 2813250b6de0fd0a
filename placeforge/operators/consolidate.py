"""Groups of exits, duplicates and their consolidation: A1-A4, J5, W1, W2, O1, O3, O4."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.functions import scalars as S
from placeforge.functions import spatial as G
from placeforge.operators.near import near_links
from placeforge.sources.io import cut


def group_exits(df: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """A1: one row per key, its rows as an array in input order."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), *fields))), lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("exits"))


def centroid(df: DataFrame, key: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """A2."""
    return df.groupBy(key).agg(F.avg(lat).alias("lat"), F.avg(lng).alias("lng"))


def union_codes(df: DataFrame, key: str, codes: str) -> DataFrame:
    """A3: sets are combined before the shuffle, code by code."""
    each = df.select(key, F.explode_outer(codes).alias("c"))
    return each.groupBy(key).agg(F.array_sort(F.collect_set("c")).alias("codes"))


def _keyed(df: DataFrame, near_m: float, same_name_m: float) -> list[tuple[DataFrame, float]]:
    """The criteria of J5 as points (id, lat, lng, key) with the radius within which equal keys count."""
    own = df.select("id", "lat", "lng", F.col("name").alias("full"), S.base_name(F.col("name")).alias("base"), "codes")
    tagged = F.transform(F.coalesce("codes", F.array().cast("array<string>")), lambda c: F.concat(F.lit("code "), c))
    out = [(own.select("id", "lat", "lng", F.explode(F.array_append(tagged, F.concat(F.lit("name "), F.col("base")))).alias("key")), near_m)]
    if same_name_m > near_m:  # otherwise equal names lie within near_m and have equal base names
        out.append((own.select("id", "lat", "lng", F.col("full").alias("key")), same_name_m))
    return out


def consolidation_pairs(df: DataFrame, near_m: float = 800.0, same_name_m: float = 300.0, most: int = 1000) -> DataFrame:
    """All pairs id < other of (id, name, codes, lat, lng) that share a code or a base name nearby, or a name very near.

    Each criterion has a radius, so each is blocked by its key and a cell, never by a name alone. Rows of equal name, codes and place are one
    spot (of about `most` ids, or several); the criteria are asked of spots, and a pair of spots found gives all its pairs of ids, so that what
    is shuffled are spots and their ids and not the pairs. To hold groups together use consolidation_links, which are as many as the points.
    """
    alike = ["lat", "lng", "name", "codes"]
    placed = df.where("id is not null and lat is not null and lng is not null").select("id", *alike)
    part = F.pmod(F.xxhash64("id"), F.ceil(F.count("*").over(Window.partitionBy(*alike)) / most)).alias("part")
    spots = cut(placed.select("*", part).groupBy(*alike, "part").agg(F.collect_set("id").alias("ids")).withColumn("id", F.monotonically_increasing_id()), "spots")
    found = None
    for points, radius in _keyed(spots, near_m, same_name_m):
        right = points.select(F.col("id").alias("other"), F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng"), "key")
        one = G.distance_join(points, right, radius, strict=True, on=["key"]).where("id <= other").select("id", "other")
        found = one if found is None else found.unionByName(one)
    met = cut(found.distinct(), "met")
    ids = lambda key, name: spots.select(F.col("id").alias(key), F.col("ids").alias(name))
    both = met.hint("merge").join(ids("id", "a"), "id").hint("merge").join(ids("other", "b"), "other").select((F.col("id") == F.col("other")).alias("same"), F.explode("a").alias("a"), "b")
    pairs = both.select("same", "a", F.explode("b").alias("b")).where(F.when(F.col("same"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))).select(F.least("a", "b").alias("id"), F.greatest("a", "b").alias("other"))
    # an id of one row lies in one spot, so that no pair comes twice
    return pairs if placed.groupBy("id").count().where("count > 1").isEmpty() else pairs.distinct()


def consolidation_links(df: DataFrame, near_m: float = 800.0, same_name_m: float = 300.0) -> DataFrame:
    """Links (id, other) with the same components as all pairs of consolidation_pairs, as many as the points."""
    found = None
    for points, radius in _keyed(df, near_m, same_name_m):
        one = near_links(points, radius)
        found = one if found is None else found.unionByName(one)
    return found.distinct()


def _toward(links: DataFrame, both_ways: bool) -> DataFrame:
    """A contraction of links (hi, lo): the nodes around each node move to the least of them. Both ways: to the least of all around a node,
    itself included, those above it; else to the least of those below it, and it moves with them."""
    if both_ways:
        around = links.select(F.explode(F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")), F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("e")).select("e.*")
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return around.hint("merge").join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    below = links.hint("merge").join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return below.unionByName(least.select("hi", F.col("m").alias("lo")))


def components(nodes: DataFrame, pairs: DataFrame, max_rounds: int = 50) -> DataFrame:
    """A4: (id, root): the least id of each component. Links contract to stars around the least ids, above and below by turns, and get fewer; each
    round is written to the shared folder. They are stars when each node has one link and no root hangs on another; else it fails loudly."""
    links = cut(pairs.where("id <> other").select(F.greatest("id", "other").alias("hi"), F.least("id", "other").alias("lo")).distinct(), "components")
    for _ in range(max_rounds):
        if links.hint("merge").join(links.select(F.col("lo").alias("mid")).distinct(), F.col("hi") == F.col("mid"), "left_semi").isEmpty() and links.groupBy("hi").count().where("count > 1").isEmpty():
            return nodes.select("id").hint("merge").join(links.withColumnsRenamed({"hi": "id", "lo": "root"}), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
        links = cut(_toward(_toward(links, True).distinct(), False).distinct(), "components")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Null and empty keys go."""
    kept = df
    for k in keys:
        kept = kept.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    return G.first_in_group(kept, keys, order)


def dedupe_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key, with first_pos, the place of the first. Both come from one pre-combined aggregate."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r"), F.min(order).alias("first_pos")).select(*keys, "r.*", "first_pos")


def consolidate(entities: DataFrame, exits: DataFrame, near_m: float = 800.0, same_name_m: float = 300.0) -> DataFrame:
    """A4: entities (id, name, codes, lat, lng) and exits (id, exit_code, lat, lng, ord) to one row per component:
    root, name of the least id, united codes, exits by first normalised code, sorted O1."""
    root = cut(components(entities, consolidation_links(entities, near_m, same_name_m)), "roots")
    named = entities.hint("merge").join(root, "id")
    codes = named.select("root", F.explode_outer("codes").alias("c")).groupBy("root").agg(F.array_sort(F.collect_set("c")).alias("codes"))
    head = named.groupBy("root").agg(F.min_by("name", "id").alias("name"))
    own = dedupe_first(exits.hint("merge").join(root, "id").withColumn("key", S.exit_key(F.col("exit_code"))), ["root", "key"], [F.col("id"), F.col("ord")])
    listed = own.groupBy("root").agg(F.transform(F.array_sort(F.collect_list(F.struct(S.exit_order(F.col("exit_code")).alias("o"), S.exit_label(F.col("exit_code")).alias("exit_code"), "lat", "lng"))), lambda x: F.struct(x["exit_code"].alias("exit_code"), x["lat"].alias("lat"), x["lng"].alias("lng"))).alias("exits"))
    return head.hint("merge").join(codes, "root").hint("merge").join(listed, "root", "left")


def top_n_with_rest(names: Column, n: int = 5) -> Column:
    """O3."""
    head = F.array_join(F.slice(names, 1, n), ", ")
    return F.when(F.size(names) > n, F.concat(head, F.lit(" and "), (F.size(names) - n).cast("string"), F.lit(" more"))).otherwise(head)


def latest_version(df: DataFrame, path: str, ts: str) -> DataFrame:
    """O4."""
    return df.agg(F.max_by(path, ts).alias(path))
