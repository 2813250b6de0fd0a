"""Shards of near equal bytes: a k-d tree over the documents' metadata, cut at exact weighted medians along the widest dimension."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeforge.llm.common import cut

#: Cells of all histograms, and rows, that one pass gathers at most; a node has so many cells. More shards than MOST are not made in one call.
CELLS, MOST = 1 << 17, 1 << 13
#: Documents of a shard that one task numbers, about.
NUMBERED = 100_000
#: A coordinate is a whole number from 0 to FINE over the table's extent; a missing one lies a whole extent below.
FINE = 1 << 52
#: Whether one document near a cut may change sides, where that brings the bytes nearer to the goal.
LEVEL = True


@dataclass
class _Search:
    """Where a node's cut is sought: keys are (coordinate, tie, uid); `fixed` are the components that are known, lo to hi the next one's range."""

    dim: int
    goal: float
    lo: int
    hi: int
    rows: int
    below: int = 0
    fixed: tuple[int, ...] = ()


def _coordinate(df: DataFrame, name: str) -> Column:
    """Numbers and times as doubles; what has no distance (strings, arrays, ..) by a hash of the value; null, NaN and infinite: null."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        c = F.unix_timestamp(c.cast("timestamp")).cast("double")
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        c = c.cast("int").cast("double") if isinstance(kind, T.BooleanType) else c.cast("double")
    else:
        c = F.when(c.isNotNull(), F.xxhash64(c)).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def _metadata(docs: DataFrame, dims: tuple[str, ...], id_col: str, text_col: str, keep: bool) -> DataFrame:
    """doc_id, size, text_crc32, raw coordinates d0, d1, .., tie, uid; node (0); with `keep` also the row. Written once; each later pass reads what it needs."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    own = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *[_coordinate(docs, name).alias(f"d{k}") for k, name in enumerate(dims)],
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep else []),
    )
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size"), 1)
    return cut(own.withColumn("tie", tie).withColumn("uid", F.monotonically_increasing_id()).withColumn("node", F.lit(0)), "metadata")


def _small(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of nodes (at most MOST) as a table to broadcast."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def _placed(rows: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Moves `node`, the first shard of the node that a row lies in, from the root down the tree, level by level."""
    out, rest = rows, [c for c in rows.columns if c != "node"]
    for cuts in levels:
        out = out.join(cuts, out["node"] == cuts["at"], "left")
        own, less = F.get("c", F.col("dim")), F.lit(False)
        for key, bound in ((F.col("uid"), F.col("k2")), (F.col("tie"), F.col("k1")), (own, F.col("k0"))):
            less = (key < bound) | ((key == bound) & less)
        out = out.select(*rest, F.when(F.col("at").isNull() | (less != (F.col("uid") == F.col("moved"))), F.col("node")).otherwise(F.col("right")).alias("node"))
    return out


def _settled(x: list[tuple], below: int, goal: float) -> tuple[int, int, int, int]:
    """Of a node's rows (coordinate, tie, uid, size) around its cut, sorted: the least key right of the cut, and the uid of the row that changes sides (or -1)."""
    sizes = np.array([r[3] for r in x], np.int64)
    left = below + np.concatenate([[0], np.cumsum(sizes)])
    i = min(int(np.searchsorted(left[1:], goal)), len(x) - 1)
    best = None
    for at in (i, i + 1):
        gaps = [abs(goal - left[at])]
        if LEVEL:
            gaps = np.append(gaps, np.abs(goal - left[at] + np.where(np.arange(len(x)) < at, sizes, -sizes)))
        k = int(np.argmin(gaps))
        if best is None or gaps[k] < best[0]:
            best = gaps[k], at, x[k - 1][2] if k else -1
    _, at, moved = best
    c, tie, uid, _ = x[min(at, len(x) - 1)]
    return c, tie, uid + (at == len(x)), moved


def _medians(rows: DataFrame, open_: dict[int, _Search]) -> dict[int, tuple[int, int, int, int]]:
    """For each node the least key right of its cut and the row that changes sides: the bytes to its left come nearest to the goal.

    All nodes are narrowed down together. A pass sums bytes in equal cells of each node's range, then only the cell where the goal lies
    stays; cells of one value go on to the next component of the key. Where few rows are left, they are looked at one by one.
    """
    cells = min(4096, CELLS // max(1, len(open_)))
    found: dict[int, tuple[int, int, int, int]] = {}
    while open_:
        asked = [(k, s.dim, len(s.fixed), *(*s.fixed, 0, 0)[:2], s.lo, s.hi, (s.hi - s.lo) // cells + 1, s.rows <= cells) for k, s in open_.items()]
        asked = _small(rows, asked, "at int, dim int, part int, f0 long, f1 long, lo long, hi long, step long, few boolean")
        own = F.get("c", F.col("dim"))
        key = F.when(F.col("part") == 0, own).when(F.col("part") == 1, F.col("tie")).otherwise(F.col("uid"))
        inside = rows.join(asked, rows["node"] == asked["at"]).withColumn("own", own).withColumn("key", key)
        inside = inside.where(((F.col("part") == 0) | (F.col("own") == F.col("f0"))) & ((F.col("part") < 2) | (F.col("tie") == F.col("f1"))) & F.col("key").between(F.col("lo"), F.col("hi")))
        if any(s.rows > cells for s in open_.values()):
            told: dict[int, list] = {}
            by_cell = inside.where("not few").groupBy("node", F.expr("(key - lo) div step").alias("cell")).agg(F.sum("size"), F.count("*"), F.min("key"), F.max("key"))
            for node, *x in by_cell.collect():  # at most CELLS rows
                told.setdefault(node, []).append(x)
            for node, x in told.items():
                s = open_[node]
                for _, size, s.rows, s.lo, s.hi in sorted(x):
                    if s.below + size >= s.goal:
                        break
                    s.below += size
                if s.lo == s.hi and len(s.fixed) < 2:  # one value: its rows are told apart by the next component
                    s.fixed, s.lo, s.hi = (*s.fixed, s.lo), 0, (1 << 63) - 1
            continue
        rest: dict[int, list] = {}
        for node, *x in inside.select("node", "own", "tie", "uid", "size").collect():  # at most CELLS rows
            rest.setdefault(node, []).append(tuple(x))
        for node, x in rest.items():
            found[node] = _settled(sorted(x), open_[node].below, open_[node].goal)
        return found
    return found


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, dims: tuple[str, ...] = ("n_chars", "lang", "source"), id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text and 1), text_crc32, shard (int), slot (from 0, gapless in its shard); with `keep` also the row as a struct.

    The tree is cut until it has n_shards leaves, or as many as target_bytes asks for: a node of n leaves is cut along the dimension in
    which it is widest (extents as shares of the table's; the first of equals) where n // 2 of its n shares of bytes lie below. Equal
    coordinates are told apart by a hash of the row, equal hashes by the row's place, so hot values and copies are cut like all else, and
    each cut is off by half a document at most; one document near the cut changes sides where that brings it nearer. Slots follow the hash.
    Dimensions that the table lacks are passed over.

    Null texts are empty (size 1); null ids are kept; missing coordinates lie together; repeated rows count each. With fewer documents
    than shards some shards are empty. An empty table gives no row.
    """
    dims = tuple(d for d in dims if d in docs.columns)
    meta = _metadata(docs, dims, id_col, text_col, keep)
    names = [f"d{k}" for k in range(len(dims))]
    n, total, *ends = meta.agg(F.count("*"), F.sum("size"), *[f(c) for c in names for f in (F.min, F.max)]).first()
    n_shards = max(1, n_shards or ceil((total or 0) / target_bytes)) if n_shards or target_bytes else 1
    if n_shards > MOST:
        raise ValueError(f"{n_shards} shards; more than {MOST} are made by sharding the shards")

    def whole(k: int) -> Column:
        lo, hi = ends[2 * k], ends[2 * k + 1]
        if lo is None:
            return F.lit(0).cast("long")
        at = F.lit(0.0) if lo == hi else (F.col(f"d{k}") / 2 - lo / 2) / (hi / 2 - lo / 2)
        return F.when(F.col(f"d{k}").isNull(), -FINE).otherwise(F.rint(at * FINE).cast("long"))

    coordinates = F.array(*[whole(k) for k in range(len(dims))], F.lit(0).cast("long")).alias("c")
    rows = meta.select("size", "tie", "uid", "node", coordinates)
    nodes, levels = {0: n_shards}, []
    while n and any(x > 1 for x in nodes.values()):
        placed = _placed(rows, levels)
        spans = [f(F.get("c", F.lit(k))) for k in range(len(dims) + 1) for f in (F.min, F.max)]
        open_ = {}
        for node, size, count, *span in placed.groupBy("node").agg(F.sum("size"), F.count("*"), *spans).collect():  # at most MOST rows
            if nodes[node] > 1:
                width = [hi - lo for lo, hi in zip(span[::2], span[1::2])]
                dim = width.index(max(width))
                open_[node] = _Search(dim, size * (nodes[node] // 2) / nodes[node], span[2 * dim], span[2 * dim + 1], count)
        ask = {k: (s.dim, nodes[k]) for k, s in open_.items()}
        cuts = [(k, ask[k][0], *key, k + ask[k][1] // 2) for k, key in _medians(placed, open_).items()]
        levels.append(_small(rows, cuts, "at int, dim int, k0 long, k1 long, k2 long, moved long, right int"))
        nodes = {k: x for node, own in nodes.items() for k, x in ({node: own // 2, node + own // 2: own - own // 2} if own > 1 else {node: own}).items()}
    out = meta.select("doc_id", "size", "text_crc32", "tie", "uid", "node", coordinates, *(["row"] if keep else []))
    out = _placed(out, levels).withColumnRenamed("node", "shard")
    return _numbered(out, n or 0, n_shards).select("doc_id", "size", "text_crc32", "shard", "slot", *(["row"] if keep else []))


def _numbered(df: DataFrame, n: int, n_shards: int) -> DataFrame:
    """Adds slot. A shard is numbered in parts, by the leading bits of the hash, and each part starts where those before it end."""
    bits = max(0, ceil(n / n_shards / NUMBERED) - 1).bit_length()
    df = df.withColumn("part", F.shiftright("tie", 63 - bits) if bits else F.lit(0).cast("long"))
    counts = df.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    starts = counts.select("shard", "part", F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    own = df.withColumn("n", F.row_number().over(Window.partitionBy("shard", "part").orderBy("tie", "doc_id", "uid")))
    return own.join(starts, ["shard", "part"]).withColumn("slot", (F.col("start") + F.col("n") - 1).cast("long"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """The documents as Parquet, a folder for each shard, in the order of their slots; a large shard is several files."""
    placed = kd_shards(docs, keep=True, **options).select("shard", "slot", "row")
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
