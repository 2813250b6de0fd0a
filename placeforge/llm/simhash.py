"""SimHash fingerprints and exact near-duplicate links within a Hamming radius, compared on vertical bit planes; near copies by shingles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import cut, drop_rows, groups, id_text
from placeforge.llm.graph import components

#: Fingerprints in a tile of a bucket; larger buckets are split into tiles that are compared pair by pair.
TILE = 2048
#: Estimated cost of a row in a bucket table and of a comparison, in ns; they only choose the number of blocks.
ROW_NS, PAIR_NS = 3000, 3


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash over the shingles of a text, repeats counted; 0 if the text has no word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 65536):  # a very long text in parts
        ones += np.unpackbits(h[k : k + 65536].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long), h (a hash of the text). One row per input row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            fp = np.array([fingerprint(t, shingle) for t in x.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(fp.view(np.int64)), x.column(2)], ["doc_id", "fp", "h"])

    return id_text(docs, id_col, text_col, with_hash=True).mapInArrow(run, "doc_id long, fp long, h long")


def block_masks(n: int, radius: int) -> list[int]:
    """Masks of bits that must agree. Of k blocks at most `radius` differ, so a link agrees on some choice of k - radius of them.

    Every k gives all links; k is what costs least for n fingerprints.
    """
    cost = {k: comb(k, radius) * (n * ROW_NS + n * n / 2.0 ** (64 * (k - radius) // k + 1) * PAIR_NS) for k in range(radius + 1, radius + 6)}
    k = min(cost, key=cost.get)
    edges = [round(64 * i / k) for i in range(k + 1)]
    blocks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(k)]
    return [sum(c) for c in combinations(blocks, k - radius)]


def _bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 planes: bit j of plane b is bit b of fingerprint j; the last word is filled up with zeros."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = np.pad(bits, ((0, -len(fps) % 64), (0, 0)))
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def near_pairs(queries: np.ndarray, lanes: np.ndarray, radius: int, skip: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (query, lane) at a Hamming distance of `radius` at most, block by block. skip: bits known to agree.

    Carry-save counters run over the planes for all lanes at once. They start so that the top carry comes with the difference
    number radius + 1; a lane that is over stays over, and a block is left once all its lanes are.
    """
    planes, width = _bit_planes(lanes), radius.bit_length()
    start = (1 << width) - radius - 1
    todo = [b for b in range(64) if not skip >> b & 1]
    full = ~np.uint64(0)
    pad = np.full(planes.shape[1], 0, np.uint64)
    if len(lanes) % 64:
        pad[-1] = full << np.uint64(len(lanes) % 64)
    step = max(1, min(len(queries), 16384 // planes.shape[1]))
    for at in range(0, len(queries), step):
        q = queries[at : at + step]
        count = [np.full((len(q), planes.shape[1]), full if start >> i & 1 else 0, np.uint64) for i in range(width)]
        over = np.repeat(pad[None, :], len(q), axis=0)
        for k, b in enumerate(todo):
            flip = np.where(q >> np.uint64(b) & np.uint64(1), full, np.uint64(0))
            carry = planes[b][None, :] ^ flip[:, None]
            for c in count:
                more = c & carry
                c ^= carry
                carry = more
            over |= carry
            if k % 8 == 7 and (over == full).all():
                break
        else:
            if not (over == full).all():
                hit = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, : len(lanes)]
                i, j = np.nonzero(hit)
                yield i + at, j


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that each of n is linked to."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label != (up := label[label])).any():
                label = up
    return label


def hamming_links(nodes: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Distinct longs `fp` to links (a, b) that connect all that are within `radius` of each other through such steps.

    Links of a tile are thinned to a spanning forest, so they grow with the tile, not with its square; connectivity stays complete.
    """
    n = nodes.count()
    masks = block_masks(n, radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])).alias("x")).select("fp", "x.t", "x.key")
    sizes = keyed.groupBy("t", "key").count().where("count > 1")
    tiled = keyed.join(sizes, ["t", "key"]).withColumn("tiles", F.ceil(F.col("count") / tile).cast("int")).withColumn("own", F.pmod(F.xxhash64("fp", "t"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * len(masks) // 500_000)
    tiled = tiled.repartition(parts, "t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j", "own", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            fps, skip = g[:, 5].astype(np.int64).view(np.uint64), masks[g[0, 0]]
            if g[0, 2] == g[0, 3]:
                pairs = near_pairs(fps, fps, radius, skip)
            else:
                cutat = int(np.searchsorted(g[:, 4], g[0, 3]))
                pairs = ((i, j + cutat) for i, j in near_pairs(fps[:cutat], fps[cutat:], radius, skip)) if 0 < cutat < len(fps) else iter(())
            label = _forest(len(fps), pairs)
            moved = np.nonzero(label != np.arange(len(fps)))[0]
            return g[moved, 5], g[label[moved], 5]

        rest = np.empty((0, 6), np.int64)
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for x in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in x.columns], axis=1)
            rest = np.concatenate([rest, rows])
            cuts = np.nonzero((rest[1:, :4] != rest[:-1, :4]).any(axis=1))[0] + 1
            groups = np.split(rest, cuts)
            rest = groups.pop()
            found = [links(g) for g in groups if len(g) > 1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=schema)
        if len(rest) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in links(rest)], schema=schema)

    return tiled.mapInArrow(run, "a long, b long")


def _named(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, h, fp, root of the component, component_id; one row per input row."""
    fps = cut(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    label = components(hamming_links(nodes.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    rooted = cut(nodes.join(label, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")), "rooted")
    first = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return fps.join(rooted.join(first, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id that links of at most `radius` bits reach.

    Null texts count as empty: fingerprint zero, linked like any other. Every row of the input, repeated ones too, has its row. A row
    whose doc_id is null gets its component's smallest doc_id, null if there is none. An empty table gives no row.
    """
    return _named(docs, shingle, radius, id_col, text_col).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Blocks of the second fingerprint (least hashes of a text's shingles) and the least hashes that make up one.
BLOCKS, DEPTH = 12, 4
#: Bits of 64 that may differ between candidates: at a similarity of 0.8 ten do, with a deviation of three.
REACH = 20
#: Shingles in a tile of candidates that are compared exactly; larger groups are split into tiles that are compared pair by pair.
SHINGLES = 500_000
_SALTS = np.random.default_rng(42).integers(0, 1 << 64, (2, BLOCKS * DEPTH), np.uint64) | np.array([[0], [1]], np.uint64)


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a text of fewer words is one shingle, also one without any."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[i : i + size]), 42) for i in range(max(1, len(words) - size + 1))], np.uint64))


def sketch(h: np.ndarray) -> tuple[int, np.ndarray]:
    """SimHash of distinct shingles, and BLOCKS keys. Texts of similarity 0.8 agree on a key with a chance of 0.998."""
    ones, least = np.zeros(64, np.int64), np.full(BLOCKS * DEPTH, ~np.uint64(0))
    for k in range(0, len(h), 4096):
        part = h[k : k + 4096]
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        np.minimum(least, ((part ^ _SALTS[0][:, None]) * _SALTS[1][:, None]).min(axis=1), out=least)
    keys = np.zeros(BLOCKS, np.uint64)
    for column in least.reshape(BLOCKS, DEPTH).T:
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return int(np.packbits(2 * ones > len(h)).view("<u8")[0]), keys


def candidate_links(nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """Nodes (h, fp, keys) to links (a, b) of h that connect all that agree on a key and differ in REACH bits at most."""
    keyed = nodes.select("h", "fp", F.posexplode("keys").alias("t", "key"))
    sizes = keyed.groupBy("t", "key").count().where("count > 1")
    tiled = keyed.join(sizes, ["t", "key"]).withColumn("tiles", F.ceil(F.col("count") / tile).cast("int")).withColumn("own", F.pmod(F.xxhash64("h", "t"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).where("tiles = 1 or own <> other")
    tiled = tiled.select("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "h")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiled = tiled.repartition(parts, "t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, told = [], [], 0
        for g in groups(batches, 4):
            fps = np.ascontiguousarray(g[:, 4]).view(np.uint64)
            if len(g) == 2:
                label = np.array([0, 0 if int(fps[0] ^ fps[1]).bit_count() <= REACH else 1])
            else:
                label = _forest(len(fps), near_pairs(fps, fps, REACH))
            moved = np.nonzero(label != np.arange(len(fps)))[0]
            a.append(g[moved, 5])
            b.append(g[label[moved], 5])
            told += len(moved)
            if told > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
                a, b, told = [], [], 0
        if told:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return tiled.mapInArrow(run, "a long, b long").distinct()


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """The smallest index that each of the sets hangs together with by steps of at least `similarity` (Jaccard), exactly.

    Sets are passed over breadth first; one that is reached is not compared with others that were reached before.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    ends = np.cumsum(size)
    flat, number = np.unique(np.concatenate(sets), return_inverse=True)
    holders = np.repeat(np.arange(len(sets)), size)[np.argsort(number, kind="stable")]
    many = np.bincount(number, minlength=len(flat))
    first = np.cumsum(many) - many
    label, open_ = np.arange(len(sets)), np.ones(len(sets), bool)
    for root in range(len(sets)):
        if not open_[root]:
            continue
        open_[root] = False
        todo = [root]
        while todo and open_.any():
            i = todo.pop()
            own = number[ends[i] - size[i] : ends[i]]
            n = many[own]
            at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(holders[at], minlength=len(sets))
            near = np.nonzero(open_ & (both >= similarity * (size[i] + size - both) - 1e-9))[0]
            label[near], open_[near] = root, False
            todo.extend(near.tolist())
    return label


def similar_links(texts: DataFrame, nodes: DataFrame, size: int, similarity: float, limit: int = SHINGLES) -> DataFrame:
    """texts: (h, text); nodes: (h, n, root), n shingles, candidates of one root. Links (a, b) of h: all that hang together by `similarity`."""
    volume = nodes.groupBy("root").agg(F.ceil(F.sum("n") / limit).cast("int").alias("tiles"))
    dealt = nodes.join(volume, "root").withColumn("own", F.pmod(F.xxhash64("h"), F.col("tiles")).cast("int"))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for at in range(0, x.num_rows, 64):
                y = x.slice(at, 64)
                sets = pa.array([shingles(t, size).view(np.int64) for t in y.column(4).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*y.columns[:4], sets], ["h", "root", "own", "tiles", "shingles"])

    rows = texts.join(dealt, "h").select("h", "root", "own", "tiles", "text").mapInArrow(cut_up, "h long, root long, own int, tiles int, shingles array<long>")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).where("tiles = 1 or own <> other")
    rows = rows.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "h", "shingles")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> pa.RecordBatch:
            label = similar(sets, similarity)
            moved = np.nonzero(label != np.arange(len(sets)))[0]
            h = np.array(names, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(h[moved]), pa.array(h[label[moved]])], ["a", "b"])

        now, names, sets = None, [], []
        for x in batches:
            flat, at = x.column(4).flatten().to_numpy(), x.column(4).offsets.to_numpy()
            at = at - at[0]
            for k, who in enumerate(zip(*(x.column(c).to_pylist() for c in range(4)))):
                if who[:3] != now:
                    if len(sets) > 1:
                        yield links()
                    now, names, sets = who[:3], [], []
                if not names or names[-1] != who[3]:
                    names.append(who[3])
                    sets.append(flat[at[k] : at[k + 1]].copy())
        if len(sets) > 1:
            yield links()

    return rows.mapInArrow(run, "a long, b long")


def deduplicate(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with all its columns, of texts that hang together by shingles of a Jaccard similarity of at least `similarity` one row: the one
    with the smallest doc_id.

    Candidates agree on a block of the second fingerprint and differ in REACH bits of the first at most; only what exact shingles prove is linked. Null texts count as empty, and texts without a word are alike. Of rows that share the smallest
    doc_id, too, the first as JSON stays. An empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sets = [shingles(t, shingle) for t in x.column(1).to_pylist()]
            made = [sketch(h) for h in sets]
            keys = pa.array([k.view(np.int64) for _, k in made], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(2), pa.array(np.array([f for f, _ in made], np.uint64).view(np.int64)), pa.array(np.array([len(h) for h in sets], np.int64)), keys], ["doc_id", "h", "fp", "n", "keys"])

    own = id_text(docs, id_col, text_col, with_hash=True)
    rows = cut(own.mapInArrow(run, "doc_id long, h long, fp long, n long, keys array<long>"), "sketches")
    nodes = cut(rows.groupBy("h").agg(F.min("doc_id").alias("rep"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("keys").alias("keys")), "nodes")
    near = components(candidate_links(nodes)).withColumnRenamed("node", "h")
    near = cut(nodes.select("h", "n").join(near.unionByName(near.select(F.col("root").alias("h"), "root").distinct()), "h"), "candidates")
    label = components(similar_links(own.select("h", "text"), near, shingle, similarity)).select(F.col("node").alias("h"), "root")
    rooted = cut(nodes.select("h", "rep").join(label, "h", "left").select("h", "rep", F.coalesce("root", "h").alias("group")), "rooted")
    first = rooted.groupBy("group").agg(F.min("rep").alias("least"))
    named = rows.select("doc_id", "h").join(rooted.join(first, "group").select("h", "group", "least"), "h")
    named = cut(named.select("doc_id", "h", "group", F.col("doc_id").eqNullSafe(F.col("least")).alias("kept")), "named")
    return drop_rows(docs, named, id_col, text_col)
