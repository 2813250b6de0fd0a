"""Sharding, whitening and the conversation trie against brute force, with nulls, ties, repeated rows, hot groups and clashing columns."""

import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from placeforge.llm import queries, sharding, trie, whitening

SMALL = "/root/testdata/sf0.001"


def brute_tree(rows, n_shards):
    """rows: (coordinates, key below them, size) by position; the shards of a k-d tree by plain sorting."""
    out = {}

    def cut(own, first, n):
        if n == 1 or not own:
            out.update((k, first) for k in own)
            return
        spans = [max(rows[k][0][d] for k in own) - min(rows[k][0][d] for k in own) for d in range(len(rows[own[0]][0]))]
        d = spans.index(max(spans))
        own = sorted(own, key=lambda k: (rows[k][0][d], rows[k][1]))
        goal, at = sum(rows[k][2] for k in own) * (n // 2) / n, 0
        for i, k in enumerate(own):
            if at + rows[k][2] >= goal:
                break
            at += rows[k][2]
        i += abs(at + rows[own[i]][2] - goal) < abs(goal - at)
        cut(own[:i], first, n // 2)
        cut(own[i:], first + n // 2, n - n // 2)

    cut(list(range(len(rows))), 0, n_shards)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(k, "x" * int(rng.paretovariate(1) * 20), rng.choice(["en", "en", "de", None]), "hot" if k % 3 else f"s{k % 7}", None if k % 11 == 0 else rng.randint(1, 400), "z", 1) for k in range(400)]
    rows += [(1000 + k, "copy of one text " * 9, "en", "hot", 153, "z", 1) for k in range(200)]
    rows += [(None, "no id", None, None, None, None, None), (None, "no id", None, None, None, None, None), (5, None, "en", "hot", 0, "z", 1), (5, None, "en", "hot", 0, "z", 1), (2000, "é" * 3000, "fr", "s1", 3000, "z", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, slot int").repartition(3).cache()


@pytest.mark.parametrize("n_shards,cells", [(16, 1 << 17), (16, 16 * 8), (5, 64), (1, 64)])
def test_shards_against_sorting(spark, docs, monkeypatch, n_shards, cells):
    monkeypatch.setattr(sharding, "CELLS", cells)
    monkeypatch.setattr(sharding, "NUMBERED", 20)
    monkeypatch.setattr(sharding, "LEVEL", False)
    seen = {}
    real = sharding._metadata
    monkeypatch.setattr(sharding, "_metadata", lambda *a: seen.setdefault("meta", real(*a)))
    got = sharding.kd_shards(docs, n_shards=n_shards).collect()
    assert len(got) == docs.count()
    meta = seen["meta"].collect()
    ends = [(min((r[f"d{k}"] for r in meta if r[f"d{k}"] is not None)), max((r[f"d{k}"] for r in meta if r[f"d{k}"] is not None))) for k in range(3)]
    place = lambda v, lo, hi: -(1 << 52) if v is None else round((v / 2 - lo / 2) / (hi / 2 - lo / 2) * (1 << 52))
    rows = [([place(r[f"d{k}"], *ends[k]) for k in range(3)], (r.tie, r.uid), r.size) for r in meta]
    want = brute_tree(rows, n_shards)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in got) == Counter((r.doc_id, r.size, r.text_crc32, want[k]) for k, r in enumerate(meta))
    for s in range(n_shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_shards_are_even_and_keep_what_they_got(spark, docs, tmp_path):
    got = sharding.kd_shards(docs, n_shards=16, keep=True)
    rows = got.collect()
    sizes = Counter()
    for r in rows:
        text = (r.row.text or "").encode()
        assert (r.size, r.text_crc32, r.doc_id) == (len(text) + 1, crc32(text), r.row.doc_id)
        sizes[r.shard] += r.size
    even = Counter()
    for r in sharding.kd_shards(docs.where("text is null or length(text) < 900"), n_shards=16).collect():
        even[r.shard] += r.size
    assert len(even) == 16 and max(even.values()) - min(even.values()) < 0.05 * sum(even.values()) / 16
    assert Counter(r.row for r in rows) == Counter(docs.collect())
    copies = Counter(r.shard for r in rows if r.row.text and r.row.text.startswith("copy"))
    assert len(copies) > 1  # a group that outweighs a shard is cut
    sharding.write_shards(docs, str(tmp_path / "out"), target_bytes=16000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == math.ceil(sum(sizes.values()) / 16000)


def test_shards_of_few_rows(spark, docs):
    assert sharding.kd_shards(docs.limit(0), n_shards=16).collect() == []
    three = sharding.kd_shards(docs.where("doc_id in (1, 2, 3)").select("doc_id", "text"), n_shards=16).collect()
    assert len(three) == 3 and len({(r.shard, r.slot) for r in three}) == 3
    same = spark.createDataFrame([(1, "same")] * 64, "doc_id long, text string")
    assert set(Counter(r.shard for r in sharding.kd_shards(same, n_shards=16).collect()).values()) == {4}
    with pytest.raises(ValueError):
        sharding.kd_shards(docs, n_shards=1 << 14)


def brute_whitening(vectors, most=16):
    kept = [(i, v) for i, v in vectors if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = (n * fit - s) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    white = ((n * x - s) / n) @ v[:, :most] / np.sqrt(e[:most])
    return [i for i, _ in kept], n, [sum(int(c) ** 2 for c in row) for row in n * x - s], white, e[:most] / e.sum()


def check_whitening(got, vectors, components):
    ids, n, deviation, white, explained = brute_whitening(vectors, components)
    assert len(got) == len(ids) * components
    signs = {}
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    for k, i in enumerate(ids):
        for c in range(components):
            match = [r for r in by[i, c + 1] if abs(abs(r.whitened) - abs(white[k, c])) < 1e-8 and r.deviation == deviation[k]]
            assert match, (i, c)
            r = match[0]
            assert r.n == n and abs(r.explained / explained[c] - 1) < 1e-9 and r.identity_error < 1e-9
            if abs(white[k, c]) > 1e-3:
                assert signs.setdefault(c, math.copysign(1, r.whitened * white[k, c])) == math.copysign(1, r.whitened * white[k, c])


def test_whitening_against_eigenvectors(spark):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(20, 20)) * np.geomspace(9, 0.2, 20)
    rows = [(k, [float(np.float32(c)) for c in mix @ rng.normal(size=20)], 1) for k in range(300)]
    rows += [(1000 + k, rows[7][1], 2) for k in range(150)]  # copies count once
    rows += [(3000, None, 1), (3001, [1.0] * 19 + [None], 1), (3002, [float("nan")] * 20, 1), (3003, [float("inf")] + [0.0] * 19, 1), (3004, [], 1), (None, rows[3][1], 1), (9, rows[9][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int").repartition(5)
    check_whitening(whitening.whiten(table).collect(), [(i, v) for i, v, _ in rows], 16)
    assert whitening.whiten(table.limit(0)).collect() == [] and whitening.whiten(table.where("vec_id = 9")).collect() == []
    check_whitening(whitening.whiten(spark.read.parquet(f"{SMALL}/embeddings.parquet")).collect(), [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()], 16)


def test_whitening_without_full_rank(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [a, 2 * a, b, 5.0, -b]) for k, (a, b) in enumerate(rng.integers(-500, 500, (200, 2)).astype(float).tolist())]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-9
    odd = spark.createDataFrame([*rows, (900, [1.0]), (901, [2.0])], "vec_id long, embedding array<double>")
    assert len(whitening.whiten(odd).collect()) == len(got)  # the commonest width counts


def test_shifted_cholesky_qr_of_ill_conditioned_rows(spark):
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(400, 6)) * [1e8, 1e6, 1e4, 1e3, 300, 300]).astype(np.int64)
    x[:, 1] += x[:, 0]
    fit = spark.createDataFrame([(row,) for row in x.tolist()], "x array<bigint>").repartition(3)
    n, sums = len(x), x.sum(axis=0)
    r = whitening.shifted_cholesky_qr(fit, n, sums)
    y = whitening.centred(x, n, sums)
    q = whitening.solve_right(y, r)
    assert np.allclose(np.linalg.svd(r)[1], np.linalg.svd(y)[1], rtol=1e-7) and np.abs(q.T @ q - np.eye(6)).max() < 1e-9 and np.allclose(np.tril(r, -1), 0)


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    own = {c: [(x[2], x[3]) for x in sorted(v, key=lambda x: (x[0], x[1] or 0))] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + v[h:]
    members = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    out = {}
    for node, m in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[: len(x)] == x and len(y) == len(x) + 1 for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(node))))
        out[min(m), len(node)] = (min(members[node[:-1]]) if node else None, len(m), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


CONVERSATIONS = [
    *[(c, k, r, f"turn {k}") for c in range(10, 40) for k, r in enumerate(["system", "user", "assistant", "user"][: c % 5])],
    *[(c, k, "user", f"long {k if c < 62 or k < 30 else -k}") for c in range(60, 66) for k in range(40)],
    *[(c, None if k == 0 else k, None if k == 1 else "user", None if k == 2 else f"{c % 2} é") for c in range(70, 90) for k in range(4)],
    (None, 1, "user", "nobody's"), (95, 3, "user", ""), (96, 1, "", "user"), (97, 1, "user", ""),
]


@pytest.mark.parametrize("tree_bytes,chunk", [(32 << 20, 1 << 16), (300, 7)])
def test_trie_against_brute_force(spark, monkeypatch, tree_bytes, chunk):
    monkeypatch.setattr(trie, "TREE_BYTES", tree_bytes)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    turns = spark.createDataFrame([(*x, 1) for x in CONVERSATIONS], "conv_id long, turn long, role string, text string, n_convs int").repartition(4)
    got = trie.prefix_trie(trie.spliced(trie.turn_lists(turns))).collect()
    want = brute_trie(CONVERSATIONS)
    assert {(r.conv_id, r.depth): tuple(r)[2:] for r in got} == want and len(got) == len(want)
    assert trie.prefix_trie(trie.spliced(trie.turn_lists(turns.limit(0)))).collect() == []


def test_trie_of_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {(r.conv_id, r.depth): tuple(r)[2:] for r in queries.op13_trie(spark, SMALL).collect()} == brute_trie(rows)


def test_trie_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    want = con.sql(f"select {', '.join(names)} from ({queries.ORACLE_SQL['op13_trie']})").fetchall()
    got = queries.op13_trie(spark, SMALL)
    assert got.columns == names and Counter(map(tuple, got.collect())) == Counter(want)


def test_radix_tree_layouts():
    rng = random.Random(8)
    for fan in (3, 16, 17, 48, 49, 256):
        keys = [bytes([k]) + rng.randbytes(15) for k in range(fan)] + [b""]
        keys += [keys[0] + rng.randbytes(16) for _ in range(5)] * 2
        tree = trie.RadixTree()
        for n, k in enumerate(keys):
            tree.insert(k, n, [1] * (len(k) // 16))
        assert tree.root.children.size == fan and tree.root.children.most == next(m for m in (4, 16, 48, 256) if fan <= m)
        want = Counter(k[: 16 * d] for k in keys for d in range(len(k) // 16 + 1))
        name = lambda p: trie.path_ids([p[i : i + 16] for i in range(0, len(p), 16)])[-1]
        got = {x[0]: x for x in tree.nodes()}
        assert {k: x[4] for k, x in got.items()} == {name(p): c for p, c in want.items()}
        for p in want:
            own = [n for n, k in enumerate(keys) if k.startswith(p)]
            x = got[name(p)]
            assert x[3] == min(own) and sorted(x[6]) == [n for n, k in enumerate(keys) if k == p] and x[2] == len(p) // 16 and (x[1] == name(p[:-16]) if p else x[1] is None)
