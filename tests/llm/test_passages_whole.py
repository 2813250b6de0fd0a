"""Passages against brute force: every equal run of 50 words that two documents share lies in one row of each."""

import random
import time
from collections import defaultdict

import numpy as np
import pytest

from placeforge.llm import passages

SF = "/root/testdata/sf0.001"


def runs(texts, n=50):
    """{run: {doc_id: [places]}} of the runs that several documents hold."""
    held = defaultdict(lambda: defaultdict(list))
    for who, text in texts:
        w = (text or "").encode().lower().split()
        for i in range(len(w) - n + 1):
            held[hash(tuple(w[i : i + n]))][who].append(i)
    return {k: v for k, v in held.items() if len(v) > 1}


def lost(texts, rows, n=50):
    """Places (doc_id, word) of shared runs that lie in no single row of their document."""
    spans = defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.start, r.end))
        spans[r.partner_id].append((r.partner_start, r.partner_end))
    return {(who, i) for v in runs(texts, n).values() for who, at in v.items() for i in at if not any(a <= i and i + n <= b for a, b in spans[who])}


def false(texts, rows):
    of = {who: (t or "").encode().lower().split() for who, t in texts}
    bad = []
    for r in rows:
        a, b = of[r.doc_id][r.start : r.end], of[r.partner_id][r.partner_start : r.partner_end]
        if len(a) != r.end - r.start or len(b) != r.partner_end - r.partner_start or min(len(a), len(b)) < 50 or r.identity < 0.8 or r.doc_id == r.partner_id:
            bad.append(r)
    return bad


def repeated(seed):
    """Documents of few lines that recur within and between them, with pieces of each other's passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    line = lambda n: [word() for _ in range(n)]
    lines, long = [line(rng.randint(4, 30)) for _ in range(12)], [line(rng.randint(50, 90)) for _ in range(6)]
    texts = []
    for who in range(60):
        w = []
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.4:
                w += rng.choice(lines) * rng.choice((1, 1, 2, 5))
            elif kind < 0.6:
                w += rng.choice(long)
            elif kind < 0.8:
                own = rng.choice(long)
                w += own[rng.randint(0, 20) : rng.randint(25, len(own))]
            else:
                w += line(rng.randint(1, 60))
        texts.append((who, " ".join(w)))
    texts += [(60, " ".join(["same"] * 300)), (61, " ".join(["same"] * 170)), (62, " ".join(["same"] * 49)), (63, ""), (64, None)]
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_runs_lie_in_single_rows_in_texts_with_repeated_lines(spark, monkeypatch, seed):
    if seed:  # all seeds are common and dealt to shares
        monkeypatch.setattr(passages, "COMMON", -1)
        monkeypatch.setattr(passages, "SAMPLE", 1)
        monkeypatch.setattr(passages, "SHARES", 5)
    texts = repeated(seed)
    rows = passages.shared_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert not lost(texts, rows) and not false(texts, rows)
    assert len({(r.doc_id, r.start, r.end, r.partner_id, r.partner_start, r.partner_end) for r in rows}) == len(rows)


def test_runs_lie_in_single_rows_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = passages.shared_passages(docs).collect()
    assert not lost(texts, rows) and not false(texts, rows)
    pairs = defaultdict(int)
    for r in rows:
        pairs[r.doc_id, r.partner_id] += 1
    assert max(pairs.values(), default=0) <= 20


def test_clashing_columns_and_a_long_text(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    long = [word() for _ in range(30_000)]
    texts = [(1, " ".join(long)), (2, " ".join([word()] + long)), (3, " ".join(long[29_000:]))]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in texts], "doc_id long, text string, seed int, place int, near int")
    rows = passages.shared_passages(df).collect()
    assert not lost(texts, rows) and sorted((r.doc_id, r.start, r.end, r.partner_id) for r in rows) == [(2, 1, 30_001, 1), (3, 0, 1000, 1)]


def test_matches_are_the_same_in_batches_of_any_size(spark):
    """The i-th place goes with the i-th or last one of the first holder; what he has more, with the last one of the second."""
    rng = np.random.default_rng(3)
    rows = sorted({(int(a), int(b), 2 * int(c) + 1) for a, b, c in zip(rng.integers(0, 40, 3000), rng.zipf(1.4, 3000) % 30, rng.integers(0, 300, 3000))})
    want, held = [], defaultdict(lambda: defaultdict(list))
    for seed, who, place in rows:
        held[seed][who].append(place >> 1)
    for seed, of in held.items():
        first, *others = sorted(of)
        for who in others:
            want += [(seed, who, first, of[first][min(i, len(of[first]) - 1)], y) for i, y in enumerate(of[who])]
        for x in of[first][max((len(of[o]) for o in others), default=10**9) :]:
            want.append((seed, others[0], first, x, of[others[0]][-1]))
    df = spark.createDataFrame(rows, "seed long, doc_id long, place long")
    for size in (1, 7, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = passages._matches(df, lambda c: c.isNull()).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted(map(tuple, got)) == sorted(want)


def test_rows_within_others_of_their_pair_go():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = rng.integers(0, 20, (2, 15, 1))
        rows = np.concatenate([a, a + rng.integers(1, 9, (15, 1)), b, b + rng.integers(1, 9, (15, 1)), a], axis=1)
        kept = passages.outer_rows(rows).tolist()
        inside = lambda r, of, c: any(o[c] <= r[c] and o[c + 1] >= r[c + 1] for o in of)
        assert {tuple(r) for r in kept} <= {tuple(r) for r in rows.tolist()}
        assert all(inside(r, kept, 0) and inside(r, kept, 2) for r in rows.tolist())
        assert not any(inside(r, kept[:i], 0) and inside(r, kept[:i], 2) for i, r in enumerate(kept))


def test_loose_runs_are_brute_force():
    rng = np.random.default_rng(6)
    s = passages.Settings(k=3, window=4, min_words=12)
    for _ in range(300):
        at = np.unique(np.cumsum(rng.choice([1, 2, 3, 4, 9], rng.integers(1, 40))))
        starts = np.sort(rng.integers(0, 80, rng.integers(0, 4)))
        ends = starts + rng.integers(12, 40, len(starts))
        shared, open_, picked = passages.loose_runs(at, starts, ends, s)
        n = int(at[-1]) + 30
        drawn = set(at.tolist())
        may = [y for y in range(n) if all(drawn & set(range(z, z + s.window)) for z in range(y, y + s.min_words - s.k - s.window + 2))]
        told = {y for a, b in shared for y in range(a, b + 1)}
        assert set(may) <= told
        bare = {y for y in told if not any(a <= y and y + s.min_words <= b for a, b in zip(starts, ends))}
        assert bare == {y for a, b in open_ for y in range(a, b + 1)}
        for y in bare & set(may):
            assert any(y <= p <= y + s.min_words - s.k for p in picked)


def test_words_of_texts_are_those_of_a_plain_split(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice(" \t\n\r\x0b\x0cabABéÉ\x1c\x85") for _ in range(rng.choice((0, 1, 5, 200)))).encode() for _ in range(300)] + [b"x" * 500, b"", b" "]
    plain = [t.lower().split() for t in texts]
    for block in (3, 64, 1 << 17):  # words longer than a block, too
        monkeypatch.setattr(passages, "BLOCK", block)
        got = [np.frombuffer(w, np.uint32).tolist() for w in passages.word_hashes(texts)]
        assert [len(w) for w in got] == [len(w) for w in plain]
        of = {}
        assert all(of.setdefault(w, h) == h for ws, hs in zip(plain, got) for w, h in zip(ws, hs)) and len(set(of.values())) == len(of)
    assert passages.word_hashes([]) == []


def test_seeds_of_texts_together_are_those_of_each():
    rng = np.random.default_rng(9)
    s = passages.Settings()
    for _ in range(30):
        texts = [rng.integers(0, 30, n).astype(np.uint32) for n in rng.choice([0, 1, 7, 8, 9, 14, 15, 16, 90], rng.integers(1, 12))]
        hashes, at, own = passages.seeds_of_texts(np.concatenate(texts), np.cumsum([len(t) for t in texts]), s)
        want = {(i, int(h), int(a)) for i, t in enumerate(texts) for h, a in zip(*passages.seeds(t, s))}
        assert sorted(zip(own.tolist(), hashes.tolist(), at.tolist())) == sorted(want)


def edited_among_pieces(n, seed=11):
    """n pairs that share 60 words with two changed ones, made of pieces that three documents of lower ids hold each on its own, and all rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    line = lambda k: [word() for _ in range(k)]
    rows, pairs = [], []
    for i in range(n):
        a, b, c = line(20), line(20), line(20)
        for k, piece in enumerate((a, b, c)):
            rows.append((3 * i + k, line(25) + piece + line(25)))
        for k in range(2):
            rows.append((3 * n + 2 * i + k, line(30) + a + line(1) + b + line(1) + c + line(30)))
        pairs.append((3 * n + 2 * i + 1, 3 * n + 2 * i))
    return [(i, " ".join(w)) for i, w in rows], pairs


def test_edited_passages_whose_seeds_all_go_to_others(spark, monkeypatch):
    texts, pairs = edited_among_pieces(40)
    for common in (100, -1):
        monkeypatch.setattr(passages, "COMMON", common)
        monkeypatch.setattr(passages, "SAMPLE", 1 if common < 0 else 64)
        rows = passages.shared_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
        assert not false(texts, rows)
        whole = {(r.doc_id, r.partner_id) for r in rows if r.start <= 30 and r.end >= 92 and r.partner_start <= 30 and r.partner_end >= 92}
        assert whole == set(pairs), len(whole & set(pairs))


def test_chains_of_places_that_many_others_share():
    """anchors were asked one by one over the whole window, the square of a place that thousands are matched with."""
    rng, s = np.random.default_rng(3), passages.Settings()
    near = lambda d: (0 < d).all(-1) & (d <= s.max_gap + s.k).all(-1) & (np.abs(d[..., 0] - d[..., 1]) <= s.max_shift)
    columns = 0
    for _ in range(150):
        x, y = rng.integers(0, 300, rng.integers(1, 12)), rng.integers(0, rng.integers(30, 900), rng.integers(1, 90))
        a = np.unique(np.column_stack([rng.choice(x, 300), rng.choice(y, 300)]), axis=0)
        a = a[np.lexsort((-a[:, 1], a[:, 0]))]
        columns += len(a) >= passages.COLUMN * len(np.unique(a[:, 0]))
        got = passages._by_columns(a, s)
        assert got == passages._by_tree(a, s)
        score, back = got
        d = a[:, None] - a[None]
        best = np.zeros(len(a))
        for i in range(len(a)):  # the definition: a chain that is best of all, or else best of the near ones
            below = np.nonzero((d[i] > 0).all(1))[0]
            gain = np.array([score[j] - s.gap_cost * d[i, j].sum() for j in below])
            held = near(d[i][below])
            best[i] = s.k + max([0.0, *gain[held]])
            assert back[i] < 0 or near(d[i, back[i]])
        assert np.allclose(score, best)
    assert columns > 50
    xs, ys = np.meshgrid(np.arange(0, 160, 4), np.arange(0, 8000, 8))
    many = np.column_stack([xs.ravel(), ys.ravel()])  # 40,000 anchors in 40 columns
    before = time.process_time()
    passages.chain(many, s)
    assert time.process_time() - before < 20


def test_extend_takes_the_least_edit():
    """a changed word is passed at once, and four words are met as two pairs; both as by the whole table of words."""

    def slow(p, q, s):
        run = min(4, len(p), len(q))
        moves = [(max(i, j) * 64 + abs(i - j), i, j) for i in range(min(len(p) - run, s.band) + 1) for j in range(min(len(q) - run, s.band) + 1) if (p[i : i + run] == q[j : j + run]).all()]
        return min(moves)[1:] if moves else None

    def whole(a, b, s):
        i = j = equal = score = best = 0
        end = (0, 0, 0)
        while True:
            run = 0
            while i + run < len(a) and j + run < len(b) and a[i + run] == b[j + run]:
                run += 1
            i, j, equal, score = i + run, j + run, equal + run, score + run
            if score > best and run:
                best, end = score, (i, j, equal)
            if i >= len(a) or j >= len(b):
                return end
            p, q = a[i : i + s.band + s.k], b[j : j + s.band + s.k]
            move = slow(p, q, s)
            if move is None:
                return end
            kept = int((p[: move[0]] == q[: move[1]]).sum()) if move[0] == move[1] else 0
            i, j, equal, score = i + move[0], j + move[1], equal + kept, score + kept - 2 * (max(move) - kept)
            if score < best - s.drop:
                return end

    rng, s = np.random.default_rng(4), passages.Settings()
    for k in range(300):
        a = rng.integers(0, 5 if k % 3 else 4_000_000_000, rng.integers(0, 120)).astype(np.uint32)
        b = list(a)
        for _ in range(rng.integers(0, 9)):
            at, kind = int(rng.integers(0, len(b) + 1)), rng.integers(0, 3)
            b[at : at + (kind > 0)] = [int(rng.integers(0, 9))] * int(kind < 2)
        b = np.array(b, np.uint32)
        assert passages.extend(a, b, s) == whole(a, b, s)


def edited(rng, n, length, edits):
    """n pairs of word rows, the second with up to so many edits, as one array, and starts and lengths of both sides."""
    rows = []
    for k in range(n):
        a = rng.integers(0, 5 if k % 3 == 0 else 4_000_000_000, rng.integers(0, length)).astype(np.uint32)
        b = list(a)
        for _ in range(rng.integers(0, edits)):
            at, kind = int(rng.integers(0, len(b) + 1)), rng.integers(0, 3)
            b[at : at + (kind > 0) * int(rng.integers(1, 6))] = [int(rng.integers(0, 9))] * int((kind < 2) * rng.integers(1, 20))
        rows += [a, np.array(b, np.uint32)]
    lengths = np.array([len(r) for r in rows]).reshape(-1, 2)
    return rows, np.concatenate(rows), (np.cumsum(lengths) - lengths.ravel()).reshape(-1, 2), lengths


@pytest.mark.parametrize("step", (1, -1))
def test_extending_many_pairs_is_extending_each(step):
    """F1 (1226 CPU seconds a GB): each pair was aligned on its own."""
    rng, s = np.random.default_rng(5), passages.Settings()
    for n in (1, passages.FEW, 90, 90, 90, 90, 90, 90):
        rows, words, starts, lengths = edited(rng, n, 300, 20)
        got = passages.extend_many(words, starts + (lengths - 1) * (step < 0), lengths, step, s)
        assert [tuple(g) for g in got.tolist()] == [passages.extend(a[::step], b[::step], s) for a, b in zip(rows[::2], rows[1::2])]
    one = rng.integers(0, 4_000_000_000, 100_000).astype(np.uint32)  # a long equal stretch beside short ones
    words, starts, lengths = np.tile(one, 2), np.array([[0, 100_000]] + [[k, 100_000 + k] for k in range(20)]), np.array([[100_000] * 2] + [[30, 40]] * 20)
    assert passages.extend_many(words, starts, lengths, 1, s).tolist() == [[100_000] * 3] + [[30, 30, 30]] * 20


def test_many_pairs_cost_less_than_each_on_its_own():
    """as above; most chains end after a few words, each for the price of a dozen calls."""
    rng, s = np.random.default_rng(6), passages.Settings()
    rows, words, starts, lengths = edited(rng, passages.PAIRS, 120, 8)
    before = time.process_time()
    each = [passages.extend(a, b, s) for a, b in zip(rows[::2], rows[1::2])]
    middle = time.process_time()
    many = passages.extend_many(words, starts, lengths, 1, s)
    assert each == [tuple(g) for g in many.tolist()]
    assert time.process_time() - middle < 0.6 * (middle - before)


def test_chains_of_many_pairs_are_those_of_each():
    rng, s = np.random.default_rng(7), passages.Settings()
    for k in range(200):
        g = rng.integers(0, (4, 3, 300, 300), (60, 4))
        if k % 2:  # mostly anchors that follow each other
            g[:, 3] = g[:, 2] + rng.integers(0, 3, len(g))
        g = np.unique(g[: rng.integers(1, 61)], axis=0)
        want = [(*q, c[0, 1], c[-1, 1] + s.k, c[0, 0], c[-1, 0] + s.k) for q in {tuple(x) for x in g[:, :2].tolist()} for c in passages.chain(g[(g[:, :2] == q).all(axis=1)][:, 2:], s)]
        assert sorted(map(tuple, passages.chains_of_pairs(g, s).tolist())) == sorted(want)


def test_what_is_loose_in_many_documents_is_what_is_in_each():
    rng, s = np.random.default_rng(8), passages.Settings(k=3, window=4, min_words=12)
    kept, every = 0, ([], [], [], [])
    parts = []
    for who in range(60):
        at = np.unique(np.cumsum(rng.choice([1, 2, 3, 4, 30], rng.integers(1, 40))))
        starts = np.sort(rng.integers(0, 80, rng.integers(0, 4)))
        spans = np.column_stack([starts, starts + rng.integers(12, 40, len(starts))])
        own = rng.integers(0, 2, len(starts)) == 0
        seed, head, head_at = rng.integers(-(2**62), 2**62, len(at)), rng.integers(0, 3, len(at)), rng.integers(0, 90, len(at))
        runs = passages.loose_runs(at, spans[:, 0], spans[:, 1], s)
        v, p, size = passages.sequences(at, seed, head, head_at, spans, own, s)
        base = who * passages.OWN
        for c, more in zip(every, ([(a + base, b + base) for a, b in runs[0]], [(a + base, b + base) for a, b in runs[1]], [a + base for a in runs[2]], zip(v.tolist(), (p + 2 * base).tolist(), size.tolist()))):
            c += more
        parts.append((at + base, seed, head, head_at, spans + base, own))
        kept += len(p)
    at, seed, head, head_at, spans, own = (np.concatenate(c) for c in zip(*parts))
    runs = passages.loose_runs(at, spans[:, 0], spans[:, 1], s)
    v, p, size = passages.sequences(at, seed, head, head_at, spans, own, s)
    assert list(runs) == list(every[:3]) and kept and sorted(zip(v.tolist(), p.tolist(), size.tolist())) == sorted(every[3])
