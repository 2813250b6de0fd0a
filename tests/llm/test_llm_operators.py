"""Operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns; against brute force."""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from placeforge.llm import exact, graph, html, licenses, packing, passages, pieces, pii, quality, simhash, toxicity

tokenizers = pytest.importorskip("public_tokenizers")
RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 8))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


LONG = prose(30_000)
ONE = prose(120)
TEXTS = [(1, ONE), (2, ONE), (2, ONE), (3, ONE.replace(" ", "  \n")), (None, "no id " + prose(30)), (4, None), (5, ""), (6, " \t\n"), (7, LONG), (8, "é😀 ▁ " + prose(20)), (9, prose(60)), (10, ONE + " x")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, 0.5, "x") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, h string").repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (7, 1, 0), (9, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")


def text(t):
    return t or ""


def test_exact(docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", text(t))
    got = exact.exact_duplicates(docs).collect()
    assert len(got) == len(TEXTS)
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(hashlib.sha256(norm(t).encode()).hexdigest(), []).append(i)
    for r in got:
        own = groups[r.text_sha256]
        least = min((i for i in own if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (least, len(own), r.doc_id == least)
    kept = exact.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_cuckoo_index():
    index, keys = exact.CuckooIndex(4), [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, k in enumerate(keys):
        assert index.get(k) is None
        index.insert(k, [i, 1])
    assert index.resizes > 0 and all(index.get(k) == [i, 1] for i, k in enumerate(keys))
    assert all(index.delete(k) for k in keys[::2]) and not index.delete(keys[0])
    assert [index.get(k) is None for k in keys[:4]] == [True, False, True, False] and index.size == 1500


def test_index_insert_and_delete(spark, docs):
    rows = exact.digests(docs.where("doc_id in (1, 3, 5)"))
    index = exact.insert(exact.build_index(rows.where("doc_id = 3")), rows.where("doc_id <> 3"))
    assert {(r.keep_id, r.group_size) for r in index.collect()} == {(1, 2), (5, 1)}
    less = exact.delete(index, rows.where("doc_id in (1, 5)"), rows.where("doc_id = 3"))
    assert [(r.keep_id, r.group_size) for r in less.collect()] == [(3, 1)]


def brute_fingerprint(t, k=4):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) if x]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs):
    fp = [brute_fingerprint(text(t)) for _, t in TEXTS]
    root = list(range(len(fp)))
    for _ in fp:
        for i in range(len(fp)):
            for j in range(i):
                if bin(fp[i] ^ fp[j]).count("1") <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    want = sorted(("%016x" % f, min((TEXTS[j][0] for j in range(len(fp)) if root[j] == root[i] and TEXTS[j][0] is not None), default=None) or -1) for i, f in enumerate(fp))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.fingerprint, r.component_id or -1) for r in got) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.deduplicate(docs).columns == docs.columns


@pytest.mark.parametrize("radius", [0, 1, 4, 6])
def test_near_pairs_are_brute_force(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = np.array([b ^ sum((np.uint64(1) << np.uint64(k) for k in rng.choice(64, rng.integers(0, 9), replace=False)), np.uint64(0)) for b in base for _ in range(30)], np.uint64)
    got = {(int(a), int(b)) for i, j in simhash.near_pairs(fps, fps, radius) for a, b in zip(i, j)}
    assert got == {(i, j) for i in range(len(fps)) for j in range(len(fps)) if bin(int(fps[i] ^ fps[j])).count("1") <= radius}


def test_tiles_lose_no_link(spark):
    rng = np.random.default_rng(3)
    fps = sorted({int(7 ^ sum(1 << int(k) for k in rng.choice(62, 3, replace=False))) for _ in range(300)} | {7})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    root = graph.components(simhash.hamming_links(nodes, 4, tile=20)).select("root").distinct().collect()
    assert len(root) == 1


def test_near_copies_of_low_similarity(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))

    def jaccard(a, b):
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        return len(x & y) / len(x | y)

    rows, near = [], {}
    for i in range(300):
        a = [word() for _ in range(rng.choice((100, 300)))]
        b = list(a)
        while jaccard(a, b) > rng.uniform(0.7, 0.98):
            b[rng.randrange(len(b))] = word()
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
        near[2 * i + 1] = jaccard(a, b) >= 0.8
    kept = {r.doc_id for r in simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept >= {2 * i for i in range(300)} | {k for k, v in near.items() if not v}
    assert sum(k not in kept for k, v in near.items() if v) >= 0.98 * sum(near.values())


def test_similar_is_brute_force(spark):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(40, rng.integers(20, 40), replace=False)) for _ in range(60)]
    root = list(range(60))
    for _ in sets:
        for i in range(60):
            for j in range(60):
                if 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j])):
                    root[i] = root[j] = min(root[i], root[j])
    assert simhash.similar(sets, 0.8).tolist() == root
    texts = [" ".join(f"w{x}" for x in s) for s in sets]
    nodes = spark.createDataFrame([(i, len(s), 0) for i, s in enumerate(sets)], "h long, n long, root long")
    links = simhash.similar_links(spark.createDataFrame(list(enumerate(t.encode() for t in texts)), "h long, text binary"), nodes, 1, 0.8, limit=400)
    tiled = {r.node: r.root for r in graph.components(links).collect()}
    assert [tiled.get(i, i) for i in range(60)] == root


def test_quality(docs, labels):
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        if r.n_words == 0:
            assert r.base_failed and not r.kept
    text = "a b c d e f\na b c d e f\n\n x # |"
    counts, _ = quality.statistics(text.encode())
    assert counts == [15, 15, 2, 1, 12]
    assert quality.quality(docs.limit(0), labels).count() == 0 and quality.quality(docs, labels.limit(0)).count() == len(TEXTS)


def brute_counts(t):
    """Words, word_chars, n_symbols, n_dup_lines and n_repeat_words as the contract words them."""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    held = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), sum(x in lines[:i] for i, x in enumerate(lines)), len(held)]


def brute_anomaly(forest, row):
    """The mean path of one row, walked node by node, against that of a failed search among as many rows."""
    total = 0.0
    for feature, split, left, right, length in forest.trees:
        at = 0
        while left[at] != at:
            at = left[at] if row[feature[at]] < split[at] else right[at]
        total += length[at]
    m = forest.size
    mean = 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m
    return 2 ** (-total / len(forest.trees) / mean)


def test_quality_is_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, t) for i, (_, t) in enumerate(TEXTS) if t is not LONG]
    for i in range(100, 220):
        good = i % 3 > 0
        t = prose(rng.randint(12, 60)) if good else rng.choice(["$$ | %% " * 8 + prose(12), "\n".join([prose(2)] * 9) + prose(11), prose(14).upper() + "!!! 12345 " * 5])
        rows.append((i, t))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _ in rows if i >= 100], "doc_id long, quality int, toxic int")
    s = quality.Settings(trees=20, rows_a_tree=64)
    rates = {i: quality.statistics(text(t).encode())[1] for i, t in rows}
    x = np.array([rates[i] for i in sorted(rates) if i >= 100])
    y = np.array([int(i % 3 > 0) for i in sorted(rates) if i >= 100])
    forest, most = quality.fit(x, y, s)
    scores = [brute_anomaly(forest, r) for r in x]
    balance = lambda cut: np.mean([v <= cut for v, g in zip(scores, y) if g]) + np.mean([v > cut for v, g in zip(scores, y) if not g])
    assert balance(most) >= max(map(balance, scores)) - 1e-9 and balance(most) > 1.7
    got = {r.doc_id: r for r in quality.quality(df, known, s).collect()}
    for i, t in rows:
        r, counts = got[i], brute_counts(text(t))
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == counts, t
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert abs(r.anomaly - brute_anomaly(forest, rates[i])) < 1e-9 and r.kept == (not r.base_failed and r.anomaly <= most)


@pytest.mark.parametrize("least_quality", [0, 1])
def test_quality_takes_every_labelled_row(spark, least_quality):
    """51,000 labelled rows in several parts give the forest and the threshold of all these rows in memory."""
    word = F.element_at(F.array(*map(F.lit, VOCABULARY)), F.pmod(F.xxhash64("id", "k"), F.lit(len(VOCABULARY))).cast("int") + 1)
    df = spark.range(51_000).select("id", F.explode(F.sequence(F.lit(0), F.lit(10) + (F.col("id") % 17).cast("int"))).alias("k")).withColumn("w", F.when((F.col("id") % 5 == 0) & (F.col("k") % 3 == 0), "$$ #").otherwise(word))
    df = df.groupBy(F.col("id").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "w"))), lambda x: x["w"]), " ").alias("text")).cache()
    known = df.select("doc_id", F.greatest((F.pmod(F.xxhash64("doc_id"), F.lit(10)) + F.when(F.col("doc_id") % 5 == 0, -8).otherwise(8) > 4).cast("int"), F.lit(least_quality)).alias("quality"))
    s = quality.Settings(trees=6, rows_a_tree=32)
    x = np.array([quality.statistics(r.text.encode())[1] for r in df.orderBy("doc_id").collect()])
    forest, most = quality.fit(x, np.array([r.quality for r in known.orderBy("doc_id").collect()]), s)
    want = forest.score(x)
    got = quality.quality(df, known, s).orderBy("doc_id").collect()
    assert np.abs(np.array([r.anomaly for r in got]) - want).max() < 1e-12
    assert [r.kept for r in got] == [not r.base_failed and a <= most for r, a in zip(got, want)]
    assert (most == s.fallback) == bool(least_quality)


def test_toxicity_learns(spark):
    rng = random.Random(1)
    rows = [(i, prose(40) + (" vile" + rng.choice([".", "***"]) + " nasty " if i % 4 == 0 else " ") + prose(5), int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    extra = spark.createDataFrame([(1000, None, 0), (1001, "", 0), (None, "vile nasty", 0)], df.schema)
    got = {r.doc_id: r for r in toxicity.toxicity(df.unionByName(extra).drop("toxic"), df.select("doc_id", "toxic")).collect()}
    held = [i for i in range(400) if crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in held) for i in range(400))
    assert sum(got[i].predicted == int(i % 4 == 0) for i in held) / len(held) > 0.95
    assert got[1000].predicted == 0 and got[1001].predicted == 0 and len(got) == 403
    assert toxicity.keep_clean(df, df.select("doc_id", "toxic")).count() == sum(1 for i in range(400) if not got[i].predicted)


@pytest.mark.parametrize("shards", [2, 3, 7])
def test_toxicity_averages_whole_shards(spark, shards):
    rng = random.Random(shards)
    rows = [(i, prose(15) + (" vile nasty" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(shards * 40)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    s = toxicity.Settings(bits=12, shard_rows=40, l1=1.0)
    hasher, size = toxicity.Hasher(s.bits), 1 << s.bits
    dealt = {r.doc_id: r.k for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("k")).collect()}
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(s.rounds):
        states = []
        for k in range(shards):
            own = sorted((crc32(str(i).encode()), i, y, t) for i, t, y in rows if dealt[i] == k)
            states.append((z.copy(), n.copy()))
            toxicity.ftrl([(np.unique(np.append(hasher.features(hasher.words(t.encode()))[0], size)), y) for _, i, y, t in own], s, *states[-1])
        z, n = np.mean([a for a, _ in states], axis=0), np.mean([b for _, b in states], axis=0)
    assert np.allclose(toxicity.train(df, df.select("doc_id", "toxic"), s), toxicity.weights(z, n, s))


def test_toxicity_without_labels(docs, labels):
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_packing(docs):
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(docs, path).collect()
    exact_ids = Tokenizer.from_file(path)
    want = []
    for i, t in TEXTS:
        ids = np.array(exact_ids.encode(text(t), add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [(i or -1, k, a, b - a, crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048


def test_runs_of_a_plan_do_not_grow_with_the_documents():
    lengths = np.random.default_rng(2).lognormal(5.5, 1.2, 30_000).astype(int).clip(1, 2048)
    base = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    for times in (1, 1000, 10**7):
        sequences = packing.best_plan({k: v * times for k, v in base.items()})
        runs = packing.places(sequences)
        assert sum(len(r[0]) for r in runs.values()) <= 4 * 2048  # what pack broadcasts
        assert sum(n for _, n in sequences) * 2048 <= 1.01 * times * int(lengths.sum()) + 2048


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1200, 20_000)
    h = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    plan = packing.best_plan(h)
    used = {}
    for content, n in plan:
        assert sum(content) <= 2048
        for x in content:
            used[x] = used.get(x, 0) + n
    assert used == h and sum(n for _, n in plan) <= 1.01 * -(-int(lengths.sum()) // 2048) + 1


def test_html():
    page = '<body><nav><a href=x>Menu</a></nav><div class="sidebar"><p>Side, with commas, and words that go on for quite a while.</p></div><div><h2>Title</h2><p>First &amp; long paragraph, with commas, and enough words to be scored.<p>Second&nbsp;one, with\n white   space, and more words to score it.</div><div id="comments"><p>A reader says, loudly, that this is a comment of some length.</p></div><footer>(c)</footer>'
    assert html.main_text(page) == "Title\nFirst & long paragraph, with commas, and enough words to be scored.\nSecond one, with white space, and more words to score it."
    assert html.main_text("") == "" and html.main_text("<p>x") == "x" and html.main_text("<script>a</script>") == ""


@pytest.mark.parametrize("attributes", ['style="overflow:hidden"', 'aria-hidden="false"', 'data-title="hidden gems"', "style='visibility:visible; overflow-x: hidden'"])
def test_html_is_not_hidden_by_a_word(attributes):
    words = "A paragraph, with commas, and enough words to be scored as text."
    assert html.main_text(f"<body {attributes}><div {attributes}><article {attributes}><p>{words}</p></article></div>") == words


@pytest.mark.parametrize("attributes", ["hidden", 'hidden=""', "aria-hidden=true", 'style="color:red; display : none"', "style='VISIBILITY:hidden !important'"])
def test_html_hidden(attributes):
    words = "A paragraph, with commas, and enough words to be scored as text."
    assert html.main_text(f"<body><p>{words}</p><div {attributes}><p>{words} Unseen.</p></div>") == words


@pytest.mark.parametrize("inside", ['<svg viewBox="0 0 1 1"/>', "<svg><path d='M0'/><text>drawn</text></svg>", "<svg><path>", "<noscript>", "<iframe src=x>", "<textarea>", "<template><p>Later</p></template>", "<b/>", "</div></section></b>"])
def test_html_goes_on_behind(inside):
    words = "A paragraph, with commas, and enough words to be scored as text."
    assert html.main_text(f"<body><div><p>{words}</p>{inside}<p>{words} More.</p></div>") == f"{words}\n{words} More."


def test_html_of_great_length_or_depth():
    words = "A paragraph, with commas, and enough words to be scored as text."
    assert html.main_text("<body><div>" + f"<p>{words}</p>" * 100_000 + "</div>").count("\n") == 99_999
    assert html.main_text("<div>" * 50_000 + f"<p>{words}").endswith(words)
    assert html.main_text("<noscript></b><textarea>" * 20_000 + f"<p>{words}").endswith(words)


def test_html_against_the_standard_parser():
    """On the given pages, whose text is one article with paragraphs that may lack their end: the blocks that Python's own parser sees."""
    from html.parser import HTMLParser
    from pathlib import Path

    pages = Path("/root/testdata/sf0.001/pages.parquet")
    if not pages.exists():
        pytest.skip("no pages table")
    import pyarrow.parquet as pq

    class Article(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.blocks = 0, [""]

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            self.blocks += [""] if tag in html.BLOCK else []

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            self.blocks += [""] if tag in html.BLOCK else []

        def handle_data(self, data):
            self.blocks[-1] += data if self.inside else ""

    for h in pq.read_table(pages).column("html").to_pylist():
        parser = Article()
        parser.feed(h.replace("<br>", " "))
        assert html.main_text(h) == "\n".join(" ".join(b.split()) for b in parser.blocks if b.strip())


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>Hello", "t"), (2, None, None, "t"), (2, None, None, "t")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in html.extract(pages).collect()) == [(1, "Hello", 5), (2, "", 0), (2, "", 0)]
    assert html.extract(pages.limit(0)).collect() == []


def test_seeds_and_chains_are_brute_force(monkeypatch):
    rng = np.random.default_rng(11)
    for n in (1, 7, 8, 9, 60, 400):
        x = rng.integers(0, 30, n).astype(np.uint64)
        for window in (1, 2, 5, 8):
            w = min(n, window)
            assert passages.least_places(x, w).tolist() == sorted({i + int(x[i : i + w].argmin()) for i in range(n - w + 1)})
    h = rng.integers(0, 3, 3000).astype(np.uint64)
    for k in (1, 2, 8, 50):
        of = {}
        for i, v in enumerate(passages.run_hashes(h, k).tolist()):
            assert of.setdefault(tuple(h[i : i + k]), v) == v
        assert len(set(of.values())) == len(of)
    s, groups, plain = passages.Settings(), [], 0
    for _ in range(600):
        steps = rng.integers(1, 30, (rng.integers(1, 40), 1)) + rng.integers(0, 3, (1, 2))
        steps[rng.random(len(steps)) < 0.1] += rng.integers(0, 90, 2)
        a = np.cumsum(steps, axis=0)
        groups.append(rng.permutation(np.concatenate([a, a[:: rng.integers(2, 9)] + [0, 5]]) if rng.random() < 0.2 else a))
    told = lambda found: sorted(c.tolist() for c in found)
    quick = [told(passages.chain(g, s)) for g in groups]
    plain = sum(passages._rising(g[np.lexsort((-g[:, 1], g[:, 0]))], s) is not None for g in groups)
    monkeypatch.setattr(passages, "_rising", lambda a, s: None)
    assert quick == [told(passages.chain(g, s)) for g in groups] and 100 < plain < 600


def test_passages(spark):
    common, a, b = prose(70), prose(100), prose(100)
    words = common.split()
    fuzzy = " ".join(words[:30] + ["changed"] + words[31:])
    df = spark.createDataFrame([(1, a + " " + common), (2, common + " " + b), (3, prose(90) + " " + fuzzy + " " + prose(20)), (4, prose(200)), (5, None), (None, common), (6, a[:50])], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.shared_passages(df).collect()}
    assert set(got) == {2, 3} and got[2].partner_id == got[3].partner_id == 1
    assert (got[2].start, got[2].end, got[2].partner_start) == (0, 70, 100) and got[3].end - got[3].start == 70 and got[3].n_equal == 69
    assert passages.shared_passages(df.limit(0)).count() == 0


def test_passages_despite_pieces_in_lower_ids(spark):
    word = lambda: "".join(RNG.choice("abcdefghij") for _ in range(9))
    fresh = lambda n: " ".join(word() for _ in range(n))
    common = [word() for _ in range(60)]
    held = fresh(20) + " " + " ".join(common) + " " + fresh(20)
    rows = [(1, fresh(30) + " " + " ".join(common[:34]) + " " + fresh(30)), (2, fresh(30) + " " + " ".join(common[26:]) + " " + fresh(30)), (100, held), (101, fresh(7) + " " + held), (102, " ".join(common))]
    got = {(r.doc_id, r.partner_id, r.start, r.end) for r in passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {x[:2] for x in got} == {(101, 100), (102, 100)} and (102, 100, 0, 60) in got


def test_passages_of_a_common_seed(spark, monkeypatch):
    """Seeds that count as common are dealt to shares; all holders still hang together, and repeated rows and negative ids do no harm."""
    shared = prose(80)
    rows = [(i - 1, prose(40) + " " + shared + " " + prose(40)) for i in range(200)] + [(-1, None)]
    df = spark.createDataFrame(rows + rows[5:9], "doc_id long, text string")
    for common in (-1, 10**9):
        monkeypatch.setattr(passages, "COMMON", common)
        monkeypatch.setattr(passages, "SAMPLE", 1)
        got = passages.shared_passages(df).collect()
        links = graph.components(spark.createDataFrame([(r.doc_id + 1, r.partner_id + 1) for r in got], "a long, b long"))
        assert {r.root for r in links.collect()} == {0} and links.count() == 199
        # seeds at the passage's edges aren't drawn in all documents, which gives further rows with other partners
        assert {r.doc_id for r in got if r.n_equal >= 80} == set(range(199)) and len(got) < 2 * 199
        assert all(r.n_equal >= 50 for r in got)


def test_edited_passages(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    rows = []
    for i in range(100):
        common = [word() for _ in range(60)]
        edited = list(common)
        for k in rng.sample(range(1, 59), 5):
            edited[k] = word()
        rows += [(2 * i + k, " ".join([word() for _ in range(40)] + own + [word() for _ in range(40)])) for k, own in enumerate((common, edited))]
    got = {r.doc_id for r in passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) >= 75  # window 16 and two seeds find about 58


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(t):
    def holds(kind, v):
        d = [int(c) for c in v if c.isdigit()]
        luhn = sum(x if k % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for k, x in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")), "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]

    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, r in PII.items() for m in re.finditer(r, t) if holds(k, m.group(0)))


def test_pii(spark):
    texts = ["x@y.z_w@q.r a@b.c@d.e 1.2.3.4.5.6.7.8 300.1.1.1 +1 (988) 555-2485, 4111 1111 1111 1111, é😀 a.b@c.d.", "", None, "aaaa@", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "4111-1111-1111-1112 000.1.1.1", "z" * 20_000 + "@x.y", " ".join(["q@w.er"] * 50)]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, h int")
    for r in pii.find(df).collect():
        want = brute_pii(text(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and r.spans.startswith(want)
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[1] == "" and clean[2] is None and clean[6] == "[EMAIL]" and "@b.c" not in clean[0]


def test_pii_terms(spark):
    rows = [(i, f"filler{i} Ask Zorblax Quimby at zq@example.com for item{i} and text") for i in range(20)] + [(100 + i, f"plain text {i} Ask at for and item here") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "Zorblax" not in clean[3] and "Ask" in clean[3] and clean[103] == rows[23][1]


def test_pii_terms_of_copied_texts(spark):
    rows = [(i, f"filler{i % 3} Zorblax at zq@example.com for item{i % 3}") for i in range(300)] + [(1000 + i, f"plain text {i} at for and item here") for i in range(700)]
    clean = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "Zorblax" not in clean[3]


@pytest.mark.parametrize("long", ["7" * 20_000, "7 " * 300_000, "a@b" + ".c-d" * 100_000, " ".join(f"u{i}@w{i}.org" for i in range(30_000)), "1." * 10_000, "+1" + "(" * 100_000 + "2", "+1 (" + "2-" * 10_000])
def test_pii_long_runs(spark, long):
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    got, want = pii.find(df).first(), brute_pii(long)
    assert got.spans == want and got.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert brute_pii(pii.sanitise(df).first().text) == ""


def brute_terms(texts, s):
    """spans of terms by the definition, text by text."""
    values, held = {}, {}
    for t in set(texts):
        held[t] = [(k, m) for k, r in PII.items() for m in re.finditer(r, t) if f"{k}:{m.start()}:{m.end()}" in brute_pii(t).split(",")]
        for k, m in held[t]:
            same = [x for x in re.finditer(PII[k], t)]
            at = [x.start() for x in same].index(m.start())
            left, right = t[same[at - 1].end() if at else 0 : m.start()], t[m.end() : same[at + 1].start() if at + 1 < len(same) else len(t)]
            left = re.sub(r"^\S*", "", left[-s.window :]) if len(left) > s.window else left
            right = re.sub(r"\S*$", "", right[: s.window]) if len(right) > s.window else right
            values.setdefault((k, m.group(0).lower()), {}).setdefault(t, set()).add((left + " " + right).lower())
    n, told = len(set(texts)), {}
    words = {t: set(re.findall(r"[^\W\d_]{3,}", t.lower())) for t in set(texts)}
    for value, by_text in values.items():
        for term in {w for c in by_text.values() for x in c for w in re.findall(r"[^\W\d_]{3,}", x)}:
            own = {t: min(x for x in c if term in re.findall(r"[^\W\d_]{3,}", x)) for t, c in by_text.items() if any(term in re.findall(r"[^\W\d_]{3,}", x) for x in c)}
            d, v = sum(term in w for w in words.values()), len(by_text)
            if len(own) >= s.support and len(set(own.values())) >= s.support and v < n and np.log2(len(own) * n / (d * v)) / np.log2(n / v) >= s.disclosure:
                told.setdefault(value, set()).add(term)
    out = {}
    for t in set(texts):
        terms = set().union(*[told.get((k, m.group(0).lower()), set()) for k, m in held[t]]) if held[t] else set()
        out[t] = [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W\d_]{3,}", t) if m.group(0).lower() in terms]
    return out


def test_pii_terms_are_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for i in range(240):
        own = [rng.choice(VOCABULARY) for _ in range(rng.randint(5, 150))]
        for k in range(rng.randint(0, 2)):
            who = rng.randint(0, 11)
            own[rng.randrange(len(own)) : 0] = [f"Person{'abcdefghijkl'[who]}xx", rng.choice(["said,", "and", VOCABULARY[0]]), f"p{who}@site.org" if who % 2 else f"10.0.0.{who}"]
        texts.append(" ".join(own) + (f" Person{'abcdefghijkl'[i % 12]}xx" if i % 40 == 0 else ""))
    texts += texts[:30]
    s = pii.Settings(window=60)
    want, got = brute_terms(texts, s), pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), s).collect()
    assert sum(map(len, want.values())) > 50
    for r in got:
        assert [x for x in r.spans.split(",") if x.startswith("term")] == want[texts[r.doc_id]]


def test_pieces(docs):
    path = tokenizers.path("piece_bpe_32k.model")
    a, b = (sorted((r.doc_id or -1, r.n_pieces, r.ids_crc32) for r in pieces.round_trip(d, path).collect()) for d in (docs, docs.coalesce(1)))
    assert a == b
    assert all(r.lossless for r in pieces.round_trip(docs, path).collect())
    v = pieces.vocabulary(path)
    word = "▁the".encode()
    draws = pieces._mix(np.arange(50_000, dtype=np.uint64) * pieces.BASE + np.uint64(7))
    flat, n = pieces.Lattice([b"\xe2\x96\x81zz", word], v, 1.0).sample(np.full(50_000, 1), draws)
    ends = np.concatenate(([0], np.cumsum(n)))
    whole = np.mean([flat[ends[k] : ends[k + 1]].tolist() == [v.text.index(word)] for k in range(50_000)])
    ways: dict[int, float] = {0: 0.0}  # log mass by end
    for e in range(1, len(word) + 1):
        terms = [ways[s] + v.weight[i] for s in range(e) for i, t in enumerate(v.text) if t == word[s:e] and v.weight[i] > -np.inf and not (s and v.marked[i])]
        ways[e] = float(np.logaddexp.reduce(terms))
    assert abs(whole - np.exp(v.weight[v.text.index(word)] - ways[len(word)])) < 0.01


def test_licenses(spark):
    texts = ["Licensed under the Apache License, Version 2.0.", "MIT License! the mit\nlicense", "GNU General Public License version 3", "nothing here", None, "", "É mit LICENSEE", "general public license " * 200, "All rights reserved"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text(t).translate(low))
        at = [(k, label) for p, label in licenses.BASE for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at})))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not r.base_labels
    assert got[0].labels == "apache,apache-2.0" and "gpl-3.0" in got[2].labels and got[8].labels == "proprietary" and got[3].score == 0.0
    assert len(licenses.rules()) > 200


def example(pattern, rng):
    """A text that a rule's pattern matches, without the spaces around it."""
    from re import _parser as parser

    def walk(items):
        out = ""
        for op, arg in items:
            op = str(op)
            if op == "LITERAL":
                out += chr(arg)
            elif op == "IN":
                kind, own = arg[0]
                out += {"LITERAL": lambda: chr(own), "RANGE": lambda: chr(own[0]), "CATEGORY": lambda: "1" if str(own).endswith("DIGIT") else "x"}[str(kind)]()
            elif op == "BRANCH":
                out += walk(rng.choice(arg[1]))
            elif op == "SUBPATTERN":
                out += walk(arg[-1])
            elif op == "MAX_REPEAT":
                out += "".join(walk(arg[2]) for _ in range(rng.randint(arg[0], min(int(arg[1]), arg[0] + 1))))
        return out

    return walk(parser.parse(pattern))


def test_licence_gates_pass_every_rule(spark):
    rng, rows = random.Random(2), []
    for _, label, keyword, pattern, _ in licenses.rules():
        for _ in range(3):
            words = ["spdx"] * (keyword == "spdx") + example(pattern, rng).split()
            joined = f" {' '.join(words)} "
            assert re.search(pattern, joined) and re.search(f" (?:{keyword}) ", joined), (pattern, joined)
            rows += [(len(rows), "so " + " ".join(words) + " here"), (len(rows) + 1, "\n".join(words).upper())]
    texts = ["under the terms of the GNU GPL version 3", "GNU GPL v3", "Creative Commons Attribution 4.0 International", "Creative Commons Zero", "zero clause BSD", "released into the public\ndomain", "all rights  reserved", "all rights-reserved"]
    df = spark.createDataFrame(rows + [(100_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [r for r in licenses.scan(df).where("score = 0 or labels = ''").join(df, "doc_id").select("text").collect()] == []


def brute_licences(t):
    """labels, best weight and detections by the definition."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    joined, found, out = f" {' '.join(words)} ", [], []
    for p, label, keyword, pattern, weight in licenses.rules():
        for m in re.finditer(pattern, joined, re.A) if keyword != "spdx" or " spdx " in joined else ():
            start = joined[: m.start()].count(" ") - 1
            found.append((start, -(start + len(m.group(0).split())), p, label, weight))
    # one that lies within another goes (of equal places the later by priority); of the rest, by priority, what overlaps none that is kept stays
    whole = [x for x in found if not any(y is not x and y[0] <= x[0] and y[1] <= x[1] and (y[:2] != x[:2] or y[2] < x[2]) for y in found if y[0] <= x[0])] if len(found) < 3000 else None
    if whole is None:  # the same, for rows of equal notices
        whole, last = [], 0
        for x in sorted(found):
            if -x[1] > last:
                whole.append(x)
            last = max(last, -x[1])
        out = sorted(whole)
        assert all(x[0] >= -y[1] for y, x in zip(out, out[1:]))
    else:
        for x in sorted(whole, key=lambda x: (x[2], x[0])):
            if not any(x[0] < -y[1] and y[0] < -x[1] for y in out):
                out.append(x)
        out.sort()
    base = {label for phrase, label in licenses.BASE if f" {phrase} " in joined}
    return ",".join(sorted({x[3] for x in out} | base)), max([x[4] for x in out] + [0.75 * bool(base)]), [(x[3], x[0], -x[1]) for x in out]


def test_licence_that_overlaps_nothing_kept_stays(spark):
    rows = [[(0, -10, 300, "a", 0.1), (5, -15, 200, "b", 0.1), (12, -20, 100, "c", 0.1), (13, -14, 1, "within", 0.1), (30, -31, 5, "d", 0.1), (30, -31, 4, "e", 0.1)], []]
    df = spark.createDataFrame([(x,) for x in rows], f"found array<{licenses.DETECTION}>")
    assert [[x.label for x in r[0]] for r in df.select(licenses._settle(F.col("found"))).collect()] == [["a", "c", "e"], []]


SHORT_FORMS = {
    "GPLv3": "gpl-3.0", "GPL v3": "gpl-3.0", "GPL-3.0": "gpl-3.0", "GPL-3.0-only": "gpl-3.0", "GPL-3.0-or-later": "gpl-3.0-or-later", "GPLv3 or later": "gpl-3.0-or-later", "GPL version 3": "gpl-3.0", "GNU GPLv3": "gpl-3.0", "GPLv2": "gpl-2.0", "GPL v2": "gpl-2.0",
    "GPLv2+": "gpl-2.0", "GPL-2.0-or-later": "gpl-2.0-or-later", "GPLv2 or any later version": "gpl-2.0-or-later", "GPL": "gpl", "GPL licensed": "gpl", "AGPLv3": "agpl-3.0", "AGPL-3.0": "agpl-3.0", "AGPL-3.0-or-later": "agpl-3.0-or-later", "LGPLv3": "lgpl-3.0",
    "LGPLv2.1": "lgpl-2.1", "LGPLv2.1+": "lgpl-2.1", "LGPL-2.1-or-later": "lgpl-2.1-or-later", "LGPL": "lgpl", "MPL-2.0": "mpl-2.0", "MPL 1.1": "mpl-1.1", "EPL-2.0": "epl-2.0", "EPL 1.0": "epl-1.0", "EUPL-1.2": "eupl", "CDDL-1.0": "cddl-1.0", "CC-BY-4.0": "cc-by-4.0",
    "CC BY 3.0": "cc-by-3.0", "CC-BY-SA-4.0": "cc-by-sa-4.0", "CC-BY-NC-4.0": "cc-by-nc-4.0", "CC BY-NC-SA 4.0": "cc-by-nc-sa-4.0", "CC-BY-ND-4.0": "cc-by-nd-4.0", "CC-BY-NC-ND-4.0": "cc-by-nc-nd-4.0", "CC0": "cc0-1.0", "CC0-1.0": "cc0-1.0", "MIT licensed": "mit",
    "MIT-style licensed": "mit", "Apache 2 license": "apache-2.0", "Apache-2.0": "apache-2.0", "Apache v2": "apache-2.0", "ASL 2.0": "apache-2.0", "BSD-3-Clause": "bsd-3-clause", "3-clause BSD": "bsd-3-clause", "BSD-2-Clause": "bsd-2-clause", "0BSD": "0bsd", "BSD licensed": "bsd",
    "ISC licensed": "isc", "WTFPL": "wtfpl", "SSPL": "sspl-1.0", "BUSL-1.1": "busl-1.1", "OFL-1.1": "ofl-1.1", "GFDL 1.3": "gfdl", "BSL-1.0": "bsl-1.0", "Artistic-2.0": "artistic-2.0", "GNU General Public License v3.0": "gpl,gpl-3.0", "GNU General Public License v2 or later": "gpl,gpl-2.0-or-later",
    "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: (MIT OR Apache-2.0)": "apache-2.0,mit", "SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0-or-later", "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0": "classpath-exception-2.0,gpl-2.0",
    "SPDX-License-Identifier: BSD-3-Clause AND MIT": "bsd-3-clause,mit", "SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception OR MIT": "apache-2.0,llvm-exception,mit", "a free mind": "", "either or": "",
}


def test_licence_short_forms(spark):
    df = spark.createDataFrame([(k, f"It is {t}, as said") for k, t in enumerate(SHORT_FORMS)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(df).collect()}
    assert {t: got[k] for k, t in enumerate(SHORT_FORMS)} == SHORT_FORMS


def test_licences_are_brute_force(spark):
    rng, every = random.Random(6), licenses.rules()
    texts = []
    for i in range(500):
        parts = [example(rng.choice(every)[3], rng) if rng.random() < 0.6 else prose(rng.randint(1, 9)) for _ in range(rng.randint(0, 7))]
        joined = " ".join(parts).split()
        texts.append(rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in joined if rng.random() < 0.97))
    texts += ["mit license " * 20_000, "all rights reserved copyright 2001 " * 5_000]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()}
    assert sum(bool(r.detections) for r in got.values()) > 300
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.labels, r.score, [(x.label, x.start, x.end) for x in r.detections]) == brute_licences(t), t[:300]


def test_empty_tables(docs, labels):
    none = docs.limit(0)
    assert exact.exact_duplicates(none).count() == exact.deduplicate(none).count() == pii.find(none).count() == licenses.scan(none).count() == 0
    assert packing.pack(none, tokenizers.path("byte_bpe_50k.json")).count() == toxicity.toxicity(none, labels).count() == 0


def pipeline_rows():
    """Toxic texts, exact and near copies, personal data, nulls, empty texts, repeated rows and rows without an id."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("klmnopqrstuvw") for _ in range(6))
    rows, base = [], [" ".join(word() for _ in range(rng.randint(30, 120))) for _ in range(60)]
    for i, t in enumerate(base):
        rows.append((i, t))
        w = t.split()
        w[len(w) // 2] = "changed"
        rows.append((1000 + i, [t, t.replace(" ", " \n "), " ".join(w), t + " end"][i % 4]))
    rows += [(2000 + i, " ".join(word() for _ in range(40)) + " vile nasty " + word()) for i in range(60)]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "write to some.one@mail.example.org or +1 (988) 555-2485 " + prose(20)), (3004, prose(9000)), (None, "no id " + prose(30)), (None, "none " + prose(30)), rows[5], rows[5]]
    return rows


def test_pipeline_is_brute_force(spark, tmp_path):
    import corpus_pipeline

    rows = pipeline_rows()
    docs = spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), i, "x", True, 0.5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, h long, group string, kept boolean, score double")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(2000 <= i < 3000)) for i, _ in rows if i is not None] + [(None, None, 1)], "doc_id long, quality int, toxic int").distinct().write.parquet(f"{tmp_path}/labels.parquet")
    stages, folder = [f for _, f in corpus_pipeline.STAGES], str(tmp_path)
    held = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    clean = stages[0](spark, docs, folder).cache()
    assert clean.columns == docs.columns and held(clean) == sorted(((i, t) for i, t in rows if i is None or not 2000 <= i < 3000), key=str)

    groups = {}
    for i, t in held(clean):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text(t)), []).append((i, t))
    want = [min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups.values()]
    single = stages[1](spark, clean, folder).cache()
    assert single.columns == docs.columns and held(single) == sorted(want, key=str)

    shingled = [(i, t, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}) for i, t in want for w in [re.findall(r"[^\x20\x09-\x0D]+", text(t).lower())]]
    root = list(range(len(shingled)))
    for _ in range(3):
        for a, (_, _, x) in enumerate(shingled):
            for b, (_, _, y) in enumerate(shingled):
                if len(x & y) >= 0.8 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    near = {}
    for r, (i, t, _) in zip(root, shingled):
        near.setdefault(r, []).append((i, t))
    want = [min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in near.values()]
    assert len(want) < len(shingled)
    apart = stages[2](spark, single, folder).cache()
    assert apart.columns == docs.columns and held(apart) == sorted(want, key=str)

    hidden = stages[3](spark, apart, folder).cache()
    assert hidden.columns == docs.columns and hidden.count() == len(want)
    texts = {i: t for i, t in held(hidden)}
    assert all(brute_pii(text(t)) == "" for t in texts.values()) and "[EMAIL]" in texts[3003] and "[PHONE]" in texts[3003]
    assert all(texts[i] == t for i, t in want if i is not None and i != 3003)
    assert hidden.where(F.col("n_chars") != F.length("text")).count() == 0

    ids = [_exact_ids(t) for _, t in held(hidden)]
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sum(r.length for r in packed) == sum(ids) and len(packed) == sum(-(-n // 2048) for n in ids)
    assert len({r.sequence_id for r in packed}) == -(-sum(ids) // 2048)


def _exact_ids(t):
    from tokenizers import Tokenizer

    return len(Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json")).encode(text(t), add_special_tokens=False).ids) + 1


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_hands_small_batches_to_python(spark):
    """with Spark's 64 MB a split of documents is one batch, and a worker remembered half a million words."""
    import corpus_pipeline
    import pyarrow as pa

    def sizes(batches):
        for x in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.nbytes])], ["n"])

    docs = spark.range(0, 24, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a word "), 150_000).alias("text"))
    spark.conf.unset(corpus_pipeline.BATCH)
    try:
        for name, stage in corpus_pipeline.STAGES[1:3]:
            stage(spark, docs, "")
            got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
            assert sum(got) >= 24 * 1_050_000 and max(got) < 6_000_000
        spark.conf.set(corpus_pipeline.BATCH, "2m")  # what the user has set holds
        corpus_pipeline.STAGES[1][1](spark, docs, "")
        assert spark.conf.get(corpus_pipeline.BATCH) == "2m"
    finally:
        spark.conf.unset(corpus_pipeline.BATCH)
    hasher, words = toxicity.Hasher(20), [b"".join(bytes([97 + (i // 26**k) % 26]) for k in range(4)) for i in range(150_000)]
    first = hasher.words(b" ".join(words))
    assert len(hasher.known) <= 100_000 and (hasher.words(b" ".join(words[::-1]))[::-1] == first).all()


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, folder)
        assert new.columns == columns and new.count() <= docs.count()
        docs = new.cache()
    assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == docs.count()
