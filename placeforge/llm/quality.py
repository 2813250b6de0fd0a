"""Quality rules: statistics of a text, and an isolation forest over them with a threshold from labelled rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeforge.llm.common import cut, id_text

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Rates that the forest sees besides; all are free of the text's length but the first.
RATES = ["log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "digit_rate", "mark_rate", "distinct_rate", "words_a_line"]
_UPPER, _DIGIT, _MARK = (bytes(c for c in range(256) if keep(c)) for keep in (lambda c: 65 <= c <= 90, lambda c: 48 <= c <= 57, lambda c: chr(c) in ".,;:!?"))


@dataclass(frozen=True)
class Settings:
    """trees, rows_a_tree, depth: of the forest. Each tree is grown on its own draw of rows_a_tree rows from all labelled rows of good quality."""

    trees: int = 100
    rows_a_tree: int = 256
    depth: int = 12
    seed: int = 7
    fallback: float = 0.65


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The counts of the contract and the rates of one text."""
    words = text.split()
    n = len(words)
    # bytes that don't go on with a code point, without white space
    chars = sum(map(len, words)) if text.isascii() else len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n >= 5:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            count, end = Counter(windows), 0
            for k, x in enumerate(windows):
                if count[x] > 1:
                    repeated += k + 5 - max(k, end)
                    end = k + 5
    size = max(1, len(text))
    rate = lambda marks: (len(text) - len(text.translate(None, marks))) / size
    w = max(1, n)
    rates = [np.log1p(n), chars / w, symbols / max(1, chars), dup / max(1, len(lines)), repeated / w, rate(_UPPER), rate(_DIGIT), rate(_MARK), len(set(words)) / w, n / max(1, len(lines))]
    return [n, chars, symbols, dup, repeated], rates


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts and `rates` for every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            found = [statistics(t) for t in x.column(1).to_pylist()]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            rates = pa.array([r for _, r in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), rates], ["doc_id", *COUNTS, "rates"])

    return id_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, rates array<double>")


class IsolationForest:
    """Trees of random splits; the mean length of a row's path, against that of an unsuccessful search, gives a score up to 1."""

    def __init__(self, samples: list[np.ndarray], box: np.ndarray, s: Settings):
        """samples: the rows of each tree. box: least and largest value of each rate, over good and bad rows. Splits are drawn from it,
        so values that no good row has fall on an empty side and end early."""
        rng = np.random.default_rng(s.seed)
        self.size = len(samples[0])
        self.depth = s.depth
        self.trees = [self._grow(rows, box, rng) for rows in samples]

    @staticmethod
    def _expected(n: np.ndarray | float) -> np.ndarray:
        n = np.maximum(np.asarray(n, float), 1)
        return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))

    def _grow(self, rows: np.ndarray, box: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        """feature, split, left child, right child, path length of leaves; nodes in order of their making."""
        feature, split, left, right, length = [], [], [], [], []
        todo = [(rows, box, 0, None)]
        while todo:
            x, (low, high), depth, parent = todo.pop()
            k = len(feature)
            if parent is not None:
                (left if parent[1] == 0 else right)[parent[0]] = k
            for column, value in ((feature, 0), (split, 0.0), (left, k), (right, k), (length, depth + float(self._expected(len(x))))):
                column.append(value)
            open_ = np.nonzero(high > low)[0]
            if depth < self.depth and len(x) > 1 and len(open_):
                f = int(rng.choice(open_))
                feature[k] = f
                split[k] = float(rng.uniform(low[f], high[f]))
                side = x[:, f] < split[k]
                under, above = high.copy(), low.copy()
                under[f] = above[f] = split[k]
                todo += [(x[side], (low, under), depth + 1, (k, 0)), (x[~side], (above, high), depth + 1, (k, 1))]
        return np.array(feature), np.array(split), np.array(left), np.array(right), np.array(length)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, split, left, right, length in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = np.where(x[every, feature[at]] < split[at], left[at], right[at])
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / max(float(self._expected(self.size)), 1e-9))


def draws(rows: int, s: Settings) -> list[np.ndarray]:
    """For each tree the places of its rows among so many."""
    rng = np.random.default_rng([s.seed, 1])
    return [rng.choice(rows, min(s.rows_a_tree, rows), replace=False) for _ in range(s.trees)]


def threshold(score: np.ndarray, good: np.ndarray, otherwise: float) -> float:
    """The cut with the best mean of the shares of good rows kept and bad rows rejected; `otherwise` without rows of both kinds."""
    if good.all() or not good.any():
        return otherwise
    order = np.argsort(score, kind="stable")
    score, good = score[order], good[order]
    gain = np.cumsum(np.where(good, (~good).sum(), -good.sum()))  # both shares by their common denominator
    last = np.append(score[1:] > score[:-1], True)
    k = int(np.argmax(np.where(last, gain, np.iinfo(np.int64).min)))
    return float(score[k]) if k + 1 == len(score) else float((score[k] + score[k + 1]) / 2)


def fit(rates: np.ndarray, quality: np.ndarray, s: Settings) -> tuple[IsolationForest, float] | None:
    """Forest over the labelled rows of good quality, threshold from all labelled rows; of rows in memory, by id."""
    good = quality > 0
    base = rates[good] if good.any() else rates
    if len(base) < 2:
        return None
    forest = IsolationForest([base[k] for k in draws(len(base), s)], np.array([rates.min(axis=0), rates.max(axis=0)]), s)
    return forest, threshold(forest.score(rates), good, s.fallback)


#: Of `at`: the part of a table, above the place of a row in it.
_PART = "shiftright(at, 33) AS part"


def _in_order(df: DataFrame, label: str, *order: str | Column) -> DataFrame:
    """The table in parts by this order, written; `at` numbers the rows of each part."""
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), label)


def _best_cut(scored: DataFrame, good: int, bad: int) -> float:
    """`threshold` of a table (score, good) with rows of both kinds: running sums within parts of equal scores' counts, then over the parts."""
    counts = scored.groupBy("score").agg(F.sum(F.when(F.col("good"), F.lit(bad).cast("long")).otherwise(F.lit(-good).cast("long"))).alias("gain"))
    counts = _in_order(counts, "scores", "score").selectExpr("*", _PART)
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = counts.select("part", "at", "score", F.sum("gain").over(within).alias("gain"))
    parts = ran.groupBy("part").agg(F.max_by(F.struct("gain", "score"), F.struct("gain", -F.col("at"))).alias("best"), F.max_by("gain", "at").alias("all")).orderBy("part").collect()  # a row for each part
    before, most, score = 0, None, 0.0
    for x in parts:
        if most is None or before + x.best.gain > most:
            most, score = before + x.best.gain, x.best.score
        before += x["all"]
    above = counts.where(F.col("score") > score).agg(F.min("score")).first()[0]
    return score if above is None else (score + above) / 2


def fit_table(labelled: DataFrame, s: Settings) -> tuple[IsolationForest, float] | None:
    """`fit` of a table (doc_id, rates, quality) of any size: every row counts for the box, the draws and the threshold.

    What meets in the driver is a row for each part of the table, and the rows that the trees have drawn.
    """
    spark, width = labelled.sparkSession, range(len(RATES))
    labelled = _in_order(labelled.withColumn("good", F.col("quality") > 0), "labelled", F.desc("good"), "doc_id", "rates")  # good rows first
    rate = lambda k: F.get("rates", F.lit(k))
    parts = labelled.selectExpr("*", _PART).groupBy("part").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.array(*[F.min(rate(k)) for k in width]).alias("low"), F.array(*[F.max(rate(k)) for k in width]).alias("high")).orderBy("part").collect()
    ends = np.cumsum([x.n for x in parts], dtype=np.int64)
    good = sum(x.good for x in parts)
    rows = int(ends[-1]) if parts else 0
    if (good or rows) < 2:
        return None
    firsts = np.array([x.part << 33 for x in parts], np.int64) - np.append(0, ends[:-1])
    drawn = [k + firsts[np.searchsorted(ends, k, side="right")] for k in draws(good or rows, s)]
    wanted = spark.createDataFrame([(int(k),) for k in np.unique(np.concatenate(drawn))], "at long")
    found = dict(labelled.join(F.broadcast(wanted), "at").select("at", "rates").collect())  # trees * rows_a_tree at most
    box = np.array([np.min([x.low for x in parts], axis=0), np.max([x.high for x in parts], axis=0)])
    forest = IsolationForest([np.array([found[k] for k in at.tolist()]) for at in drawn], box, s)
    if good in (0, rows):
        return forest, s.fallback
    shared = spark.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_scores(shared.value, x.column("rates"))), x.column("good")], ["score", "good"])

    return forest, _best_cut(labelled.select("rates", "good").mapInArrow(run, "score double, good boolean"), good, rows - good)


def _scores(forest: IsolationForest, rates: pa.Array) -> np.ndarray:
    flat = np.array(rates.flatten()).reshape(-1, len(RATES))
    return np.concatenate([np.zeros(0), *(forest.score(flat[k : k + 8192]) for k in range(0, len(flat), 8192))])


def quality(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the five counts, base_failed, kept, anomaly (the forest's score) for every row.

    A null text counts as empty and fails the base rules. All labelled rows set the forest and the threshold; labels with a null count for
    nothing, of repeated labels the lowest quality counts, and each row of a repeated id is a labelled row. Without two labelled rows there is
    no forest, and the base rules alone decide. An empty table gives no row.
    """
    rows = cut(profile(docs, id_col, text_col), "profile")
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("quality"))
    model = fit_table(rows.select("doc_id", "rates").hint("merge").join(known, "doc_id"), s)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wanted = [*COUNTS, "base_failed", "kept", "anomaly"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            counts = {c: x.column(c).to_numpy() for c in COUNTS}
            failed = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
            anomaly = np.zeros(x.num_rows)
            kept = ~failed
            if shared.value is not None and x.num_rows:
                forest, most = shared.value
                anomaly = _scores(forest, x.column("rates"))
                kept &= anomaly <= most
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), *(x.column(c) for c in COUNTS), pa.array(failed), pa.array(kept), pa.array(anomaly)], ["doc_id", *wanted])

    return rows.mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean, anomaly double")
