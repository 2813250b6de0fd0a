"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import cut, id_text

#: ASCII signs and digits part words, so "word," and "word***" are the word.
PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
#: Odd multipliers that mix the hashes of a pair of words.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Settings:
    """bits: size of the hash space. max_rows: bound on the labelled rows that training uses (those with the least hash of their id).
    shard_rows: rows that one shard trains on; the states of the shards are averaged after each round, whole and before l1 is applied.
    block: bits of the places whose state is told in one row."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 1.0
    epochs: int = 2
    rounds: int = 2
    block: int = 14
    max_rows: int = 65_536
    shard_rows: int = 8_192


class Hasher:
    """Hash features of texts. Word hashes are remembered in a table of bounded size."""

    def __init__(self, bits: int, limit: int = 100_000):
        self.shift, self.limit, self.known = np.uint64(64 - bits), limit, {}

    def words(self, text: bytes) -> np.ndarray:
        known, found = self.known, []
        for w in text.lower().translate(PLAIN).split():
            h = known.get(w)
            if h is None:
                if len(known) >= self.limit:
                    known.clear()
                h = known[w] = crc32(w)
            found.append(h)
        return np.array(found, np.uint64)

    def features(self, h: np.ndarray, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places of unigrams, bigrams and skip-grams (one word left out), and the text that each belongs to. doc: of each word."""
        doc = np.zeros(len(h), np.int64) if doc is None else doc
        parts, owners = [(h + np.uint64(1)) * MIX_A], [doc]
        for gap, salt in ((1, np.uint64(1)), (2, np.uint64(2))):
            same = doc[gap:] == doc[:-gap]
            parts.append(((h[:-gap] * MIX_A ^ h[gap:] * MIX_B) + salt)[same] * MIX_A)
            owners.append(doc[gap:][same])
        return (np.concatenate(parts) >> self.shift).astype(np.int64), np.concatenate(owners)


def ftrl(examples: list[tuple[np.ndarray, int]], s: Settings, z: np.ndarray, n: np.ndarray) -> None:
    """Passes of FTRL-proximal over (distinct feature places, label); z and n are changed in place."""
    for _ in range(s.epochs):
        for at, y in examples:
            zi, ni = z[at], n[at]
            w = np.where(np.abs(zi) <= s.l1, 0.0, -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2))
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            root = np.sqrt(ni + g * g)
            z[at] = zi + g - (root - np.sqrt(ni)) / s.alpha * w
            n[at] = ni + g * g


def weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> np.ndarray:
    """Weights over the hash space; place 2**bits holds the bias.

    labels: rows (id, label); of repeated ids the largest label counts, null ids and labels don't. Each shard of the rows is passed over
    on its own, whatever task it is in; the states are averaged over the shards that have rows, and the next round goes on from the mean. With
    no labelled row all weights are zero.
    """
    size = 1 << s.bits
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.max_rows)  # its size is bound by max_rows
    known = cut(known, "labelled")
    rows = known.count()
    if not rows:
        return np.zeros(size + 1)
    shards, blocks = -(-rows // s.shard_rows), (size >> s.block) + 1

    texts = id_text(docs, id_col, text_col).join(F.broadcast(known), "doc_id")  # read anew each round, which costs less than a copy of them
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    sc = docs.sparkSession.sparkContext
    for _ in range(s.rounds):
        at = np.nonzero(n)[0]
        start = sc.broadcast((at, z[at], n[at]))  # of bound size

        def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher, held = Hasher(s.bits), {}
            for x in batches:
                for i, y, k, t in zip(x.column("doc_id").to_pylist(), x.column("y").to_pylist(), x.column("shard").to_pylist(), x.column("text")):
                    at = hasher.features(hasher.words(t.as_py()))[0]
                    held.setdefault(k, []).append((i, np.unique(np.append(at, size)).astype(np.int32), y))
            for k in sorted(held):
                examples = sorted(held.pop(k), key=lambda e: (crc32(str(e[0]).encode()), e[0], e[2], len(e[1])))
                own_z, own_n = np.zeros(size + 1), np.zeros(size + 1)
                own_z[start.value[0]], own_n[start.value[0]] = start.value[1:]
                ftrl([(a, y) for _, a, y in examples], s, own_z, own_n)
                yield from told(((b, own_z[b << s.block : b + 1 << s.block], own_n[b << s.block : b + 1 << s.block]) for b in range(blocks)), names)

        def told(states, names: list[str]) -> Iterator[pa.RecordBatch]:
            """A row for each block: z and n of its places; n is 0 where no example has touched one."""
            for b, own_z, own_n in states:
                row = [b, own_z.tobytes(), own_n.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.binary(), pa.binary()))], names)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {}
            for x in batches:
                for b, own_z, own_n in zip(*(c.to_pylist() for c in x.columns)):
                    own_z, own_n = np.frombuffer(own_z), np.frombuffer(own_n)
                    state = sums.setdefault(b, [np.zeros(len(own_z)), np.zeros(len(own_n)), 0])
                    state[0] += own_z
                    state[1] += own_n
                    state[2] += 1  # each shard that has rows tells each block
            yield from told(((b, own_z / k, own_n / k) for b, (own_z, own_n, k) in sums.items()), names)

        names, schema = ["block", "z", "n"], "block int, z binary, n binary"
        dealt = texts.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")).repartitionById(shards, F.col("shard"))
        mean = dealt.mapInArrow(shard, schema).repartition("block").sortWithinPartitions("block", F.xxhash64("z")).mapInArrow(merge, schema).collect()  # 2**bits + 1 places at most
        z[:], n[:] = 0.0, 0.0
        for b, own_z, own_n in mean:
            own_z = np.frombuffer(own_z)
            at = slice(b << s.block, (b << s.block) + len(own_z))
            z[at], n[at] = own_z, np.frombuffer(own_n)
    return weights(z, n, s)


def score(docs: DataFrame, w: np.ndarray, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False) -> DataFrame:
    """doc_id, score for every row; a null text counts as empty and gets the bias alone."""
    place = np.nonzero(w[:-1])[0]
    model = docs.sparkSession.sparkContext.broadcast((place, w[place], float(w[-1])))  # what L1 has left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, value, bias = model.value
        live = np.zeros(1 << s.bits, bool)
        live[at] = True
        hasher = Hasher(s.bits)
        for x in batches:
            hashes = [hasher.words(t) for t in x.column("text").to_pylist()]
            total = np.full(len(hashes), bias)
            first = 0
            while first < len(hashes):  # groups of texts of about a million words
                last, words = first, 0
                while last < len(hashes) and (last == first or words + len(hashes[last]) <= 1_000_000):
                    words += len(hashes[last])
                    last += 1
                owner = np.repeat(np.arange(first, last), [len(h) for h in hashes[first:last]])
                places, owner = hasher.features(np.concatenate(hashes[first:last]), owner)
                hit = np.nonzero(live[places])[0]
                pairs = np.unique(owner[hit] << s.bits | places[hit])
                np.add.at(total, pairs >> s.bits, value[np.searchsorted(at, pairs & (1 << s.bits) - 1)])
                first = last
            out = pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), out, *([x.column("h")] if with_hash else [])], ["doc_id", "score", *["h"] * with_hash])

    return id_text(docs, id_col, text_col, with_hash).mapInArrow(run, "doc_id long, score double" + ", h long" * with_hash)


def held_out(col: str = "doc_id"):
    """The fold that training never sees: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(col).cast("long").cast("string")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row, repeated rows too. A null doc_id is not held out. Empty table: no row."""
    w = train(docs, labels.where(~held_out(id_col)), s, id_col, text_col)
    scored = score(docs, w, s, id_col, text_col)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """`docs` with all its columns, without the rows that the model calls toxic; the verdict is reached where the text lies, without a join.

    A null text counts as empty and gets the bias alone; repeated rows fare alike. Without labelled rows there is no model and
    every row stays. An empty table gives no row.
    """
    w = train(docs, labels.where(~held_out()), s, text_col=text_col)
    if not w.any():
        return docs
    place = np.nonzero(w[:-1])[0]
    model = docs.sparkSession.sparkContext.broadcast((place, w[place], float(w[-1])))

    @F.pandas_udf("boolean")
    def clean(texts):
        import pandas as pd

        at, value, bias = model.value
        hasher, verdict = Hasher(s.bits), []
        for t in texts:
            places = np.unique(hasher.features(hasher.words((t or "").encode()))[0])
            k = np.searchsorted(at, places)
            hit = (k < len(at)) & (at[np.minimum(k, len(at) - 1)] == places) if len(at) else np.zeros(len(places), bool)
            verdict.append(bias + value[k[hit]].sum() < 0)
        return pd.Series(verdict, dtype=bool)

    return docs.where(clean(F.coalesce(F.col(text_col), F.lit(""))))
