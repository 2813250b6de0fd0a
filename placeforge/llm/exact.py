"""Exact deduplication over an index of cuckoo filters whose hits are verified against the stored keys."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import cut, drop_rows, id_text


def digest(text: bytes) -> bytes:
    """SHA-256 of the text with every run of white space replaced by one space."""
    inner = text.split()
    body = b" ".join(inner)
    if not inner:
        body = b" " if text else b""
    else:
        body = b" " * (text[:1].isspace()) + body + b" " * (text[-1:].isspace())
    return hashlib.sha256(body).digest()


class CuckooIndex:
    """Live digests with a value each. Four 16-bit tags to a bucket; beside every tag lies its key, so a hit is verified in place.

    Partial-key cuckoo hashing: the second bucket follows from the first and the tag, so a key can be moved or deleted without
    the others. When an insertion finds no place in MAX_KICKS moves, the table doubles and is filled again from the stored keys.
    """

    SLOTS, MAX_KICKS = 4, 200

    def __init__(self, expected: int = 64):
        self.resizes = 0
        self._clear(1 << max(2, (int(expected / (self.SLOTS * 0.85)) + 1).bit_length()))

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags = [0] * (buckets * self.SLOTS)
        self.keys: list[bytes | None] = [None] * (buckets * self.SLOTS)
        self.values: list[list | None] = [None] * (buckets * self.SLOTS)
        self.size = 0

    def _place(self, key: bytes) -> tuple[int, int, int]:
        x = int.from_bytes(key[-8:], "little")
        tag = x >> 48 or 1
        one = x & self.mask
        return tag, one, self._other(one, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return (bucket ^ (tag * 0x5BD1E995)) & self.mask

    def _find(self, key: bytes) -> int:
        tag, one, two = self._place(key)
        for at in (one, two):
            base = at * self.SLOTS
            for k in range(base, base + self.SLOTS):
                if self.tags[k] == tag and self.keys[k] == key:  # the filter's hit, then the stored content
                    return k
        return -1

    def get(self, key: bytes) -> list | None:
        at = self._find(key)
        return None if at < 0 else self.values[at]

    def insert(self, key: bytes, value: list) -> None:
        """A new key; use get() first where it may be there."""
        tag, one, two = self._place(key)
        for at in (one, two):
            base = at * self.SLOTS
            for k in range(base, base + self.SLOTS):
                if self.tags[k] == 0:
                    self.tags[k], self.keys[k], self.values[k] = tag, key, value
                    self.size += 1
                    return
        at = two
        for kick in range(self.MAX_KICKS):
            k = at * self.SLOTS + (kick * 7 + tag) % self.SLOTS
            old = self.tags[k], self.keys[k], self.values[k]
            self.tags[k], self.keys[k], self.values[k] = tag, key, value
            tag, key, value = old
            at = self._other(at, tag)
            base = at * self.SLOTS
            for k in range(base, base + self.SLOTS):
                if self.tags[k] == 0:
                    self.tags[k], self.keys[k], self.values[k] = tag, key, value
                    self.size += 1
                    return
        kept = [*self.items(), (key, value)]
        self.resizes += 1
        self._clear((self.mask + 1) * 2)
        for key, value in kept:
            self.insert(key, value)

    def delete(self, key: bytes) -> bool:
        at = self._find(key)
        if at < 0:
            return False
        self.tags[at], self.keys[at], self.values[at] = 0, None, None
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, list]]:
        return ((k, v) for k, v in zip(self.keys, self.values) if k is not None)


def _less(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


ROWS = "digest binary, keep_id long, group_size long"
_ROWS = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, keep_id, group_size) to one for each digest: the least id and the sum of sizes."""
    index = CuckooIndex()
    for x in batches:
        for key, who, size in zip(*(c.to_pylist() for c in x.columns)):
            have = index.get(key)
            if have is None:
                index.insert(key, [who, size])
            else:
                have[0] = _less(have[0], who)
                have[1] += size
    rows = list(index.items())
    for k in range(0, len(rows), 10_000):
        part = rows[k : k + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.binary()), pa.array([r[1][0] for r in part], pa.int64()), pa.array([r[1][1] for r in part], pa.int64())], schema=_ROWS)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False) -> DataFrame:
    """doc_id, digest (and h, a hash of the raw text); one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            found = pa.array([digest(t) for t in x.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), found, *([x.column("h")] if with_hash else [])], ["doc_id", "digest", *["h"] * with_hash])

    return id_text(docs, id_col, text_col, with_hash).mapInArrow(run, "doc_id long, digest binary" + ", h long" * with_hash)


def _shards(df: DataFrame, rows: int) -> int:
    """Shards of at most about 200,000 keys, so that an index stays small."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // 200_000 + 1)


def build_index(rows: DataFrame, n: int | None = None) -> DataFrame:
    """Rows (doc_id, digest) to the index (digest, keep_id, group_size), one row for each live digest.

    A first round of filters merges what each input partition holds, so of a text with very many copies only one row leaves a task;
    the second merges each shard of the digests.
    """
    local = rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")).mapInArrow(_merge, ROWS)
    return local.repartition(_shards(rows, rows.count() if n is None else n), "digest").mapInArrow(_merge, ROWS)


def insert(index: DataFrame, rows: DataFrame) -> DataFrame:
    """The index after rows (doc_id, digest) came in; the smallest doc_id stays the one that is kept."""
    new = rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")).mapInArrow(_merge, ROWS)
    return index.unionByName(new).repartition(_shards(index, index.count()), "digest").mapInArrow(_merge, ROWS)


def delete(index: DataFrame, gone: DataFrame, remaining: DataFrame) -> DataFrame:
    """The index after rows `gone` (doc_id, digest) went; a digest with no row left is deleted from the filter of its shard.

    remaining: the rows that are still there; where the kept row went, the smallest of these takes its place.
    """
    less = gone.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), (-F.count("*")).alias("group_size"))
    heirs = remaining.join(less.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.min("doc_id").alias("heir"))
    side = less.join(heirs, "digest", "left").select("digest", F.col("heir").alias("keep_id"), "group_size", F.lit(True).alias("going"))
    both = index.withColumn("going", F.lit(False)).unionByName(side).repartition(_shards(index, index.count()), "digest").sortWithinPartitions("going")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = CuckooIndex()
        for x in batches:
            for key, who, size, going in x.itertuples(index=False):
                key, who = bytes(key), None if pd.isna(who) else int(who)
                if not going:
                    shard.insert(key, [who, size])
                elif (have := shard.get(key)) is not None:
                    have[0], have[1] = who, have[1] + size
                    if have[1] <= 0:
                        shard.delete(key)
        rows = [(k, v[0], v[1]) for k, v in shard.items()]
        yield pd.DataFrame({"digest": [r[0] for r in rows], "keep_id": pd.array([r[1] for r in rows], "Int64"), "group_size": [r[2] for r in rows]})

    return both.mapInPandas(run, ROWS)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Null texts count as empty. Of rows that also share the doc_id, all that have the kept doc_id carry kept = true; `deduplicate` then keeps one
    of them. A row without doc_id is kept only if its group has no doc_id at all. An empty table gives no row.
    """
    rows = cut(digests(docs, id_col, text_col), "digests")
    index = build_index(rows)
    return rows.join(index, "digest").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with all its columns, one row for each text: the one with the smallest doc_id.

    Null texts count as empty. Equal texts that share this doc_id, too, leave one row, the first as JSON. An empty table gives no row.
    Rows that go are named by doc_id and a hash of the raw text.
    """
    rows = cut(digests(docs, id_col, text_col, with_hash=True), "digests")
    many = build_index(rows).where("group_size > 1").select("digest", "keep_id")
    named = cut(rows.join(many, "digest").select("doc_id", "h", F.col("digest").alias("group"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")), "named")
    return drop_rows(docs, named, id_col, text_col)
