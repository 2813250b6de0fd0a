"""Best-fit packing of documents into token sequences, by a linear grouping scheme over the histogram of lengths."""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeforge.llm.common import cut, id_text

_ENCODERS: dict[str, tuple] = {}


def _encoder(path: str):
    """text -> ids, as `tokenizers` with the file at `path` gives them. Where the same vocabulary lies beside it as ranks, these are
    used, which give the same ids faster; texts that name a special token go through `tokenizers`."""
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(path)
        special = [t.content for t in exact.get_added_tokens_decoder().values()]
        fast = None
        ranks_file = path.removesuffix(".json") + ".tiktoken"
        try:
            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        except (ImportError, FileNotFoundError):
            pass

        def encode(text: str) -> np.ndarray:
            if fast is None or any(t in text for t in special):
                return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
            return fast.encode_to_numpy(text, disallowed_special=())

        _ENCODERS[path] = encode
    return _ENCODERS[path]


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and (task, rank): the place among the task's pieces of the same length.

    A document's ids and the end mark; a longer one is cut from its end into pieces of the whole capacity, so only its first is shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, task = _encoder(path), defaultdict(int), TaskContext.get().partitionId()
        for x in batches:
            rows = []
            for who, text in zip(x.column(0).to_pylist(), x.column(1).to_pylist()):
                ids = np.append(encode(text.decode("utf-8", "replace")), end).astype("<u4")
                first = len(ids) % capacity or capacity
                borders = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(borders, borders[1:])):
                    rows.append((who, k, a, b - a, crc32(ids[a:b].tobytes()), task, seen[b - a]))
                    seen[b - a] += 1
            columns = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long")


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Few sizes with counts to [(number of each size, times used)]: each time the fullest set that the stock allows, as often as it does.

    The fullest set is found by dynamic programming over reachable sums; large sizes are preferred on equal sums.
    """
    counts, out = list(counts), []
    while any(counts):
        # fewest of the smaller sizes: sizes come in falling order, and a sum keeps the first way found
        way: dict[int, tuple[int, int, int]] = {0: (-1, 0, 0)}
        for k, size in enumerate(sizes):
            if counts[k]:
                for total in sorted(way):
                    for n in range(1, min(counts[k], (capacity - total) // size) + 1):
                        way.setdefault(total + n * size, (k, n, total))
        at, use = max(way), [0] * len(sizes)
        while at:
            k, n, at = way[at]
            use[k] += n
        times = min(c // u for c, u in zip(counts, use) if u)
        counts = [c - u * times for c, u in zip(counts, use)]
        out.append((use, times))
    return out


def best_plan(histogram: dict[int, int], capacity: int = 2048) -> list[tuple[list[int], int]]:
    """The plan with the fewest sequences over some numbers of groups and bounds of what is small; all on the histogram."""
    tried = [plan(histogram, capacity, groups, small) for groups in (24, 96) for small in (1 / 2, 1 / 3, 1 / 4, 1 / 8)]
    return min(tried, key=lambda p: sum(n for _, n in p))


def plan(histogram: dict[int, int], capacity: int = 2048, groups: int = 24, small: float = 1 / 8) -> list[tuple[list[int], int]]:
    """Lengths and their counts to [(lengths in a sequence, number of such sequences)].

    Lengths above small * capacity are split into groups of equal cardinality and rounded up to their group's largest; the sets of
    few sizes are chosen for these; then the actual lengths take the places, longest first, and small ones go where they fit best.
    All work is on the histogram, so it is bounded by the number of different lengths, not by that of documents.
    """
    out: list[tuple[list[int], int]] = []
    if histogram.get(capacity):
        out.append(([capacity], histogram[capacity]))
    large = sorted((x for x, n in histogram.items() if n and capacity * small < x < capacity), reverse=True)
    total = sum(histogram[x] for x in large)
    members: list[list[tuple[int, int]]] = []  # of each group: (length, count), longest first
    each, room = -(-total // groups) if total else 1, 0
    for x in large:
        n = histogram[x]
        while n:
            if not room:
                members.append([])
                room = each
            take = min(n, room)
            members[-1].append((x, take))
            n, room = n - take, room - take
    sizes = [g[0][0] for g in members]
    stock = [list(g) for g in members]
    bins: list[tuple[tuple[int, ...], int]] = []
    for use, times in _configurations(sizes, [sum(n for _, n in g) for g in members], capacity):
        slots = [k for k, n in enumerate(use) for _ in range(n)]
        while times:  # runs of sequences that get the same lengths
            heads, step = [], times
            need = defaultdict(int)
            for k in slots:
                need[k] += 1
            ok = True
            for k, n in need.items():
                if stock[k][0][1] >= n:
                    step = min(step, stock[k][0][1] // n)
                else:
                    ok = False
            if not ok:
                step = 1
            for k in slots:
                while not stock[k][0][1]:
                    stock[k].pop(0)
                x, n = stock[k][0]
                heads.append(x)
                stock[k][0] = (x, n - (1 if not ok else 0))
            if ok:
                for k, n in need.items():
                    x, m = stock[k][0]
                    stock[k][0] = (x, m - step * n)
            for k in need:
                while stock[k] and not stock[k][0][1]:
                    stock[k].pop(0)
            bins.append((tuple(heads), step))
            times -= step
    free: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for content, n in bins:
        free[capacity - sum(content)].append((content, n))
    spaces = sorted(k for k in free)
    for x in sorted((x for x, n in histogram.items() if n and x <= capacity * small), reverse=True):
        left = histogram[x]
        while left:
            at = bisect_left(spaces, x)
            if at == len(spaces):  # nothing fits: new sequences, filled with this length
                fit = min(capacity // x, left)
                new = max(1, left // fit)
                content, n, gap = (x,) * fit, new, capacity - fit * x
                left -= fit * new
            else:
                gap = spaces[at]
                content, n = free[gap].pop()
                if not free[gap]:
                    del free[gap]
                    spaces.pop(at)
                fit = min(gap // x, left)  # best fit stays best until the gap is used up
                take = min(n, left // fit)
                if take < n:
                    if gap not in free:
                        spaces.insert(bisect_left(spaces, gap), gap)
                    free[gap].append((content, n - take))
                content, n, gap = content + (x,) * fit, take, gap - fit * x
                left -= fit * take
            if gap not in free:
                spaces.insert(bisect_left(spaces, gap), gap)
            free[gap].append((content, n))
    return out + [(list(content), n) for gap in sorted(free) for content, n in free[gap]]


def places(sequences: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of its documents in the order of their rank: first rank, documents a sequence, first sequence, offset."""
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    base = 0
    for content, n in sequences:
        offset, k = 0, 0
        content = sorted(content, reverse=True)
        while k < len(content):
            x = content[k]
            same = content.count(x)
            runs[x].append((used[x], same, base, offset))
            used[x] += same * n
            offset += same * x
            k += same
        base += n
    return {x: tuple(np.array(c, np.int64) for c in zip(*r)) for x, r in runs.items()}


def pack(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every row.

    A null text counts as empty: the end mark alone. Repeated rows are packed as often as they come. An empty table gives no row.
    Only the histogram (at most `capacity` rows) reaches the driver, and the runs broadcast from it are a few for each length, however
    many documents there are; documents of a length are told apart by their rank, which is the sum of the tasks' counts before, so no
    length is gathered in one task. The counts (lengths x tasks rows) grow with the input; they are joined by a shuffle of
    the pieces, in which each partition hashes its share of them.
    """
    rows = cut(pieces(docs, path, capacity, end, id_col, text_col), "pieces")
    counted = cut(rows.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `capacity` rows at most
    where = docs.sparkSession.sparkContext.broadcast(places(best_plan(histogram, capacity)))
    before = counted.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = rows.join(before.select("length", "task", F.coalesce("before", F.lit(0)).alias("before")).hint("shuffle_hash"), ["length", "task"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            length, rank = x.column("length").to_numpy(), x.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for own in np.unique(length):
                mask = length == own
                first, same, base, start = where.value[int(own)]
                k = np.searchsorted(first, rank[mask], side="right") - 1
                into = rank[mask] - first[k]
                sequence[mask], offset[mask] = base[k] + into // same[k], start[k] + into % same[k] * own
            yield pa.RecordBatch.from_arrays([*(x.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    ranked = ranked.select(*names, (F.col("before") + F.col("rank")).alias("rank"))
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
