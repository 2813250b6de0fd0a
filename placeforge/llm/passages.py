"""Passages that documents share, edits allowed: seeds of k words are joined, chained in order, and the chains aligned word by word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain as chained

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import cut, groups, id_text, marks, whole_groups

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """k: words of a seed. window: of so many seeds in a row at least one is used, so an equal run of window + k - 1 words is found.
    gap_cost: of a word between chained seeds. max_gap, max_shift: where a chain is cut. margin: words beside a chain that the alignment
    may add. band, drop: of the alignment. min_seeds: of a chain. min_words, identity: of a passage."""

    k: int = 8
    window: int = 8
    gap_cost: float = 0.1
    max_gap: int = 64
    max_shift: int = 16
    margin: int = 40
    band: int = 16
    drop: int = 24
    min_seeds: int = 1
    min_words: int = 50
    identity: float = 0.8


_POWERS = np.ones((2, 1), np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first n powers of MIX and of its inverse modulo 2**64, kept for as many words as a text had."""
    global _POWERS
    if _POWERS.shape[1] < n:
        steps = np.ones((2, 2 * n), np.uint64)
        steps[:, 1:] = np.array([[int(MIX)], [pow(int(MIX), -1, 1 << 64)]], np.uint64)
        _POWERS = np.multiply.accumulate(steps, axis=1)
    return _POWERS[:, :n]


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words: the difference of two prefix sums of a polynomial, so the work doesn't grow with k."""
    power, inverse = _powers(len(h))
    w = (h.astype(np.uint64) + np.uint64(1)) * MIX
    w ^= w >> np.uint64(29)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(w * MIX * power, out=sums[1:])
    x = (sums[k:] - sums[:-k]) * inverse[: len(h) - k + 1]
    x ^= x >> np.uint64(32)
    x *= MIX
    return x ^ x >> np.uint64(29)


#: White space, and a number for each byte, the same for A-Z and a-z.
SPACES = np.zeros(256, bool)
SPACES[[*range(9, 14), 32]] = True
LETTERS = np.array([(b + 32 if 65 <= b <= 90 else b) + 1 for b in range(256)], np.uint64) * MIX
LETTERS = (LETTERS ^ LETTERS >> np.uint64(31)) * MIX
#: Bytes that are looked at in one go.
BLOCK = 1 << 17


def word_hashes(texts: list[bytes]) -> list[bytes]:
    """Each text's words, A-Z lower-cased, as 32-bit hashes one behind the other. A word's hash is that of its run of bytes, from prefix sums."""
    flat = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, firsts, at = [], [], 0
    while at < len(flat):
        end = at + BLOCK
        while end < len(flat) and not SPACES[flat[end - 1]]:  # a word is not cut
            rest = np.nonzero(SPACES[flat[end : end + BLOCK]])[0]
            end += int(rest[0]) + 1 if len(rest) else BLOCK
        b = flat[at:end]
        edges = np.diff(SPACES[b].view(np.int8), prepend=np.int8(1))
        start, stop = np.nonzero(edges == -1)[0], np.nonzero(edges == 1)[0]  # each text ends with a blank
        power, inverse = _powers(len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(LETTERS[b] * power[: len(b)], out=sums[1:])
        x = (sums[stop] - sums[start]) * inverse[start] * MIX
        hashes.append(((x ^ x >> np.uint64(29)) * MIX >> np.uint64(32)).astype(np.uint32))
        firsts.append(start + at)
        at += len(b)
    if not hashes:
        return []
    cuts = np.searchsorted(np.concatenate(firsts), ends) * 4
    every = np.concatenate(hashes).tobytes()
    return [every[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist())]


def least_places(x: np.ndarray, window: int) -> np.ndarray:
    """Places of the first least value of each window, each once; windows double, so a value is met a few times whatever the window."""
    value, at, size = x, np.arange(len(x)), 1
    while size < window:
        step = min(size, window - size)
        later = value[step:] < value[:-step]
        value, at = np.where(later, value[step:], value[:-step]), np.where(later, at[step:], at[:-step])
        size += step
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def seeds(h: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the least seed of each window."""
    n = len(h) - s.k + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    x = run_hashes(h, s.k)
    at = least_places(x, min(n, s.window))
    return x[at].view(np.int64), at


def _rising(a: np.ndarray, s: Settings) -> list[np.ndarray] | None:
    """The chains of anchors sorted by x, where each is best reached from the one before: all rise in both, and each step is either too
    long for a chain or even enough and of less cost than a seed is worth. None where that is not so."""
    dx, dy = np.diff(a[:, 0]), np.diff(a[:, 1])
    apart = (dx > s.max_gap + s.k) | (dy > s.max_gap + s.k)
    if (dx < 1).any() or (dy < 1).any() or not (apart | (np.abs(dx - dy) <= s.max_shift) & (s.gap_cost * (dx + dy) < s.k)).all():
        return None
    return np.split(a, np.nonzero(apart)[0] + 1)


#: Anchors of a column from which columns are taken whole.
COLUMN = 12


def _by_columns(a: np.ndarray, s: Settings) -> tuple[list[float], list[int]]:
    """What the tree in `chain` gives, score and anchor before of each, for all anchors of a column (of one x) at once. Anchors of a column don't
    follow each other, so they need only the columns before: the best chain that ends below is a running maximum over the ranks of y, and the
    near ones lie side by side among the last columns' anchors in the order of their diagonals."""
    x, y, cost, reach = a[:, 0], a[:, 1], s.gap_cost, s.max_gap + s.k
    diagonal, total, rank = x - y, cost * (x + y), np.searchsorted(np.unique(y), y)
    score, back = np.full(len(a), float(s.k)), np.full(len(a), -1)
    best, of = np.full(int(rank.max()) + 2, -1e18), np.full(int(rank.max()) + 2, -1)  # at rank + 1
    starts = np.nonzero(np.diff(x, prepend=x[0] - 1))[0]
    firsts = np.searchsorted(x, x[starts] - reach)
    for lo, hi, first in zip(starts.tolist(), [*starts[1:].tolist(), len(a)], firsts.tolist()):
        own = np.arange(lo, hi)
        top = np.maximum.accumulate(best)
        step = np.cumsum(np.diff(top, prepend=top[0]) > 0) * (len(a) + 1)
        last = np.maximum.accumulate(np.where(best == top, of, -1) + step) - step  # of equal ones the last
        gain, j = top[rank[own]] - total[own], last[rank[own]]
        dx, dy = x[own] - x[j], y[own] - y[j]
        far = np.nonzero((gain > 0) & ((dx > reach) | (dy > reach) | (np.abs(dx - dy) > s.max_shift)))[0]
        if len(far):
            i = own[far]
            gain[far], j[far] = 0.0, -1
            before = first + np.argsort(diagonal[first:lo], kind="stable")
            sides = diagonal[before]
            left, right = np.searchsorted(sides, diagonal[i] - s.max_shift), np.searchsorted(sides, diagonal[i] + s.max_shift, "right")
            some = right > left
            far, i, left, many = far[some], i[some], left[some], (right - left)[some]
            if len(i):
                at = np.cumsum(many) - many
                o = before[np.arange(int(many.sum())) + np.repeat(left - at, many)]
                who = np.repeat(i, many)
                dy = y[who] - y[o]
                value = np.where((dy > 0) & (dy <= reach), score[o] - cost * (x[who] - x[o] + dy), -np.inf)
                most = np.maximum.reduceat(value, at)
                gain[far] = np.maximum(most, 0.0)
                j[far] = np.maximum.reduceat(np.where(value == np.repeat(most, many), o, -1), at)
        on = gain > 0
        score[own[on]], back[own[on]] = s.k + gain[on], j[on]
        entry, at = score[own] + total[own], rank[own] + 1
        better = entry >= best[at]
        best[at[better]], of[at[better]] = entry[better], own[better]
    return score.tolist(), back.tolist()


def _by_tree(a: np.ndarray, s: Settings) -> tuple[list[float], list[int]]:
    """Score of each anchor and the one before it, by a Fenwick tree."""
    x, y = a[:, 0].tolist(), a[:, 1].tolist()
    rank = (np.searchsorted(np.unique(a[:, 1]), a[:, 1]) + 1).tolist()
    size = max(rank)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)
    score, back = [0.0] * len(a), [-1] * len(a)
    cost, reach = s.gap_cost, s.max_gap + s.k
    column, slope = (a[:, 0] // (reach + 1)).tolist(), ((a[:, 0] - a[:, 1]) // (s.max_shift + 1)).tolist()
    cells: dict[tuple[int, int], list[int]] = {}  # anchors before, by column and diagonal; near ones are at most a cell away
    near = lambda i, j: x[i] - x[j] <= reach and y[i] - y[j] <= reach and abs((x[i] - x[j]) - (y[i] - y[j])) <= s.max_shift
    for i in range(len(a)):
        best, r = (-1e18, -1), rank[i] - 1
        while r > 0:
            if tree[r] > best:
                best = tree[r]
            r -= r & -r
        gain = best[0] - cost * (x[i] + y[i])
        j = best[1]
        c, d = column[i], slope[i]
        if gain > 0 and not near(i, j):
            gain, j = 0.0, -1
            for cell in ((c, d), (c, d - 1), (c, d + 1), (c - 1, d), (c - 1, d - 1), (c - 1, d + 1)):
                for o in cells.get(cell, ()):
                    if x[o] < x[i] and y[o] < y[i] and near(i, o):
                        gain, j = max((gain, j), (score[o] - cost * (x[i] - x[o] + y[i] - y[o]), o))
        cells.setdefault((c, d), []).append(i)
        if gain > 0:
            score[i], back[i] = s.k + gain, j
        else:
            score[i] = float(s.k)
        entry, r = (score[i] + cost * (x[i] + y[i]), i), rank[i]
        while r <= size:
            if entry > tree[r]:
                tree[r] = entry
            r += r & -r
    return score, back


def chain(anchors: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Anchors (x, y) to chains that rise in both, best first. A chain's score is its seeds less the cost of the words between.

    Anchors are taken by x; a Fenwick tree over the ranks of y holds the best chain that ends below, each with its gap cost to the origin.
    Where that chain is too far off, the anchors that are near enough are asked one by one, which lie in few cells of columns and diagonals, so
    a place that many others are matched with costs no more than what lies near it. Anchors that simply follow each other need no tree, and where
    columns hold many anchors they are taken whole.
    """
    order = np.lexsort((-anchors[:, 1], anchors[:, 0]))
    a = anchors[order]
    if (plain := _rising(a, s)) is not None:
        return plain
    score, back = (_by_columns if len(a) >= COLUMN * len(np.unique(a[:, 0])) else _by_tree)(a, s)
    used, out = [False] * len(a), []
    for i in sorted(range(len(a)), key=lambda i: -score[i]):
        own = []
        while i >= 0 and not used[i]:
            used[i] = True
            own.append(i)
            i = back[i]
        if own:
            out.append(a[own[::-1]])
    return out


def extend(a: np.ndarray, b: np.ndarray, s: Settings) -> tuple[int, int, int]:
    """How far two word rows agree from their starts, edits allowed: words of a, words of b, equal words.

    Equal runs are passed in one step. Where they end, the least edit of at most `band` words behind which four words agree is taken; it
    ends where edits outweigh what is equal since the best place by `drop`.
    """
    i = j = equal = 0
    score = best = 0
    end = (0, 0, 0)
    while True:
        n = min(len(a) - i, len(b) - j)
        if n > 0:
            differs = a[i : i + n] != b[j : j + n]
            run = int(differs.argmax())
            run = run if differs[run] else n
            i, j, equal, score = i + run, j + run, equal + run, score + run
            if score > best and run:
                best, end = score, (i, j, equal)
        if i >= len(a) or j >= len(b):
            return end
        p, q = a[i : i + s.band + s.k], b[j : j + s.band + s.k]
        run = min(4, len(p), len(q))  # so many words must agree behind an edit
        if min(len(p), len(q)) > 4 and p[1:5].tobytes() == q[1:5].tobytes():  # a word in place of another is the least edit
            i, j, score = i + 1, j + 1, score - 2
        else:
            if run == 4:  # as two pairs of words each
                wide = p.astype(np.uint64), q.astype(np.uint64)
                two = [w[:-1] << np.uint64(32) | w[1:] for w in wide]
                same = two[0][:, None] == two[1][None, :]
                on = same[:-2, :-2] & same[2:, 2:]
            else:
                same = p[:, None] == q[None, :]
                on = same[: len(p) - run + 1, : len(q) - run + 1].copy()
                for r in range(1, run):
                    on &= same[r : len(p) - run + 1 + r, r : len(q) - run + 1 + r]
            di, dj = np.nonzero(on[: s.band + 1, : s.band + 1])
            if not len(di):
                return end
            least = int(np.argmin(np.maximum(di, dj) * 64 + np.abs(di - dj))) if len(di) > 1 else 0
            move = int(di[least]), int(dj[least])
            kept = int(np.count_nonzero(p[: move[0]] == q[: move[1]])) if move[0] == move[1] else 0  # words in place between changes
            i, j, equal, score = i + move[0], j + move[1], equal + kept, score + kept - 2 * (max(move) - kept)
        if score < best - s.drop:
            return end


#: Pairs that are aligned at once, words that are compared at first, and pairs that are so few that each is aligned on its own.
PAIRS, RUN, FEW = 1024, 16, 4


def extend_many(a: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int, s: Settings) -> np.ndarray:
    """What `extend` gives for each pair of word rows in `a`: starts and lengths have a row for each pair and a column for each side, step is -1 for words
    that are read backwards from the start. Pairs go on in step; a stretch of equal words is passed in pieces that grow."""
    reach = s.band + 4
    a = np.concatenate([np.zeros(reach, np.uint32), a, np.zeros(reach, np.uint32)])  # so that edits near the edges may look beyond them
    starts = starts + reach
    offset = np.arange(s.band + 1)
    order = (np.maximum(offset[:, None], offset) * 64 + np.abs(offset[:, None] - offset)) * 4096 + offset[:, None] * 64 + offset  # of equal ones the first
    end, at = np.zeros((len(starts), 3), np.int64), np.zeros((len(starts), 2), np.int64)
    equal, score, best = np.zeros((3, len(starts)), np.int64)
    live = np.arange(len(starts))
    while len(live) > FEW:
        left = (lengths[live] - at[live]).min(axis=1)
        run, more, width = np.zeros(len(live), np.int64), np.nonzero(left > 0)[0], RUN
        while len(more):
            rest = left[more] - run[more]
            place = run[more, None] + np.minimum(np.arange(width), rest[:, None] - 1)
            i, j = (starts[live[more]] + step * at[live[more]]).T
            differs = a[i[:, None] + step * place] != a[j[:, None] + step * place]
            first = differs.argmax(axis=1)
            hit = differs[np.arange(len(more)), first]
            run[more] += np.where(hit, first, np.minimum(rest, width))
            more = more[~hit & (rest > width)]
            width = max(RUN, min(4 * width, (1 << 18) // max(len(more), 1)))
        at[live] += run[:, None]
        equal[live] += run
        score[live] += run
        better = live[(score[live] > best[live]) & (run > 0)]
        best[better] = score[better]
        end[better] = np.column_stack([at[better], equal[better]])
        live = live[(at[live] < lengths[live]).all(axis=1)]
        near = np.minimum(lengths[live] - at[live], s.band + s.k)
        least = near.min(axis=1)
        i, j = (starts[live] + step * at[live]).T
        p, q = (a[x[:, None] + step * np.arange(reach)] for x in (i, j))
        moves, kept = np.ones((len(live), 2), np.int64), np.zeros(len(live), np.int64)
        hard = np.nonzero((least <= 4) | (p[:, 1:5] != q[:, 1:5]).any(axis=1))[0]  # others: a word in place of another is the least edit
        moves[hard] = -1
        for words in range(1, 5):  # so many words must agree behind an edit
            of = hard[np.minimum(least[hard], 4) == words]
            if not len(of):
                continue
            if words == 4:  # as two pairs of words each
                x, y = (w[of, :-1].astype(np.uint64) << np.uint64(32) | w[of, 1:] for w in (p, q))
                same = x[:, :, None] == y[:, None, :]
                on = same[:, :-2, :-2] & same[:, 2:, 2:]
            else:
                same = p[of, :, None] == q[of, None, :]
                on = same[:, : s.band + 1, : s.band + 1].copy()
                for r in range(1, words):
                    on &= same[:, r : s.band + 1 + r, r : s.band + 1 + r]
            who, cell = np.divmod(np.flatnonzero(on), (s.band + 1) ** 2)
            di, dj = np.divmod(cell, s.band + 1)
            fits = (di + words <= near[of[who], 0]) & (dj + words <= near[of[who], 1])
            who, key = who[fits], order[di[fits], dj[fits]]
            if len(who):
                heads = np.nonzero(np.diff(who, prepend=-1))[0]
                key = np.minimum.reduceat(key, heads) % 4096
                moves[of[who[heads]]] = np.column_stack(np.divmod(key, 64))
        straight = hard[(moves[hard, 0] > 0) & (moves[hard, 0] == moves[hard, 1])]
        kept[straight] = ((p[straight, : s.band] == q[straight, : s.band]) & (offset[: s.band] < moves[straight, :1])).sum(axis=1)  # words in place between changes
        ends = moves[:, 0] < 0
        live, moves, kept = live[~ends], moves[~ends], kept[~ends]
        at[live] += moves
        equal[live] += kept
        score[live] += kept - 2 * (moves.max(axis=1) - kept)
        live = live[score[live] >= best[live] - s.drop]
    for k in live.tolist():
        x, y = (a[i : i + n] if step > 0 else a[i - n + 1 : i + 1][::-1] for i, n in zip(starts[k].tolist(), lengths[k].tolist()))
        end[k] = extend(x, y, s)
    return end


def align_many(a: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chains: np.ndarray, s: Settings) -> np.ndarray:
    """Passages (doc_id, start, end, partner_id, partner_start, partner_end, n_equal) along chains (doc_id, partner_id, d0, d1, p0, p1, whole, margin), whose
    sides' words stand in `a`: starts and lengths have a row for each chain and a column for each side."""
    before = np.minimum(chains[:, [2, 4]], chains[:, 7:])  # words before the first seed
    right = extend_many(a, starts + before, lengths - before, 1, s)
    long = (right[:, :2] + before).min(axis=1) >= s.min_words  # else it is too short, whatever lies before
    starts, before, chains, right = starts[long], before[long], chains[long], right[long]
    left = extend_many(a, starts + before - 1, before, -1, s)
    size = chains[:, 3] - chains[:, 2]
    back = (chains[:, 6] > 0) & (right[:, 2] + left[:, 2] < s.identity * (right + left)[:, :2].max(axis=1))  # what lies around an equal run must not lose it
    right[back] = np.column_stack([size, chains[:, 5] - chains[:, 4], size])[back]
    left[back] = 0
    d0, p0, both = chains[:, 2], chains[:, 4], right + left
    span = np.where(back[:, None], size[:, None], both[:, :2])
    good = (span.min(axis=1) >= s.min_words) & (both[:, 2] >= s.identity * span.max(axis=1))
    return np.column_stack([chains[:, 0], d0 - left[:, 0], d0 + right[:, 0], chains[:, 1], p0 - left[:, 1], p0 + right[:, 1], both[:, 2]])[good]


def seeds_of_texts(h: np.ndarray, ends: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, number of the text) of the least seed of each window of texts that lie one behind the other in `h` and end at `ends`."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    count = np.maximum(ends - starts - s.k + 1, 0)
    if not count.any():
        return (np.empty(0, np.int64),) * 3
    x = run_hashes(h, s.k)
    short = np.nonzero((count > 0) & (count < s.window))[0]
    found, of = [starts[i] + np.argmin(x[starts[i] : starts[i] + count[i]]) for i in short], [short]
    full = np.nonzero(count >= s.window)[0]
    if len(full):
        value, at, size = x, np.arange(len(x)), 1
        while size < s.window:
            step = min(size, s.window - size)
            later = value[step:] < value[:-step]
            value, at = np.where(later, value[step:], value[:-step]), np.where(later, at[step:], at[:-step])
            size += step
        windows = count[full] - s.window + 1
        own = np.repeat(full, windows)
        at = at[np.arange(len(own)) + np.repeat(starts[full] - np.cumsum(windows) + windows, windows)]
        new = np.concatenate([[True], at[1:] != at[:-1]])
        found, of = np.concatenate([np.array(found, np.int64), at[new]]), [short, own[new]]
    at, own = np.array(found, np.int64), np.concatenate(of)
    return x[at].view(np.int64), at - starts[own], own


def _word_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and its words, 32-bit hashes one behind the other. Texts are read once; all that follows reads this table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for k in range(0, x.num_rows, 256):
                y = x.slice(k, 256)
                yield pa.RecordBatch.from_arrays([y.column(0), pa.array(word_hashes(y.column(1).to_pylist()), pa.binary())], ["doc_id", "words"])

    return id_text(docs, id_col, text_col).where("doc_id is not null").mapInArrow(run, "doc_id long, words binary")


def _seed_rows(words: DataFrame, s: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for k in range(0, x.num_rows, 64):
                ids, texts = x.column(0).slice(k, 64).to_numpy(zero_copy_only=False), x.column(1).slice(k, 64).to_pylist()
                hashes, places, own = seeds_of_texts(np.frombuffer(b"".join(texts), np.uint32), np.cumsum([len(t) // 4 for t in texts]), s)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (hashes, ids[own], 2 * places + 1)], ["seed", "doc_id", "place"])

    return words.mapInArrow(run, "seed long, doc_id long, place long")


def shared_passages(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, end, partner_id, partner_start, partner_end (words, end exclusive), n_equal, identity.

    Each passage of a document is given with one other document that holds it: the one with the smallest id where its seeds stand (for a
    very common seed the smallest of its share of the documents, and these with the smallest of all); the i-th place of a seed with its
    i-th place there, or the last. Every equal run of min_words words that two documents share lies in a single row of each of them
    (as doc_id or as partner_id): runs of shared seeds that lie in no single passage are matched again as whole runs, with their own
    first holder. An edited passage is found where a seed of it is matched with the document that it is shared with, or a sequence of
    LENGTHS shared seeds in a row or a pair of near ones, for seeds that go to several documents; these, too, go to their own first holder. A row whose sides
    lie in those of longer rows of its pair is left out. Repeats within one document are none. Null texts have no passage; rows without doc_id can't be
    named and are left out; rows that repeat a doc_id count as one document. An empty table gives no row.
    """
    words = cut(_word_rows(docs, id_col, text_col), "words", compression="zstd")
    common = _common_seeds(_seed_rows(_sample(words), s))
    matches = cut(_matches(_seed_rows(words, s), common), "matches")
    found = cut(_aligned(words, _chains(matches, s), s), "passages")
    held = matches.select("seed", "doc_id", F.col("y").alias("at"), F.col("partner_id").alias("head"), F.col("x").alias("head_at"))
    first = matches.select("seed", F.col("partner_id").alias("doc_id"), F.col("x").alias("at")).distinct()
    places = held.unionByName(first.withColumns({"head": F.col("doc_id"), "head_at": F.col("at")}))
    loose = cut(_loose(places, found, s), "loose")
    # a sequence is one row, its place and its size in one number, and leaves as anchors of both ends
    rows = loose.where(F.col("kind") == SEQUENCE).select("seed", "doc_id", ((F.shiftright("lo", 1) * SIZES + F.col("hi")) * 2 + F.col("lo") % 2).alias("place"))
    met = cut(_matches(rows, _common_seeds(_sample(rows))), "sequences")
    x, y = ([F.shiftright(c, SIZES.bit_length() - 1), F.col(c) % SIZES] for c in ("x", "y"))
    ends = F.array(F.struct(x[0].alias("x"), y[0].alias("y")), F.struct((x[0] + x[1]).alias("x"), (y[0] + y[1]).alias("y")))
    chains = _chains(met.select("doc_id", "partner_id", F.inline(ends)), replace(s, margin=SIDES))
    asked = loose.where(F.col("kind") == SEED).select("seed").distinct()
    if asked.isEmpty():
        return _whole(found.unionByName(_aligned(words, chains, s)))
    asked = places.join(asked, "seed", "left_semi").select("doc_id", F.lit(SEED).alias("kind"), F.col("at").alias("lo"), F.col("at").alias("hi"))
    near = loose.where(F.col("kind") < SEED).select("doc_id", "kind", "lo", "hi").unionByName(asked)
    near = near.groupBy(F.col("doc_id").alias("who")).agg(F.collect_set(F.struct("kind", "lo", "hi")).alias("near")).where(F.exists("near", lambda x: x["kind"] == SEED))
    near = cut(near, "near")
    common = _common_seeds(_run_rows(_sample(words), near, s))
    runs = cut(_matches(_run_rows(words, near, s), common), "runs")
    chains = chains.unionByName(_chains(runs, replace(s, k=s.min_words), equal_runs=True))
    return _whole(found.unionByName(_aligned(words, chains, s)))


#: Words of a stretch for each document where several are looked at together.
OWN = 1 << 32

#: Kinds of what is told of a document's places: a stretch of starts of runs that may be shared, one of runs in no single passage, a seed of such a run,
#: and an end of a sequence of shared seeds.
SHARED, OPEN, SEED, SEQUENCE = 0, 1, 2, 3

#: Sizes that a sequence may have in words, a power of two.
SIZES = 1 << 16

#: Shared seeds in a sequence, seeds from the first to the second of a pair, the words that may be changed between two in a row, and the words that
#: are aligned on each side. Near a change other seeds are drawn, so seeds of a pair needn't follow each other.
LENGTHS, APART, CHANGED, SIDES = (3, 5, 8), (1, 2, 3, 4), 12, 200


def sequences(at: np.ndarray, seed: np.ndarray, head: np.ndarray, head_at: np.ndarray, spans: np.ndarray, own: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place as _matches takes it, words to the last seed) of sequences and pairs of a document's shared seeds, which stand at `at`, that were not met as a whole.
    Several documents may be given together, each in its own stretch of OWN words.

    head, head_at: the document that a seed is matched with, and its place there. A sequence that stands in a row in one such document was met with it,
    and one that lies in a single passage of this document (own) has the passage's partner to stand for it. spans: (start, end) of its passages, sorted by
    start; a place is told as sought (odd) if the sequence lies in none.
    """
    step = s.k + s.window - 1 + CHANGED
    rise = np.diff(head_at)
    loose = np.concatenate([[0], np.cumsum(np.diff(at) > step)])
    turns = np.concatenate([[0], np.cumsum((np.diff(head) != 0) | (rise < 1) | (rise > step))])

    def inside(of: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        last = np.searchsorted(of[:, 0], lo, "right") - 1
        return (last >= 0) & (np.maximum.accumulate(of[:, 1])[last] >= hi) if len(of) else np.zeros(len(lo), bool)

    keys, places, sizes = [], [], []
    seed = seed.view(np.uint64)
    for m, pair in [*((m, False) for m in LENGTHS), *((d + 1, True) for d in APART)]:
        i = np.arange(len(at) - m + 1)
        i = i[(loose[i + m - 1] == loose[i]) & (turns[i + m - 1] != turns[i])] if len(i) else i
        i = i[~inside(spans[own], at[i], at[i + m - 1] + s.k)] if len(i) else i
        if len(i):
            key = run_hashes(np.column_stack([seed[i], seed[i + m - 1]]).ravel(), 2)[::2] if pair else run_hashes(seed, m)[i]
            odd = ~inside(spans, at[i], at[i + m - 1] + s.k)
            keys.append(key)
            places.append(2 * at[i] + odd)
            sizes.append(at[i + m - 1] - at[i])
    return (np.concatenate(keys).view(np.int64), np.concatenate(places), np.concatenate(sizes)) if keys else (np.empty(0, np.int64),) * 3


def loose_runs(at: np.ndarray, starts: np.ndarray, ends: np.ndarray, s: Settings) -> tuple[list[tuple[int, int]], list[tuple[int, int]], list[int]]:
    """From places of shared seeds and passages, both sorted, of a document or of several (each in its own stretch of OWN): first and last start of runs of min_words words whose seeds are all
    shared; of those in no single passage; and places of seeds such that each of the latter holds one.

    Among so many seeds in a row as a window has one is drawn, so within a shared run places are at most a window apart.
    """
    shared, open_, picked = [], [], []
    reach = np.maximum.accumulate(ends) if len(ends) else ends
    first = np.concatenate([[0], np.nonzero(np.diff(at) > s.window)[0] + 1])
    last = np.append(first[1:], len(at)) - 1
    long = at[last] + s.k + s.window - 1 - s.min_words >= np.maximum(at[first] - s.window + 1, at[first] // OWN * OWN)
    for c in (at[i : j + 1] for i, j in zip(first[long].tolist(), last[long].tolist())):
        lo, hi = max(int(c[0]) - s.window + 1, int(c[0]) // OWN * OWN), int(c[-1]) + s.k + s.window - 1 - s.min_words
        shared.append((lo, hi))
        y = np.arange(lo, hi + 1)
        last = np.searchsorted(starts, y, "right") - 1
        y = y[(last < 0) | (reach[last] < y + s.min_words)] if len(reach) else y
        for o in np.split(y, np.nonzero(np.diff(y) > 1)[0] + 1) if len(y) else ():
            open_.append((int(o[0]), int(o[-1])))
            first = int(o[0])
            while first <= o[-1]:
                held = int(np.searchsorted(c, first + s.min_words - s.k, "right")) - 1
                if held < 0 or c[held] < first:  # no seed, so the run isn't shared
                    first += 1
                    continue
                picked.append(int(c[held]))
                first = picked[-1] + 1
    return shared, open_, picked


def _loose(places: DataFrame, found: DataFrame, s: Settings) -> DataFrame:
    """doc_id, kind, lo, hi, seed: what loose_runs tells of each document. A document's rows are as many as it has words at most."""
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["doc_id", "at", "kind", "value", "head", "head_at"]
    long = lambda v: F.lit(v).cast("long")
    sides = found.select("doc_id", "start", "end", long(0).alias("kind")).unionByName(found.select(F.col("partner_id").alias("doc_id"), F.col("partner_start").alias("start"), F.col("partner_end").alias("end"), long(-1).alias("kind")))
    spans = sides.groupBy("doc_id", F.col("start").alias("at"), "kind").agg(F.max("end").alias("value")).withColumns({"head": long(0), "head_at": long(0)})
    rows = places.select("doc_id", "at", F.col("seed").alias("value"), long(1).alias("kind"), "head", "head_at").unionByName(spans.select("doc_id", "at", "value", "kind", "head", "head_at"))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in whole_groups(batches, 1):
            own = np.cumsum(np.diff(g[:, 0], prepend=g[0, 0] - 1) != 0) - 1
            who = g[:, 0][np.nonzero(np.diff(own, prepend=-1))[0]]
            at, ends = g[:, 1] + own * OWN, g[:, 3] + own * OWN
            span, held = np.nonzero(g[:, 2] < 1)[0], np.nonzero(g[:, 2] == 1)[0]
            held = held[np.diff(at[held], prepend=-1) != 0]  # of a place's rows the first
            if not len(held):
                continue
            shared, open_, picked = loose_runs(at[held], at[span], ends[span], s)
            v, p, size = sequences(at[held], *g[held, 3:].T.copy(), np.column_stack([at[span], ends[span]]), g[span, 2] == 0, s)
            picked = np.array(picked, np.int64)
            lo = [np.array(c, np.int64).reshape(-1, 2) for c in (shared, open_)]
            lo += [np.column_stack([picked, picked]), np.column_stack([p, size])]
            kind = np.repeat([SHARED, OPEN, SEED, SEQUENCE], [len(c) for c in lo])
            lo = np.concatenate(lo)
            double = np.where(kind == SEQUENCE, 2, 1)  # places as _matches takes them
            told = lo[:, 0] // (double * OWN)
            lo[:, 0] -= told * double * OWN
            lo[:, 1] -= np.where(kind == SEQUENCE, 0, told * OWN)
            seed = np.concatenate([np.zeros(len(shared) + len(open_), np.int64), g[held, 3][np.searchsorted(at[held], picked)], v])
            columns = [pa.array(who[told]), pa.array(kind.astype(np.int32)), pa.array(lo[:, 0]), pa.array(lo[:, 1]), pa.array(seed, mask=kind < SEED)]  # stretches have no seed
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kind", "lo", "hi", "seed"])

    dealt = rows.select(*names).repartition(parts, "doc_id").sortWithinPartitions("doc_id", "at", "kind", "head")
    return dealt.mapInArrow(tell, "doc_id long, kind int, lo long, hi long, seed long")


def outer_rows(g: np.ndarray) -> np.ndarray:
    """Rows (start, end, partner_start, partner_end, ...) of a pair, longest first, without those of which each side lies in that side of a row before."""
    g = np.unique(g, axis=0)
    g = g[np.argsort(g[:, 0] - g[:, 1] + g[:, 2] - g[:, 3], kind="stable")]
    inside = lambda row, of, c: bool(((of[:, c] <= row[c]) & (of[:, c + 1] >= row[c + 1])).any())
    kept = g[:1]
    for row in g[1:]:
        if not (inside(row, kept, 0) and inside(row, kept, 2)):
            kept = np.concatenate([kept, row[None]])
    return kept


def _whole(found: DataFrame) -> DataFrame:
    """The passages without those whose sides lie in longer ones of their pair, and with their identity."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["doc_id", "partner_id", "start", "end", "partner_start", "partner_end", "n_equal"]

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []

        def batch() -> pa.RecordBatch:
            rows = np.concatenate(out) if out else np.empty((0, 7), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(rows[:, c]) for c in range(7)], names)

        for g in groups(batches, 2):
            out.append(g if len(g) == 1 else np.column_stack([np.tile(g[0, :2], (len(o := outer_rows(g[:, 2:])), 1)), o]))
            if len(out) >= 10_000:
                yield batch()
                out = []
        yield batch()

    dealt = found.select(*names).repartition(parts, "doc_id", "partner_id").sortWithinPartitions("doc_id", "partner_id")
    kept = dealt.mapInArrow(outer, ", ".join(f"`{c}` long" for c in names))
    identity = F.col("n_equal") / F.greatest(F.col("end") - F.col("start"), F.col("partner_end") - F.col("partner_start"))
    return kept.select("doc_id", "start", "end", "partner_id", "partner_start", "partner_end", "n_equal", identity.alias("identity"))


#: One document in SAMPLE is looked at to see which seeds are common: those with more than COMMON rows there. Their rows go to SHARES tasks.
#: This decides where rows go, and not what is found.
SAMPLE, COMMON, SHARES = 64, 100, 64


def _sample(words: DataFrame) -> DataFrame:
    return words.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(SAMPLE)) == 0)


def _common_seeds(rows: DataFrame):
    """A test that is true for seeds that are common in the rows of a sample, and may be for few others."""
    return marks(cut(rows.groupBy("seed").count().where(F.col("count") > COMMON).select("seed"), "common"), "seed")


def _matches(rows: DataFrame, common) -> DataFrame:
    """Seeds that several documents hold to (seed, doc_id, partner_id, x, y): the i-th place y of each holder with the i-th or last place x of the
    first holder, and places of the first holder beyond those of all others with the last place of the second holder.

    rows: seed, doc_id, place, which is twice the word's number, and 1 more where the holder's passage is still sought; one of a pair must be such.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.when(common(F.col("seed")), F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)).cast("int")).otherwise(-1)
    schema, names = "seed long, doc_id long, partner_id long, x long, y long", ["seed", "doc_id", "partner_id", "x", "y"]

    def met(b: pa.RecordBatch) -> np.ndarray:
        """A batch without seeds that stand in it once, but for its ends, whose like may be in another batch, and rows of shares."""
        seed, share = (b.column(c).to_numpy(zero_copy_only=False) for c in range(2))
        keep = np.ones(len(seed) + 1, bool)
        keep[1:-1] = seed[1:] == seed[:-1]
        keep = keep[1:] | keep[:-1] | (share >= 0)
        return np.stack([c.to_numpy(zero_copy_only=False)[keep].astype(np.int64) for c in b.columns], axis=1)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by seed, share, document and place. Of a seed's group that isn't over yet, the first holder's rows are held, and those of
        the last one, the most places of a holder before (most) and the last place of the second holder (second)."""
        held, most, second = np.empty((0, 4), np.int64), 0, None
        for b in chained(batches, [None]):
            rows = held if b is None else np.concatenate([held, met(b)])
            if not len(rows):
                continue
            rows = rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])]  # the table may repeat a row
            other = rows[1:] != rows[:-1]
            new = np.concatenate([[True], other[:, :2].any(axis=1)])
            own = np.concatenate([[True], other[:, :3].any(axis=1)])
            heads, starts = np.nonzero(new)[0], np.nonzero(own)[0]
            group, run = np.cumsum(new) - 1, np.cumsum(own) - 1
            ends = np.append(starts[1:], len(rows))
            i, lead = np.arange(len(rows)) - starts[run], run == run[heads][group]
            first = heads[group]
            n_first = (ends - starts)[run[heads]]
            over, done = (group < group[-1], run < run[-1]) if b is not None else (np.ones(len(rows), bool),) * 2
            # the most places of a holder but the first, and the second holder
            longest, holds = np.zeros(len(heads), np.int64), ~lead[starts]
            np.maximum.at(longest, group[starts][holds], (ends - starts)[holds])
            at = np.minimum(run[heads] + 1, len(starts) - 1)
            has = (group[starts[at]] == np.arange(len(heads))) & (at > run[heads])
            behind = rows[ends[at] - 1][:, 2:]
            if second is not None:
                longest[0], has[0], behind[0] = max(longest[0], most), True, second
            odd = (rows[:, 3] & 1).astype(bool)
            x = first + np.minimum(i, n_first[group] - 1)
            pair = ~lead & done & (odd | odd[x])
            extra = lead & over & has[group] & (i >= longest[group]) & odd
            alone = lead & over & (rows[:, 1] >= 0)
            told = np.concatenate([
                np.column_stack([rows[pair, 0], rows[pair, 2], rows[first[pair], 2], rows[x[pair], 3] >> 1, rows[pair, 3] >> 1]),
                np.column_stack([rows[extra, 0], behind[group[extra], 0], rows[extra, 2], rows[extra, 3] >> 1, behind[group[extra], 1] >> 1]),
                np.column_stack([rows[alone, 0], rows[alone, 2], rows[alone, 2], rows[alone, 3], rows[alone, 3]]),  # first rows of shares keep their place as it is
            ])
            none = np.arange(len(told)) >= pair.sum() + extra.sum()
            yield pa.RecordBatch.from_arrays([pa.array(told[:, c], mask=none if c == 2 else None) for c in range(5)], names)
            last = group == group[-1]
            held = rows[last & (lead | (run == run[-1]))]
            if lead[-1]:
                most, second = 0, None
            else:
                most = int(longest[-1])
                second = behind[-1] if has[-1] and (run[-1] > at[-1] or second is not None and len(heads) == 1) else None

    def walked(df: DataFrame) -> DataFrame:
        dealt = df.select("seed", "share", "doc_id", "place").repartition(parts, "seed", "share").sortWithinPartitions("seed", "share", "doc_id", "place")
        return dealt.mapInArrow(walk, schema)

    once = cut(walked(rows.withColumn("share", share)), "walked")
    heads = once.where("partner_id is null").select("seed", F.lit(-1).alias("share"), "doc_id", F.col("y").alias("place"))
    return once.where("partner_id is not null").unionByName(walked(heads)).select(*names)


def _run_rows(words: DataFrame, near: DataFrame, s: Settings) -> DataFrame:
    """Hashes of runs of min_words words that may be shared and hold one of the given seeds, and whether they lie in no single passage. near: (who, near)."""

    def within(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, np.clip(lo, 0, n), 1)
        np.add.at(edges, np.clip(hi + 1, 0, n), -1)
        return np.cumsum(edges)[:n] > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = replace(s, k=s.min_words, window=1)
        for x in batches:
            for k in range(0, x.num_rows, 256):
                y = x.slice(k, 256)
                ids, hashes, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                told = y.column(2).flatten()
                kind, lo, hi = (told.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3))
                ends = np.cumsum(y.column(2).value_lengths().to_numpy(zero_copy_only=False))
                for who, text, start, end in zip(y.column(0).to_pylist(), y.column(1).to_pylist(), [0, *ends], ends):
                    h, at = seeds(np.frombuffer(text, np.uint32), whole)
                    of = [start + np.nonzero(kind[start:end] == c)[0] for c in (SHARED, OPEN, SEED)]
                    keep = within(len(h), lo[of[SHARED]], hi[of[SHARED]]) & within(len(h), lo[of[SEED]] + s.k - s.min_words, hi[of[SEED]])
                    ids.append(np.full(keep.sum(), who, np.int64))
                    hashes.append(h[keep])
                    places.append((2 * at + within(len(h), lo[of[OPEN]], hi[of[OPEN]]))[keep])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (hashes, ids, places)], ["seed", "doc_id", "place"])

    return words.join(near, F.col("doc_id") == F.col("who")).select("doc_id", "words", "near").mapInArrow(run, "seed long, doc_id long, place long")


def equal_stretches(g: np.ndarray, k: int) -> np.ndarray:
    """Anchors (doc_id, partner_id, x, y) of runs of k words to stretches (doc_id, partner_id, y0, y1, x0, x1) of runs that follow each other."""
    g = g[np.lexsort((g[:, 2], g[:, 2] - g[:, 3], g[:, 1], g[:, 0]))]
    new = np.concatenate([[True], (np.diff(g, axis=0) != (0, 0, 1, 1)).any(axis=1)])
    return ends_of(g, new, k)


def ends_of(g: np.ndarray, new: np.ndarray, k: int) -> np.ndarray:
    """Anchors (doc_id, partner_id, x, y) of chains, which begin where `new` is true, to chains (doc_id, partner_id, y0, y1, x0, x1)."""
    lo = np.nonzero(new)[0]
    a, b = g[lo], g[np.append(lo[1:], len(g)) - 1]
    return np.column_stack([a[:, :2], a[:, 3], b[:, 3] + k, a[:, 2], b[:, 2] + k])


def chains_of_pairs(g: np.ndarray, s: Settings) -> np.ndarray:
    """Anchors (doc_id, partner_id, x, y) of whole pairs, sorted, each once, to chains (doc_id, partner_id, y0, y1, x0, x1). Pairs whose anchors simply follow
    each other, by the test of _rising, are done together."""
    d = np.diff(g, axis=0)
    pair = np.concatenate([[True], (d[:, :2] != 0).any(axis=1)])
    dx, dy = d[:, 2], d[:, 3]
    apart = (dx > s.max_gap + s.k) | (dy > s.max_gap + s.k)
    plain = (dx > 0) & (dy > 0) & (apart | (np.abs(dx - dy) <= s.max_shift) & (s.gap_cost * (dx + dy) < s.k))
    own = np.cumsum(pair) - 1
    mixed = np.zeros(int(own[-1]) + 1, bool)
    mixed[own[1:][~plain & ~pair[1:]]] = True
    rest = mixed[own]
    new = pair | np.concatenate([[True], apart])
    out = []
    if not rest.all():
        chains, first = ends_of(g[~rest], new[~rest], s.k), np.nonzero(new[~rest])[0]
        out.append(chains[np.diff(np.append(first, (~rest).sum())) >= s.min_seeds])
    for x in np.split(g[rest], np.nonzero(pair[rest])[0][1:]) if rest.any() else ():
        of = [(*x[0, :2], c[0, 1], c[-1, 1] + s.k, c[0, 0], c[-1, 0] + s.k) for c in chain(x[:, 2:], s) if len(c) >= s.min_seeds]
        out.append(np.array(of, np.int64).reshape(-1, 6))
    return np.concatenate(out)


def _chains(matches: DataFrame, s: Settings, equal_runs: bool = False) -> DataFrame:
    """Chains (or stretches of equal runs) of matches: doc_id, partner_id, d0, d1, p0, p1 (words), whole: whether all in it is equal, and the margin."""
    parts = int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matches = matches.select("doc_id", "partner_id", "x", "y").repartition(parts, "doc_id", "partner_id").sortWithinPartitions("doc_id", "partner_id", "x", "y")

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in whole_groups(batches, 2):
            g = g[np.concatenate([[True], (g[1:] != g[:-1]).any(axis=1)])]  # several sequences may begin or end at a place
            out = equal_stretches(g, s.k) if equal_runs else chains_of_pairs(g, s)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, c]) for c in range(6)], ENDS)

    return matches.mapInArrow(chains, ", ".join(f"{c} long" for c in ENDS)).withColumns({"whole": F.lit(equal_runs), "margin": F.lit(s.margin)})


#: A chain's documents and where it begins and ends in them.
ENDS = ["doc_id", "partner_id", "d0", "d1", "p0", "p1"]


def _aligned(words: DataFrame, chains: DataFrame, s: Settings) -> DataFrame:
    """Passages along chains."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [*ENDS, "whole", "margin"]
    found = cut(chains, "chains").withColumn("chain", F.struct(*names))
    asked = found.select(F.col("doc_id").alias("who"), "chain", F.lit(0).alias("side"), F.col("d0").alias("lo"), F.col("d1").alias("hi")).unionByName(found.select(F.col("partner_id").alias("who"), "chain", F.lit(1).alias("side"), F.col("p0").alias("lo"), F.col("p1").alias("hi")))
    # each side's words around the chain, of 4 bytes each; a text that many chains ask for is not gathered, but streamed by the join
    first = F.greatest(F.col("lo") - F.col("chain.margin"), F.lit(0)).cast("int")
    own = F.col("words").substr(first * 4 + 1, (F.col("hi").cast("int") + F.col("chain.margin") - first) * 4)
    cuts = asked.join(words.withColumnRenamed("doc_id", "who"), "who").select("chain.*", "side", own.alias("words"))
    pairs = cuts.repartition(parts, *names).sortWithinPartitions(*names, "side")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by chain and side; the last first side is held, as its second may be in the next batch."""
        held = None
        for x in batches:
            if not x.num_rows:
                continue
            x = x if held is None else pa.concat_batches([held, x])
            keys = np.stack([x.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1)
            side = x.column("side").to_numpy()
            first = np.maximum.accumulate(np.where(side == 0, np.arange(len(side)), -1))
            two = np.nonzero((side == 1) & (first >= 0))[0]
            two = two[(keys[two] == keys[first[two]]).all(axis=1)]
            one = first[two]
            own = x.column("words").cast(pa.binary())
            bytes_at = np.frombuffer(own.buffers()[1], np.int32)[own.offset : own.offset + len(own) + 1].astype(np.int64)
            all_words = np.frombuffer(own.buffers()[2], np.uint8)[bytes_at[0] : bytes_at[-1]].view(np.uint32) if bytes_at[-1] > bytes_at[0] else np.empty(0, np.uint32)
            edges = (bytes_at - bytes_at[0]) // 4
            out = [np.empty((0, 7), np.int64)]
            for k in range(0, len(one), PAIRS):
                rows = np.column_stack([one[k : k + PAIRS], two[k : k + PAIRS]])
                lo, hi = edges[rows.min()], edges[rows.max() + 1]
                out.append(align_many(all_words[lo:hi], edges[rows] - lo, edges[rows + 1] - edges[rows], keys[rows[:, 0]], s))
            told = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(told[:, c]) for c in range(7)], given)
            held = x.slice(int(first[-1]), 1) if first[-1] >= 0 else None

    given = ["doc_id", "start", "end", "partner_id", "partner_start", "partner_end", "n_equal"]
    return pairs.mapInArrow(align, ", ".join(f"`{c}` long" for c in given))
