"""Sampled segmentation over a SentencePiece vocabulary: forward filtering and backward sampling on the piece lattice, and lossless decoding."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import id_text

BLANK = "▁".encode()
BASE = np.uint64(0x9E3779B97F4A7C15)
STEPS = np.arange(4096, dtype=np.uint64) * BASE
#: Words that are drawn together, bytes of texts that are split together, and words whose lattices are built together.
WORDS, BYTES, BLOCK = 200_000, 1 << 24, 4096
#: Words that keep their lattices in a worker.
KEPT = 50_000
_VOCABULARIES: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pieces as bytes with a log weight each. Byte pieces make every text possible; they weigh less than any other piece.

    A BPE model's score is minus the rank of a merge; Zipf's law over ranks makes it a weight, a unigram model's score is one already.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        kind = [2 if model.is_byte(i) else 0 if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else 1 for i in range(n)]
        self.text = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if k == 2 else model.id_to_piece(i).encode() if k else b"" for i, k in enumerate(kind)]
        # a mark of a blank stands only at a word's start; marks elsewhere in a text go by bytes
        plain = [i for i, k in enumerate(kind) if k == 1 and BLANK not in self.text[i][1:]]
        scores = np.array([model.get_score(i) for i in range(n)])
        bpe = all(s == round(s) for s in scores[plain])
        self.weight = np.full(n, -np.inf)
        self.weight[plain] = -np.log(2 - scores[plain]) if bpe else scores[plain]
        self.byte = np.zeros(256, np.int32)
        for i, k in enumerate(kind):
            if k == 2:
                self.byte[self.text[i][0]] = i
                self.weight[i] = self.weight[plain].min() - 10
        prefix: dict[int, int] = {}  # hash of each piece and of what pieces start with: the piece or -1
        for i in plain:
            h = 0
            for k, c in enumerate(self.text[i]):
                h = (h + c + 1) * int(BASE) % (1 << 64)
                prefix.setdefault(h, -1)
            prefix[h] = i
        self.hash = np.array(sorted(prefix), np.uint64)
        self.piece = np.array([prefix[h] for h in self.hash.tolist()], np.int32)
        top = (self.hash >> np.uint64(44)).astype(np.int64)  # hashes with the same first 20 bits lie together
        self.start = np.searchsorted(top, np.arange((1 << 20) + 1)).astype(np.int32)
        self.widest = int(np.bincount(top).max(initial=1))
        self.hash = np.append(self.hash, np.uint64(0))
        self.marked = np.array([t.startswith(BLANK) and k == 1 for t, k in zip(self.text, kind)])
        shown = [b" " + t[3:] if m else t for t, m in zip(self.text, self.marked)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_size = np.array([len(t) for t in shown])
        self.shown_at = np.concatenate(([0], np.cumsum(self.shown_size)[:-1]))
        self.common: dict[float, tuple[dict[bytes, int], Lattice | None]] = {}

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in h of strings that pieces start with, and the piece each is, -1 for none."""
        top = (h >> np.uint64(44)).astype(np.int64)
        k, stop = self.start[top], self.start[top + 1]
        maybe = np.nonzero(k < stop)[0]
        k, stop, h = k[maybe], stop[maybe], h[maybe]
        for _ in range(self.widest - 1):
            k += (self.hash[k] < h) & (k + 1 < stop)
        sure = self.hash[k] == h
        return maybe[sure], self.piece[k[sure]]


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


class Lattice:
    """The filtered lattices of some words, side by side: a node for each border between bytes, an edge for each piece that fits.

    Edges lie in groups by the node in which they end; a group's shares add up to one more than its number, so a draw u picks an edge
    by one search for (group + u).
    """

    def __init__(self, words: list[bytes], v: Vocabulary, alpha: float):
        size = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        nodes, longest = len(text) + len(words), int(size.max())
        number = np.int32 if nodes < 1 << 31 else np.int64
        owner = np.repeat(np.arange(len(words), dtype=number), size)
        at = np.arange(len(text), dtype=number)
        self.first = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
        self.last = self.first + size
        stop = np.cumsum(size)
        end_of = stop.astype(number)[owner]
        depth_at = at - (stop - size).astype(number)[owner]  # bytes of the word before each byte
        inner_mark = (text == BLANK[0]) & (depth_at > 0)
        places, lengths, ids = [at], [np.zeros(len(at), number)], [v.byte[text]]  # length 0: a byte piece
        active, h, left = at, np.zeros(len(at), np.uint64), end_of - at
        for length in range(1, longest + 1):
            if length > 1:
                inside = left[active] >= length
                active, h = active[inside], h[inside]
            if not len(active):
                break
            h = (h + text[active + (length - 1)] + np.uint64(1)) * BASE
            hit, piece = v.find(h)
            active, h = active[hit], h[hit]
            whole = np.nonzero(piece >= 0)[0]
            whole = whole[~(inner_mark[active[whole]] & v.marked[piece[whole]])]
            places.append(active[whole])
            lengths.append(np.full(len(whole), length, number))
            ids.append(piece[whole])
        place, length, piece = np.concatenate(places), np.concatenate(lengths), np.concatenate(ids)
        span = np.maximum(length, 1)
        depth = depth_at[place] + span
        start = place + owner[place]
        end = start + span
        wide = np.int32 if (longest + 1) * nodes < 1 << 24 else np.int64
        order = np.argsort(((depth.astype(wide) * nodes + end) << 7) + np.minimum(length, 127))  # no two are the same
        start, end, piece, depth = start[order], end[order], piece[order], depth[order]
        weight = alpha * v.weight[piece]
        new = np.append(True, end[1:] != end[:-1])
        group_at = np.nonzero(new)[0]
        group = np.cumsum(new) - 1
        mass = np.zeros(nodes)
        share = np.empty(len(end))
        borders = np.searchsorted(depth, np.arange(1, int(depth[-1]) + 2))
        for a, b in zip(borders, borders[1:]):  # a byte further in all words at once
            g = group_at[group[a] : group[b - 1] + 1] - a
            x = mass[start[a:b]] + weight[a:b]
            top, own = np.maximum.reduceat(x, g), group[a:b] - group[a]
            x = np.exp(x - top[own])
            total = np.add.reduceat(x, g)
            mass[end[a:b][g]] = top + np.log(total)
            share[a:b] = x / total[own]
        rank = np.arange(len(end)) - group_at[group]
        later = np.nonzero(rank)[0]
        for r in range(1, int(rank.max()) + 1):
            now = later[rank[later] == r]
            share[now] += share[now - 1]
        share[np.append(group_at[1:], len(end)) - 1] = 1.0  # the last edge takes what rounding leaves
        self.key = (group.astype(np.int64) << 32) + np.rint(np.minimum(share, 1.0) * 2.0**32).astype(np.int64)
        self.before, self.piece, self.groups = start, piece, len(group_at)
        self.group = np.zeros(len(mass), np.int64)
        self.group[end[group_at]] = np.arange(len(group_at))

    @staticmethod
    def of(words: list[bytes], v: Vocabulary, alpha: float) -> Lattice:
        """The lattices of many words, built in blocks that the processor's cache holds."""
        return Lattice.join([Lattice(words[k : k + BLOCK], v, alpha) for k in range(0, len(words), BLOCK)])

    @staticmethod
    def join(parts: list[Lattice]) -> Lattice:
        """One after the other; the words of each are numbered on."""
        if len(parts) == 1:
            return parts[0]
        nodes = np.cumsum([0, *(len(p.group) for p in parts)])
        groups = np.cumsum([0, *(p.groups for p in parts)])
        out = Lattice.__new__(Lattice)
        out.first, out.last, out.before = (np.concatenate([getattr(p, name) + n for p, n in zip(parts, nodes)]) for name in ("first", "last", "before"))
        out.group = np.concatenate([p.group + g for p, g in zip(parts, groups)])
        out.key = np.concatenate([p.key + (int(g) << 32) for p, g in zip(parts, groups)])
        out.piece = np.concatenate([p.piece for p in parts])
        out.groups = int(groups[-1])
        return out

    def sample(self, word: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For draws of words with a seed each: pieces from first to last, one draw after the other, and their number in each."""
        steps, count = self.steps(word, seed)
        last = np.cumsum(count) - 1
        out = np.empty(int(count.sum()), np.int32)
        for k, (who, piece) in enumerate(steps):
            out[last[who] - k] = piece
        return out, count

    def steps(self, word: np.ndarray, seed: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """For draws of words with a seed each: steps from the last piece to the first (draws, pieces), and the number of pieces."""
        node, first, who = self.last[word], self.first[word], np.arange(len(word))
        count, steps = np.zeros(len(word), np.int64), []
        step = 0
        while len(who):
            u = (_mix(seed[who] + STEPS[step % 4096]) >> np.uint64(32)).astype(np.int64)
            k = np.searchsorted(self.key, (self.group[node] << 32) + u, side="right")
            steps.append((who, self.piece[k]))
            count[who] += 1
            node = self.before[k]
            more = node != first
            node, first, who = node[more], first[more], who[more]
            step += 1
        return steps, count


def _mix(x: np.ndarray) -> np.ndarray:
    """64 random bits of a counter."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def draw(words: pa.LargeBinaryArray, seed: np.ndarray, v: Vocabulary, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Sampled pieces of words with a seed each, one word after the other, and their number in each."""
    coded = words.dictionary_encode()
    given, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    common, kept = v.common.get(alpha, ({}, None))
    number = np.array([common.get(w, -1) for w in given], np.int64)
    rare = np.nonzero(number < 0)[0]
    new = [BLANK + given[k] for k in rare.tolist()]
    word = number[index]
    drawn = []
    if len(rare) < len(given):
        who = np.nonzero(word >= 0)[0]
        drawn.append((who, *kept.steps(word[who], seed[who])))
    if new:
        number[rare] = np.arange(len(rare))
        who = np.nonzero(word < 0)[0]
        drawn.append((who, *Lattice.of(new, v, alpha).steps(number[index[who]], seed[who])))
    count = np.empty(len(word), np.int64)
    for who, _, n in drawn:
        count[who] = n
    last = np.cumsum(count) - 1
    out = np.empty(int(last[-1]) + 1, np.int32)
    for who, steps, _ in drawn:
        at = last[who]
        for k, (some, piece) in enumerate(steps):
            out[at[some] - k] = piece
    if new and len(common) < KEPT:  # words that come again keep their lattices
        again = rare[np.bincount(index, minlength=len(given))[rare] > 1][: KEPT - len(common)].tolist()
        if again:
            more = Lattice.of([BLANK + given[k] for k in again], v, alpha)
            v.common[alpha] = common | {given[k]: len(common) + i for i, k in enumerate(again)}, Lattice.join([kept, more] if kept else [more])
    return out, count


def encode_batch(texts: list[bytes], seeds: np.ndarray, v: Vocabulary, alpha: float) -> list[np.ndarray]:
    """Sampled pieces of each text. A text is its words, each behind a mark for the blank before it; the first has one, too."""
    out: list[np.ndarray] = []
    while len(out) < len(texts):
        a = b = len(out)
        size = 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= BYTES):
            size += len(texts[b])
            b += 1
        split = pc.split_pattern(pa.array(texts[a:b], pa.large_binary()), b" ")
        stop = np.cumsum(pc.list_value_length(split).to_numpy())
        begin = np.concatenate(([0], stop[:-1]))
        words, own, total, drawn = split.flatten(), seeds[a:b], np.zeros(b - a, np.int64), []
        for k in range(0, len(words), WORDS):
            part = words[k : k + WORDS]
            at = np.arange(k, k + len(part))
            text = np.searchsorted(stop, at, side="right")
            number = (at - begin[text]).astype(np.uint64)
            pieces, n = draw(part, _mix(own[text] + (number + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)), v, alpha)
            drawn.append(pieces)
            total[text[0] : text[-1] + 1] += np.add.reduceat(n, np.searchsorted(text, np.arange(text[0], text[-1] + 1)))
        out += np.split(np.concatenate(drawn), np.cumsum(total)[:-1])
    return out


def decode(ids: np.ndarray, v: Vocabulary) -> bytes:
    """The text of pieces: byte pieces as they are, a mark at a plain piece's start as a blank, without the first blank."""
    n = v.shown_size[ids]
    return v.shown[np.repeat(v.shown_at[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes()[1:]


def encode(docs: DataFrame, path: str, alpha: float = 1.0, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of piece numbers) for every row, drawn from all segmentations by their weight to the power alpha.

    The draw depends on the row's key and `seed` alone: it's the same in every run, task and batch. A null text counts as empty, which is
    the mark of one blank. Repeated rows give repeated results; rows with a null key share a seed. An empty table gives no row.
    """
    texts = id_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("doc_id", F.lit(seed)).alias("seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for x in batches:
            found = encode_batch(x.column("text").to_pylist(), x.column("seed").to_numpy().view(np.uint64), v, alpha)
            flat = pa.array(np.concatenate(found) if found else np.empty(0, np.int32), pa.int32())
            ends = pa.array(np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), pa.ListArray.from_arrays(ends, flat)], ["doc_id", "ids"])

    return texts.mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, alpha: float = 1.0, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of little-endian 32-bit numbers), text_crc32 (of the decoded text), lossless; see `encode`."""
    texts = id_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("doc_id", F.lit(seed)).alias("seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for x in batches:
            given = x.column("text").to_pylist()
            found = encode_batch(given, x.column("seed").to_numpy().view(np.uint64), v, alpha)
            back = [decode(f, v) for f in found]
            columns = [pa.array([len(f) for f in found], pa.int64()), pa.array([crc32(f.astype("<u4").tobytes()) for f in found], pa.int64()), pa.array([crc32(b) for b in back], pa.int64()), pa.array([a == b for a, b in zip(given, back)], pa.bool_())]
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), *columns], ["doc_id", "n_pieces", "ids_crc32", "text_crc32", "lossless"])

    return texts.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, text_crc32 long, lossless boolean")
