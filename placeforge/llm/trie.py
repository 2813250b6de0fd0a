"""The prefixes that conversations share: adaptive radix trees over turn ids of fixed width, built by tasks and merged node by node."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import cut

#: Bytes of a turn's id and of a node's; of keys that one tree holds; conversations whose ids are joined in one row for the digest.
WIDTH, TREE_BYTES, CHUNK = 16, 32 << 20, 1 << 16


class Children:
    """Children of a node by their next byte, in the least of four layouts that holds them; a layout that is full grows into the next.

    Up to 4 and 16: bytes and children side by side, sorted. Up to 48: a table of 256 places into a row of children. Above: a row of 256.
    """

    __slots__ = ("size", "most", "bytes", "nodes")

    def __init__(self):
        self.size, self.most, self.bytes, self.nodes = 0, 4, bytearray(), []

    def get(self, byte: int):
        if self.most <= 16:
            at = self.bytes.find(byte)
            return self.nodes[at] if at >= 0 else None
        if self.most == 48:
            at = self.bytes[byte]
            return self.nodes[at - 1] if at else None
        return self.nodes[byte]

    def put(self, byte: int, node) -> None:
        """A new child, or another in the place of one."""
        if self.most <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.nodes[at] = node
                return
            if self.size < self.most:
                at = sum(b < byte for b in self.bytes)
                self.bytes.insert(at, byte)
                self.nodes.insert(at, node)
                self.size += 1
                return
            self._grow()
        if self.most == 48:
            at = self.bytes[byte]
            if at:
                self.nodes[at - 1] = node
                return
            if self.size < 48:
                self.nodes.append(node)
                self.size += 1
                self.bytes[byte] = self.size
                return
            self._grow()
        if self.most > 48:
            self.size += self.nodes[byte] is None
            self.nodes[byte] = node
        else:
            self.put(byte, node)

    def _grow(self) -> None:
        if self.most == 4:
            self.most = 16
        elif self.most == 16:
            table = bytearray(256)
            for at, b in enumerate(self.bytes):
                table[b] = at + 1
            self.most, self.bytes = 48, table
        else:
            row = [None] * 256
            for b in range(256):
                if self.bytes[b]:
                    row[b] = self.nodes[self.bytes[b] - 1]
            self.most, self.bytes, self.nodes = 256, bytearray(), row

    def each(self) -> Iterator[tuple[int, Node]]:
        """(byte, child) by rising bytes."""
        if self.most <= 16:
            yield from zip(self.bytes, self.nodes)
        elif self.most == 48:
            yield from ((b, self.nodes[self.bytes[b] - 1]) for b in range(256) if self.bytes[b])
        else:
            yield from ((b, x) for b, x in enumerate(self.nodes) if x is not None)


class Node:
    """`path`: the bytes from the parent's branch to here, so chains without a branch are one node. count, least: of the keys below; ends: of those that end here."""

    __slots__ = ("path", "children", "count", "least", "ends", "sizes")

    def __init__(self, path: bytes, count: int, least: int, sizes):
        self.path, self.count, self.least, self.sizes = path, count, least, sizes
        self.children, self.ends = Children(), []


class RadixTree:
    """Keys are turn ids, one behind the other; each has a number and its turns' sizes."""

    def __init__(self):
        self.root: Node | None = None
        self.bytes = 0

    def insert(self, key: bytes, number: int, sizes) -> None:
        self.bytes += len(key) + 64
        if self.root is None:
            self.root = Node(b"", 0, number, sizes)
        node, at, above, byte = self.root, 0, None, 0
        while True:
            path, same = node.path, 0
            rest = key[at : at + len(path)]
            if rest == path:
                same = len(path)
            else:
                same = next((k for k, (a, b) in enumerate(zip(rest, path)) if a != b), len(rest))
                fork = Node(path[:same], node.count, node.least, node.sizes)  # the path is cut where the key leaves it
                fork.children.put(path[same], node)
                node.path = path[same + 1 :]
                above.children.put(byte, fork)
                node = fork
            at += same
            node.count, node.least = node.count + 1, min(node.least, number)
            if at == len(key):
                node.ends.append(number)
                return
            above, byte = node, key[at]
            at += 1
            child = node.children.get(byte)
            if child is None:
                child = Node(key[at:], 1, number, sizes)
                child.ends.append(number)
                node.children.put(byte, child)
                return
            node = child

    def nodes(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, int, list[int]]]:
        """(id, parent id, depth, least number, count, size of the last turn, numbers that end there) where a whole number of turns ends."""
        if self.root is None:
            return
        start = hashlib.sha256()
        yield start.digest()[:WIDTH], None, 0, self.root.least, self.root.count, 0, self.root.ends
        todo = [(self.root, start, start.digest()[:WIDTH], 0)]
        while todo:
            top, state, parent, depth = todo.pop()
            for byte, node in top.children.each():
                own, up, deep = state.copy(), parent, depth
                piece = bytes([byte]) + node.path
                last = (deep + len(piece)) // WIDTH
                while deep // WIDTH < last:
                    step = WIDTH - deep % WIDTH
                    own.update(piece[:step])
                    piece, deep = piece[step:], deep + step
                    turns, name = deep // WIDTH, own.digest()[:WIDTH]
                    yield name, up, turns, node.least, node.count, int(node.sizes[turns - 1]), node.ends if not piece else []
                    up = name
                own.update(piece)
                todo.append((node, own, up, deep + len(piece)))


def path_ids(ids: list[bytes]) -> list[bytes]:
    """The ids of the nodes on a path of turn ids, the root's first."""
    state = hashlib.sha256()
    out = [state.digest()[:WIDTH]]
    for x in ids:
        state.update(x)
        out.append(state.digest()[:WIDTH])
    return out


def turn_lists(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of turns to (conv_id, ids, sizes): the turns in order (null first; equal numbers by their ids), ids as 16 bytes of a digest of role and text, sizes in UTF-8 bytes of the text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    name = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDTH)
    turn = F.col(f"`{turn_col}`")
    each = turns.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.struct(turn.isNotNull().alias("known"), turn.alias("turn"), name.alias("id"), F.octet_length(text).alias("size")).alias("t"))
    lists = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


def spliced(lists: DataFrame, every: int = 5, head: Column | None = None, longest: int = 8) -> DataFrame:
    """Conversations whose first `head` turns are those of the conversation at the last multiple of `every`, and the rest their own.

    head: at most `longest`; by default crc32 of the decimal conv_id modulo longest + 1. A conversation that isn't there has no turns to give.
    """
    head = F.crc32(F.col("conv_id").cast("string")) % (longest + 1) if head is None else head
    base = F.col("conv_id") - F.col("conv_id") % every
    given = lists.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("ids", 1, longest).alias("b_ids"), F.slice("sizes", 1, longest).alias("b_sizes"))
    both = lists.withColumn("h", head.cast("int")).withColumn("own", base).join(given, F.col("own") == F.col("base"), "left")
    join = lambda b, own, kind: F.concat(F.slice(F.coalesce(b, F.array().cast(kind)), F.lit(1), F.col("h")), F.slice(own, F.col("h") + 1, F.greatest(F.size(own), F.lit(1))))
    return both.select("conv_id", join(F.col("b_ids"), "ids", "array<binary>").alias("ids"), join(F.col("b_sizes"), "sizes", "array<int>").alias("sizes"))


def _trees(lists: DataFrame) -> DataFrame:
    """Nodes of the trees of all tasks; a node whose conversations lie in several trees comes once for each."""
    names = ["node", "parent", "depth", "conv_id", "n_convs", "size", "ends"]
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def told(tree: RadixTree) -> Iterator[pa.RecordBatch]:
        out = []
        for x in tree.nodes():
            out.append(x)
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = RadixTree()
        for b in batches:
            for number, ids, sizes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                tree.insert(b"".join(ids), number, sizes.values.to_numpy())
                if tree.bytes > TREE_BYTES:
                    yield from told(tree)
                    tree = RadixTree()
        yield from told(tree)

    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # neighbours in the tree go to one task, and copies of a conversation are cut by their numbers
    dealt = lists.repartitionByRange(parts, F.slice("ids", 1, 8), "conv_id").sortWithinPartitions("ids", "conv_id")
    return dealt.select("conv_id", "ids", "sizes").mapInArrow(run, "node binary, parent binary, depth long, conv_id long, n_convs long, size long, ends array<long>")


def _digests(ends: DataFrame) -> DataFrame:
    """(node, conv_id) to (node, ends_sha256): ids ascending, joined by commas; joined in chunks first, which are then streamed through the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for b in batches:
            out = []
            for node, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if node != last:
                    if last is not None:
                        out.append((last, state.hexdigest()))
                    last, state = node, hashlib.sha256(text)
                else:
                    state.update(b"," + text)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.binary(), pa.string()))], ["node", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    chunk = F.floor(F.col("conv_id") / CHUNK).alias("chunk")
    chunks = ends.groupBy("node", chunk).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").cast("binary").alias("text"))
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return chunks.repartition(parts, "node").sortWithinPartitions("node", "chunk").select("node", "text").mapInArrow(run, "node binary, ends_sha256 string")


def _subtree_sums(nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """(node, n_leaves, saved_tokens) over each node's subtree.

    The nodes that have a conversation as their least one are the end of its path. So each such conversation gives every node of its
    path what its own nodes at or below that depth hold, and what is given to a node adds up; rows are as many as turns.
    """
    worth = ((F.col("n_convs") - 1) * F.col("size")).alias("worth")
    own = nodes.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", (F.col("n_children") == 0).cast("long").alias("leaf"), worth))).alias("own"))
    paths = own.join(lists.select("conv_id", "ids"), "conv_id").select("ids", F.col("own.depth").alias("depths"), F.col("own.leaf").alias("leaf"), F.col("own.worth").alias("worth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[bytes, tuple[int, int]] = {}
            for ids, depths, leaf, worth in zip(*(c.to_pylist() for c in b.columns)):
                names, leaves, saved, k = path_ids(ids), 0, 0, len(depths) - 1
                for at in range(len(names) - 1, -1, -1):
                    if k >= 0 and depths[k] == at:
                        leaves, saved, k = leaves + leaf[k], saved + worth[k], k - 1
                    had = sums.get(names[at], (0, 0))
                    sums[names[at]] = had[0] + leaves, had[1] + saved
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array([x[0] for x in sums.values()], pa.int64()), pa.array([x[1] for x in sums.values()], pa.int64())], ["node", "n_leaves", "saved_tokens"])

    return paths.mapInArrow(run, "node binary, n_leaves long, saved_tokens long").groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def prefix_trie(lists: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes), a row for each conversation, to a row for each distinct sequence of first turns:
    conv_id (the least of its conversations), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are dealt by their first turns, so a node lies in few tasks even if a third of all conversations share it; trees are
    told and begun anew at a bounded size. A conversation without turns ends at the root; one that is there twice counts as two. A
    conversation's ids (16 bytes a turn) must fit in a task, its text need not. Without conversations there is no row.
    """
    lists = cut(lists.where("conv_id is not null"), "lists")
    parts = cut(_trees(lists), "trees")
    merged = parts.groupBy("node").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("size").alias("size"))
    merged = cut(merged, "nodes")
    children = merged.where("parent is not null").groupBy(F.col("parent").alias("up")).agg(F.count("*").alias("n_children"))
    nodes = merged.join(children, F.col("node") == F.col("up"), "left").select(*merged.columns, F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"))
    nodes = cut(nodes, "nodes")
    ends = _digests(parts.select("node", F.explode("ends").alias("conv_id")))
    parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(_subtree_sums(nodes, lists), "node", "left").join(ends, "node", "left").join(parents, F.col("parent") == F.col("up"), "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
