"""The prefix trie of conversations, from a mergesort that carries common prefixes (LCPs).

A conversation is a record: an array of turn keys. Records are dealt in ranges of (keys, id), so that each task
holds a run of the sorted order; equal conversations, however many, are parted by their ids. Within a task,
each Arrow batch is sorted into a run that carries every record's LCP with the one before. A loser tree merges the runs:
of two heads, the one that shares more turns with the last record put out is the smaller, and only if both share as many
are their turns compared, from there on. The merged stream, with its LCPs, drives a stack of open nodes: a record closes all
nodes below its LCP and opens its own. A closed node is final and goes out.

What a task cannot close are the paths of its first and of its last record, which neighbours may share. These go out as
partial nodes, a path or two per task, and one more pass over them, by the same stack, adds up what several tasks
have of a node. A node's parent is known by its smallest member only when the parent is closed, which is later; so
closed nodes are kept in columns until their task ends and read backwards, parents first. Tasks are sized by bytes,
so runs and columns fit; what is larger than a task is sorted by Spark's range exchange, which spills.

The members that end at a node are hashed in the order of their ids; for nodes open over several tasks, the ids
go out in pieces, which one task per node hashes in order: SHA-256 is sequential, but a piece at a time is held.

Cases: rows without a conversation id are in no conversation; null roles and texts are empty; turns come in order of
``turn``, null first, ties by role and then by the turn's key; repeated rows are turns of their own; an
empty table gives no node. Turns are told apart by 128 bits of the SHA-256 of role and text. A conversation must fit a task, at
24 bytes a turn; no text is carried.
"""

from __future__ import annotations

import hashlib
import itertools
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import cut, if_small, in_parts, shuffle_partitions

#: Bytes of turn keys that a task should hold, and ids in a piece.
TASK_BYTES, PIECE = 32 << 20, 4096

Record = tuple[tuple[bytes, ...], int, list[int]]  # keys, id, bytes of each turn


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): an array of (key, bytes) per conversation."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    key = F.unhex(F.substring(F.sha2(whole, 256), 1, 32))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), role.alias("role"), key.alias("key"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["key"].alias("key"), t["bytes"].alias("bytes"))).alias("turns"))


def shared(a: tuple, b: tuple, start: int) -> int:
    """How many turns two records share, which are known to share ``start``."""
    n = min(len(a), len(b))
    while start < n and a[start] == b[start]:
        start += 1
    return start


class Run:
    """Records in order, each with its LCP with the one before."""

    def __init__(self, records: list[Record]):
        self.records = sorted(records, key=lambda r: r[:2])
        self.lcps = array("q", [0] * len(self.records))
        for i in range(1, len(self.records)):
            self.lcps[i] = shared(self.records[i - 1][0], self.records[i][0], 0)
        self.at = 0

    def head(self) -> Record | None:
        return self.records[self.at] if self.at < len(self.records) else None


class LoserTree:
    """Merges runs; ``lcp`` of a run is that of its head with the last record put out. ``compared`` counts compared turns."""

    def __init__(self, runs: list[Run]):
        self.runs, self.k, self.compared = runs, max(1, len(runs)), 0
        self.lcp = [0] * len(runs)
        self.losers = [-1] * self.k
        self.winner = -1
        for i in range(len(runs)):
            self._climb(i)

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's LCP becomes that with the winner."""
        x, y = self.runs[a].head(), self.runs[b].head()
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        la, lb = self.lcp[a], self.lcp[b]
        if la != lb:  # who shares more with the last one put out comes first, and the other's LCP holds with it too
            return (a, b) if la > lb else (b, a)
        n = shared(x[0], y[0], la)
        self.compared += n - la + 1
        if (x[0][n : n + 1], x[1]) <= (y[0][n : n + 1], y[1]):
            self.lcp[b] = n
            return a, b
        self.lcp[a] = n
        return b, a

    def _climb(self, i: int, first: bool = True) -> None:
        node = (i + self.k) // 2
        while node:
            if self.losers[node] < 0 and first:  # nobody has come here yet: wait
                self.losers[node] = i
                return
            i, self.losers[node] = self._play(i, self.losers[node])
            node //= 2
        self.winner = i

    def __iter__(self) -> Iterator[tuple[Record, int]]:
        """Records in order, each with its LCP with the one before."""
        while self.winner >= 0 and (record := self.runs[self.winner].head()) is not None:
            run = self.runs[self.winner]
            yield record, self.lcp[self.winner]
            run.at += 1
            if run.at < len(run.records):
                self.lcp[self.winner] = run.lcps[run.at]
            self._climb(self.winner, first=False)


INF = (1 << 63) - 1
ROOT = b"root"
NODES = "part long, place long, depth long, conv long, n long, children long, leaves long, saved long, bytes long, ends string, key binary, parent_conv long, parent_key binary, ids string"
NAMES = [c.split()[0] for c in NODES.split(", ")]
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
SUMS = ["depth", "conv", "n", "children", "leaves", "saved", "bytes", "place"]


class Node:
    """A node on the open path; ``ids`` are those of its members that end here, in order."""

    __slots__ = ("key", "bytes", "conv", "n", "children", "leaves", "saved", "ids", "place")

    def __init__(self, key: bytes | None, size: int):
        self.key, self.bytes, self.conv, self.n, self.children, self.leaves, self.saved = key, size, INF, 0, 0, 0, 0
        self.ids, self.place = array("q"), -1

    def add(self, conv: int, n: int, children: int, leaves: int, saved: int) -> None:
        self.conv, self.n = min(self.conv, conv), self.n + n
        self.children, self.leaves, self.saved = self.children + children, self.leaves + leaves, self.saved + saved


class Path:
    """The open nodes from the root down, and the closed ones in columns.

    A node with a ``place`` is partial: it closes without being added to its parent, and its sums are those of this task.
    """

    def __init__(self) -> None:
        self.stack: list[Node] = []
        self.columns = {c: array("q") for c in SUMS}
        self.ends: list[str | None] = []
        self.keys: list[bytes | None] = []

    def close(self, depth: int) -> None:
        """Close all nodes deeper than ``depth``; -1 closes the root too."""
        while len(self.stack) > depth + 1:
            node = self.stack.pop()
            if node.place < 0:
                node.leaves += not node.children
                node.saved += (node.n - 1) * node.bytes
                if self.stack:
                    self.stack[-1].add(node.conv, node.n, 1, node.leaves, node.saved)
            row = (len(self.stack), node.conv, node.n, node.children, node.leaves, node.saved, node.bytes, node.place)
            for c, x in zip(SUMS, row, strict=True):
                self.columns[c].append(x)
            self.ends.append(hashlib.sha256(",".join(map(str, node.ids)).encode()).hexdigest() if node.place < 0 else None)
            self.keys.append(node.key)

    def backwards(self, part: int) -> Iterator[tuple]:
        """Rows of NODES, parents first, each with what is known of its parent: the smallest member, or the key of a partial one."""
        above: list[tuple[int | None, bytes | None]] = []
        for i in range(len(self.ends) - 1, -1, -1):
            depth, conv, n, children, leaves, saved, size, place = (self.columns[c][i] for c in SUMS)
            del above[depth:]
            up_conv, up_key = above[-1] if above else (None, None)
            above.append((conv, None) if place < 0 else (None, self.keys[i]))
            yield part, place, depth, conv, n, children, leaves, saved, size, self.ends[i], self.keys[i], up_conv, up_key, None


def chained(above: bytes, key: bytes) -> bytes:
    """The key of a path, from that of the path above it."""
    return hashlib.blake2b(above + key, digest_size=16).digest()


def task_nodes(runs: list[Run], part: int) -> Iterator[tuple]:
    """Rows of NODES for the records of one task: closed nodes, partial nodes of the first and last path, and pieces of the ids that end on those."""
    path, first, last = Path(), None, ()
    pieces: list[tuple] = []

    def leave(depth: int) -> None:
        for node in path.stack[depth + 1 :]:
            if node.place >= 0:
                for at in range(0, len(node.ids), PIECE):
                    ids = ",".join(map(str, node.ids[at : at + PIECE]))
                    pieces.append((part, at // PIECE, *[None] * 8, node.key, None, None, ids))
        path.close(depth)

    for (keys, conv, sizes), lcp in LoserTree(runs):
        if first is None:
            first = keys
            path.stack.append(Node(ROOT, 0))
            path.stack[0].place = 0
        leave(lcp)
        for d in range(lcp, len(keys)):
            node = Node(None, sizes[d])
            if keys is first:
                node.key, node.place = chained(path.stack[-1].key, keys[d]), d + 1
            path.stack.append(node)
        path.stack[-1].add(conv, 1, 0, 0, 0)
        path.stack[-1].ids.append(conv)
        last = keys
    if first is None:
        return
    for d, node in enumerate(path.stack):
        if node.place < 0:
            node.key, node.place = chained(path.stack[d - 1].key, last[d - 1]), len(first) + 1 + d
    leave(-1)
    yield from path.backwards(part)
    yield from pieces


def joined_nodes(partial: Iterator[tuple]) -> Path:
    """The nodes of partial rows (depth, conv, n, children, leaves, saved, bytes, key), tasks in order, each path from the root down."""
    path = Path()
    for depth, conv, n, children, leaves, saved, size, key in partial:
        if len(path.stack) <= depth or path.stack[depth].key != key:
            path.close(depth - 1)
            path.stack.append(Node(key, size))
        path.stack[depth].add(conv, n, children, leaves, saved)
    path.close(-1)
    return path


def _batches(rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    kinds = [_KINDS[c.split()[1]] for c in NODES.split(", ")]
    while held := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=NAMES)


def _nodes_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs, part = [], 0
    for b in batches:
        if b.num_rows:
            part = b.column(0)[0].as_py()
            turns = b.column(2).to_pylist()
            runs.append(Run([(tuple(t["key"] for t in own), conv, [t["bytes"] for t in own]) for conv, own in zip(b.column(1).to_pylist(), turns, strict=True)]))
    yield from _batches(task_nodes(runs, part))


def _join_partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (tuple(r) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    yield from _batches(joined_nodes(rows).backwards(0))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends) from pieces (key, ids) sorted by key and order; a piece at a time is held."""
    key, own = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([own.hexdigest()])], names=["key", "ends"])

    for b in batches:
        for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if k != key:
                if own:
                    yield told()
                key, own = k, hashlib.sha256(ids.encode())
            else:
                own.update(b"," + ids.encode())
    if own:
        yield told()


def trie(records: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row per node of the trie over ``records(conv_id, turns)``, whose turns are (key, bytes).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves (childless nodes of the subtree, itself
    included), saved_tokens (over the subtree, (n_convs - 1) times the last turn's bytes), ends_sha256 (of the ids that end here).
    """
    spark = records.sparkSession
    fixed = cut(records.select("conv_id", "turns"))
    size = fixed.agg(F.sum(F.size("turns") * 24 + 64)).first()[0] or 0
    tasks = max(shuffle_partitions(spark), -(-size // task_bytes))
    dealt = fixed.repartitionByRange(tasks, F.transform("turns", lambda t: t["key"]), "conv_id").select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "turns")
    nodes = cut(dealt.mapInArrow(in_parts(_nodes_of_task, 4096), NODES))
    partial = nodes.where("key is not null and ids is null").select("part", "place", "depth", "conv", "n", "children", "leaves", "saved", "bytes", "key")
    in_order = partial.repartition(1).sortWithinPartitions("part", "place").drop("part", "place")  # a path or two per task
    open_ = cut(in_order.mapInArrow(_join_partial, NODES))
    pieces = nodes.where("ids is not null").select("key", "ids", "part", "place").repartition("key").sortWithinPartitions("key", "part", "place").select("key", "ids")
    ends = pieces.mapInArrow(_digests, "key binary, ends string").withColumnRenamed("ends", "told")
    shown = lambda df, parent, told: df.select(F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), told.alias("ends_sha256"))
    closed = nodes.where("key is null")
    inside = shown(closed.where("parent_key is null"), F.col("parent_conv"), F.col("ends"))
    tops = open_.select(F.col("key").alias("open_key"), F.col("conv").alias("open_conv"))
    under = shown(closed.join(if_small(tops), F.col("parent_key") == F.col("open_key")), F.col("open_conv"), F.col("ends"))
    joined = shown(open_.join(ends, "key", "left"), F.col("parent_conv"), F.coalesce("told", F.lit(hashlib.sha256(b"").hexdigest())))
    return inside.unionByName(under).unionByName(joined)
