"""Benchmark decontamination with suffix arrays over the training text.

Each shard of training documents (a bounded number of words of consecutive
rows) gets a suffix array; the words of the benchmark are its alphabet, and any
other word ends a suffix. Every suffix of every benchmark item is looked up by
binary search, and its two neighbours give its longest verbatim match. Where
that is as long as the window that begins there, the range of suffixes that
share the window gives all its places, whose words are hit and whose documents
are affected; ``longest_matches`` returns the matches and places themselves.
Shards are searched where their rows are, so documents are never shuffled.

Two things that cannot change a search are left out of a suffix array: runs of
benchmark words shorter than the shortest window, and order beyond the length
of the longest item. The benchmark is read in blocks of a bounded number of
words; each block is broadcast and searched against all rows, whose words are
cut and numbered once for all blocks.

Defined cases: null text has no words; an item without words has no windows; an
item of fewer words than a window is one window; equal windows of several items
count for each; items with a null id hit words but are not listed; repeated
rows are searched each; empty tables give empty or clean results; other columns
are ignored by ``contamination`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import in_parts, kept_rows, texts_of

WINDOW = 10
#: Words and rows of a shard at most, and words of a block of the benchmark; one longer text is a shard or block of its own.
SHARD_WORDS = 2_000_000
SHARD_ROWS = 2048
BLOCK_WORDS = 1_000_000
#: A-Z lowered, other ASCII but digits and letters turned to spaces, everything else kept.
_TABLE = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Block:
    """Items of a benchmark as numbers: their words in one array with a zero after each, and their distinct windows."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        sequence, places = [], {}
        for item, own in items:
            at = len(sequence)
            sequence += [self.ids.setdefault(w, len(self.ids) + 1) for w in own] + [0]
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                places.setdefault(tuple(sequence[at + i : at + i + size]), (at + i, []))[1].append(item)
        self.words = np.array([*sequence, 0], np.int32)
        self.starts = np.array([p for p, _ in places.values()], np.int64)
        self.sizes = np.array([len(w) for w in places], np.int64)
        self.owners = [sorted({x for x in own if x is not None}) for _, own in places.values()]
        self.least = int(self.sizes.min(initial=window))
        ends = np.flatnonzero(self.words == 0)
        self.rest = ends[np.searchsorted(ends, np.arange(len(self.words)))] - np.arange(len(self.words))
        self.longest = int(self.rest.max(initial=0))
        self.suffixes = np.flatnonzero(self.rest >= self.least)
        #: Of each suffix its item and the place in it.
        self.item_of = [item for item, own in items for _ in range(len(own) + 1)]
        self.begin = np.concatenate([np.arange(len(own) + 1) for _, own in items]) if items else np.zeros(0, np.int64)

    def table(self, vocabulary: list[bytes]) -> np.ndarray:
        """The block's number of each word, zero for those it has not."""
        return np.fromiter(map(self.ids.get, vocabulary, repeat(0)), np.int32, len(vocabulary))


def numbered(texts: list[bytes]) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct words of some texts, and each text as places in them."""
    places: dict[bytes, int] = defaultdict(count().__next__)
    found = [np.fromiter(map(places.__getitem__, own), np.int32, len(own)) for own in map(words, texts)]
    return list(places), found


class Shard:
    """Suffix array of the runs of benchmark words in some documents."""

    def __init__(self, documents: list[np.ndarray], block: Block):
        gap = np.zeros(1, np.int32)
        whole = np.concatenate([x for d in documents for x in (d, gap)] or [gap])
        self.ends = np.cumsum([len(d) + 1 for d in documents])
        inside = np.concatenate([[0], (whole > 0).view(np.int8), [0]])
        turn = np.flatnonzero(np.diff(inside))
        first, last = turn[::2], turn[1::2]
        kept = last - first >= block.least
        first, size = first[kept], (last - first)[kept]
        # the runs side by side, with a zero after each, and where each word is in the whole
        at = np.concatenate([[0], np.cumsum(size + 1)])
        self.place = np.arange(at[-1]) + np.repeat(first - at[:-1], size + 1)
        self.text = np.zeros(at[-1] + 1, np.int32)
        real = np.ones(at[-1], bool)
        real[at[1:] - 1] = False
        self.text[:-1][real] = whole[self.place[real]]
        self.rest = np.repeat(at[1:] - 1, size + 1) - np.arange(at[-1])
        self.total = len(whole)
        self.array = self._sorted(block.longest)

    def _sorted(self, depth: int) -> np.ndarray:
        """Starts of all suffixes by their words, by prefix doubling; equal ones by place."""
        rank, n, width = self.text[:-1].astype(np.int64), len(self.text) - 1, 1
        kinds = -1
        while width < depth and n:
            after = np.zeros(n, np.int64)
            after[: max(n - width, 0)] = rank[width:]
            after[self.rest <= width] = 0
            found, rank = np.unique(rank * (n + int(rank.max(initial=0)) + 2) + after, return_inverse=True)
            if len(found) == kinds:
                break
            kinds, width = len(found), 2 * width
        order = np.argsort(rank, kind="stable")
        return order[self.rest[order] > 0]

    def _compare(self, at: np.ndarray, block: Block, query: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sign of the suffixes at ``at`` against the first ``size`` words of the query suffixes, and the words they share."""
        sign, shared = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        live, step = np.arange(len(at)), 0
        while len(live := live[size[live] > step]):
            apart = np.sign(self.text[np.minimum(at[live] + step, len(self.text) - 1)] - block.words[query[live] + step])
            sign[live] = apart
            live = live[apart == 0]
            shared[live] = step = step + 1
        return sign, shared

    def search(self, block: Block, query: np.ndarray, size: np.ndarray, upper: bool = False) -> np.ndarray:
        """First rank whose suffix is not below the query's words, or, if ``upper``, above all that start with them."""
        low, high = np.zeros(len(query), np.int64), np.full(len(query), len(self.array))
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            sign, _ = self._compare(self.array[middle], block, query[open_], size[open_])
            below = sign <= 0 if upper else sign < 0
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
        return low

    def longest(self, block: Block) -> np.ndarray:
        """Of each of the block's suffixes the words of its longest match, which one of its two neighbours shows."""
        query, n = block.suffixes, len(self.array)
        best = np.zeros(len(query), np.int64)
        if n and len(query):
            size = block.rest[query]
            place = self.search(block, query, size)
            for rank in (place, place - 1):
                there = (rank >= 0) & (rank < n)
                shared = np.where(there, self._compare(self.array[np.clip(rank, 0, n - 1)], block, query, size)[1], 0)
                best = np.maximum(best, shared)
        return best

    def hits(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words of the whole are hit; and distinct pairs (document, window)."""
        reach = np.zeros(len(block.words), np.int64)
        reach[block.suffixes] = self.longest(block)
        found = np.flatnonzero(reach[block.starts] >= block.sizes)  # windows whose suffixes match that far
        low, high = (self.search(block, block.starts[found], block.sizes[found], upper) for upper in (False, True))
        n = high - low
        ranks = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        window, at = np.repeat(found, n), self.place[self.array[ranks]]
        cover = np.bincount(at, minlength=self.total + 1) - np.bincount(at + block.sizes[window], minlength=self.total + 1)
        width = max(len(block.starts), 1)
        pairs = np.unique(np.searchsorted(self.ends, at, side="right") * width + window)
        return np.cumsum(cover[:-1]) > 0, pairs // width, pairs % width

    def matches(self, block: Block) -> Iterator[tuple[int, int, int, int]]:
        """For each suffix of an item that matches as much as the shortest window: (suffix, longest match, document, word in it)."""
        query, best = block.suffixes, self.longest(block)
        # of equally long matches the first place: they are side by side in the array
        for q in np.flatnonzero(best >= block.least):
            one, length = np.array([query[q]]), np.array([best[q]])
            span = slice(int(self.search(block, one, length)[0]), int(self.search(block, one, length, upper=True)[0]))
            at = int(self.place[self.array[span]].min())
            document = int(np.searchsorted(self.ends, at, side="right"))
            yield int(query[q]), int(best[q]), document, at - int(self.ends[document - 1] if document else 0)


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[Broadcast]:
    """The benchmark ``(item_id, text)`` in broadcast blocks of at most ``block_words`` words, or one longer item."""
    spark, out, items, size = benchmark.sparkSession, [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).toLocalIterator()
    for item, text in rows:
        own = words(bytes(text)) if text is not None else []
        if items and size + len(own) > block_words:
            out.append(spark.sparkContext.broadcast(Block(items, window)))
            items, size = [], 0
        items.append((item, own))
        size += len(own)
    return [*out, spark.sparkContext.broadcast(Block(items, window))]


def _opened(shared: list[Broadcast]) -> Iterator[Block]:
    """One block after the other; only one is held if there are several."""
    for b in shared:
        yield b.value
        if len(shared) > 1:
            b.__dict__.pop("_value", None)


def _shards(texts: list[bytes], most: int) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of at most about ``most`` words together."""
    part, size, first = [], 0, 0
    for i, x in enumerate(texts):
        if part and size + len(x) > 6 * most:
            yield first, part
            part, size, first = [], 0, i
        part.append(x)
        size += len(x)
    if part:
        yield first, part


def _found(texts: list[bytes], shared: list[Broadcast], shard_words: int) -> Iterator[tuple[int, int, set[int]]]:
    """Words, words hit and items of each text."""
    for _, part in _shards(texts, shard_words):
        hit, items, (vocabulary, places) = None, [set() for _ in part], numbered(part)
        for block in _opened(shared):
            table = block.table(vocabulary)
            shard = Shard([table[x] for x in places], block)
            own, document, window = shard.hits(block)
            for d, w in zip(document.tolist(), window.tolist(), strict=True):
                items[d].update(block.owners[w])
            hit = own if hit is None else hit | own  # a word that several blocks hit counts once
        n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], shard.ends])])
        yield from zip(map(len, places), n_hit.tolist(), items, strict=True)


SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """What each row of ``docs(doc_id, text)`` holds of the windows of ``benchmark(item_id, text)``."""
    shared = blocks(benchmark, window, block_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, hit, items = [list(x) for x in zip(*_found(texts_of(b.column(1)), shared, shard_words), strict=True)] or [[], [], []]
            digests = [hashlib.sha256(",".join(sorted(map(str, x))).encode()).hexdigest() for x in items]
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digests, pa.string()), pa.array([x > 0 for x in hit], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(in_parts(run, SHARD_ROWS), SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark."""
    shared, place = blocks(benchmark, window), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x.encode() for x in texts_of(b.column(place))]
            yield kept_rows(b, [hit == 0 for _, hit, _ in _found(texts, shared, SHARD_WORDS)])

    return docs.mapInArrow(in_parts(run, SHARD_ROWS), docs.schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """For each suffix of an item that matches as much as its shortest window: the longest match over all shards and its first place.

    Columns item_id, item_word (the suffix's start), length in words, doc_id, doc_word.
    """
    shared = blocks(benchmark, window, block_words)
    schema = "item_id long, item_word long, length long, doc_id long, doc_word long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows = b.column(0).to_pylist(), []
            for first, part in _shards(texts_of(b.column(1)), shard_words):
                vocabulary, places = numbered(part)
                for block in _opened(shared):
                    table = block.table(vocabulary)
                    for suffix, length, document, at in Shard([table[x] for x in places], block).matches(block):
                        rows.append((block.item_of[suffix], int(block.begin[suffix]), length, keys[first + document], at))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=[x.split()[0] for x in schema.split(", ")])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(in_parts(run, SHARD_ROWS), schema)
    best = found.groupBy("item_id", "item_word").agg(F.max(F.struct("length", (-F.col("doc_id")).alias("d"), (-F.col("doc_word")).alias("w"))).alias("m"))
    return best.select("item_id", "item_word", "m.length", (-F.col("m.d")).alias("doc_id"), (-F.col("m.w")).alias("doc_word"))
