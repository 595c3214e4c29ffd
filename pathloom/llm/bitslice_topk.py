"""Exact top-k inner products from a bit-sliced index.

Rows are dealt into blocks of bounded size. In a block every quantised
attribute is a stack of bitmaps, one per bit in two's complement, with a bit
per row. A query's score is the sum of its attribute multiples: multiples are
made once by shifting and adding slices, and all sums are ripple-carry
additions of bitmaps, a batch of queries at a time. The top rows are then taken
from the most significant slice of the score downward, which leaves the rows
surely in and those that tie at the boundary; of these the smallest ids are
taken exactly. A block gives k + 1 rows per query, of which one may be the
query's own, and a ranking over blocks the k best others of all. Queries meet
each block as a stream, so that memory is bounded; where blocks are few, the
queries of a block are dealt over several tasks.

Defined cases: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; an empty vector takes part and scores
zero; vectors of different lengths are compared over the components both have;
each row with a repeated id asks for itself and leaves out itself only, so the
answers of such an id repeat; fewer than k candidates are all returned; an
empty table gives an empty result; other columns are ignored. Components and
scores of any size are exact as long as they fit 64 bits; ArithmeticError (or
Spark's error of the same text) tells of one that does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.llm.common import shuffle_partitions

TOO_LARGE, LARGEST = "beyond 64 bits", (1 << 63) - 1
SCALE = 64
#: Rows of a block, and queries whose scores are added up at once.
BLOCK_ROWS = 16_384
BATCH = 32
#: Bytes of multiples that a block keeps.
MEMO = 96 << 20


def add(a: np.ndarray, b: np.ndarray, carry: np.ndarray | None = None) -> np.ndarray:
    """Sum of two stacks of slices (slice first, least significant first), as wide as ``a``; ``b`` is sign-extended."""
    out = np.empty(np.broadcast_shapes(a.shape, (a.shape[0], *b.shape[1:])), np.uint64)
    for i in range(a.shape[0]):
        x, y = a[i], b[min(i, b.shape[0] - 1)]
        either = x ^ y
        if carry is None:
            out[i], carry = either, x & y
        else:
            out[i] = either ^ carry
            carry = (x & y) | (either & carry)
    return out


class Index:
    """Bit slices of a block's rows; ``values`` are (rows, attributes), ids ascending."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, sizes: np.ndarray):
        order = np.lexsort((*values.T[::-1], ids))
        self.ids, self.values, self.sizes = ids[order], values[order], sizes[order]
        self.rows, self.words = len(ids), -(-len(ids) // 64)
        self.memo: dict[tuple[int, int], np.ndarray] = {}
        self.held = 0

    def slices(self, attribute: int) -> np.ndarray:
        """An attribute's bitmaps, as few as its values need with a sign."""
        own = self.values[:, attribute]
        width = max(abs(int(own.min())), abs(int(own.max())) + 1).bit_length() + 1
        bits = np.zeros((width, self.words * 64), np.uint8)
        bits[:, : self.rows] = (own[None, :] >> np.arange(width)[:, None]) & 1
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def multiple(self, attribute: int, factor: int) -> np.ndarray:
        """Slices of ``factor`` times an attribute, by shifts and additions."""
        key = (attribute, factor)
        if key in self.memo:
            return self.memo[key]
        base = self.slices(attribute) if factor == 1 else self.multiple(attribute, 1)
        if factor == 1:
            out = base
        elif factor == 0:
            out = np.zeros((1, self.words), np.uint64)
        else:
            width = base.shape[0] + abs(factor).bit_length() + 1
            out = np.zeros((width, self.words), np.uint64)
            for i in range(abs(factor).bit_length()):
                if abs(factor) >> i & 1:
                    shifted = np.zeros((width, self.words), np.uint64)
                    shifted[i:] = base[np.minimum(np.arange(width - i), base.shape[0] - 1)]
                    out = add(out, shifted)
            if factor < 0:  # two's complement: all bits turned, and one
                out = add(~out, np.zeros((1, self.words), np.uint64), np.full(self.words, ~np.uint64(0)))
        if self.held + out.nbytes > MEMO:
            self.memo, self.held = {k: v for k, v in self.memo.items() if k[1] == 1}, 0
        self.memo[key] = out
        self.held += out.nbytes
        return out

    def most(self, queries: np.ndarray) -> int:
        """A bound on the size of any score or partial sum."""
        if not queries.size or not self.values.size:
            return 0
        largest = lambda x: [max(abs(int(a)), abs(int(b))) for a, b in zip(x.min(axis=0), x.max(axis=0), strict=True)]
        return sum(a * b for a, b in zip(largest(queries), largest(self.values), strict=True))

    def scores(self, queries: np.ndarray) -> np.ndarray:
        """Slices of the scores: (slice, query, word)."""
        total = np.zeros((self.most(queries).bit_length() + 1, len(queries), self.words), np.uint64)
        for a in range(queries.shape[1]):
            factors, which = np.unique(queries[:, a], return_inverse=True)
            parts = [self.multiple(a, int(f)) for f in factors]
            width = min(max(len(p) for p in parts), len(total))
            stack = np.stack([p[np.minimum(np.arange(width), len(p) - 1)] for p in parts], axis=1)
            total = add(total, stack[:, which])
        return total

    def top(self, query_ids: np.ndarray, queries: np.ndarray, sizes: np.ndarray, k: int) -> Iterator[tuple[int, int, int, int]]:
        """(query, row id, score, whether the row is the query's own or its copy) of each query's k best rows, ties to smaller ids."""
        width = min(queries.shape[1], self.values.shape[1])
        part = self if width == self.values.shape[1] else Index(self.ids, self.values[:, :width], self.sizes)
        asked = queries[:, :width]
        score, narrow = part.scores(asked), part.most(asked).bit_length() < 63
        tied = np.zeros((len(queries), part.words * 64), np.uint8)
        tied[:, : part.rows] = 1
        tied = np.packbits(tied, axis=1, bitorder="little").view(np.uint64)
        sure = np.zeros_like(tied)
        count = lambda x: np.bitwise_count(x).sum(axis=1, dtype=np.int64)
        for i in range(len(score) - 1, -1, -1):
            ones = ~score[i] if i == len(score) - 1 else score[i]  # the sign's slice: larger scores have zeros there
            high = tied & ones
            few = (count(sure) + count(high) < k)[:, None]
            sure = np.where(few, sure | high, sure)
            tied = np.where(few, tied & ~ones, high)
        for q in range(len(queries)):
            bits = [np.flatnonzero(np.unpackbits(x[q].view(np.uint8), bitorder="little")) for x in (sure, tied)]
            rows = np.concatenate([bits[0], bits[1][: k - len(bits[0])]])
            exact = (part.values[rows] @ asked[q] if narrow else part.values[rows].astype(object) @ asked[q].astype(object)) if width else np.zeros(len(rows), np.int64)
            own = (part.ids[rows] == query_ids[q]) & (part.sizes[rows] == sizes[q])
            if own.any():
                own &= (part.values[rows] == asked[q]).all(axis=1) & (sizes[q] <= width)
            for row, value, same in zip(rows.tolist(), exact.tolist(), own.tolist(), strict=True):
                if not -LARGEST <= value < LARGEST and not same:
                    raise ArithmeticError(f"a score is {TOO_LARGE}")
                yield q, int(part.ids[row]), min(value, LARGEST), int(same)  # a query's own score may be any


def _matrix(values: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Rows side by side in ``values`` as a matrix, cut or filled with zeros."""
    out = np.zeros((len(sizes), width), np.int64)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < width
    out[np.repeat(np.arange(len(sizes)), sizes)[inside], place[inside]] = values[inside]
    return out


def _search(k: int):
    """One cell's rows (asks, vec_id, q, ask, copies), candidates first → (ask, query_id, copies, vec_id, score, own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        parts: list[Index] | None = None

        def built() -> list[Index]:
            """The cell's indexes: one, or several of bounded size."""
            made = []
            if held:
                ids, sizes, values = (np.concatenate(x) for x in zip(*held, strict=True))
                ends = np.cumsum(sizes)
                for at in range(0, len(ids), BLOCK_ROWS):
                    own = slice(at, at + BLOCK_ROWS)
                    first = int(ends[at] - sizes[at])
                    made.append(Index(ids[own], _matrix(values[first : int(ends[own][-1])], sizes[own], int(sizes[own].max())), sizes[own]))
                held.clear()
            return made

        for b in batches:
            asks, keys = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            lists = b.column(2)
            sizes, values = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)
            n, ends = int((asks == 0).sum()), np.cumsum(sizes)
            if n:
                held.append((keys[:n], sizes[:n], values[: int(ends[n - 1])]))
            found: list[tuple] = []
            for at in range(n, len(keys), BATCH):
                parts = built() if parts is None else parts
                own = slice(at, at + BATCH)
                first = int(ends[at] - sizes[at])
                asked = values[first : int(ends[own][-1])]
                names, copies = b.column(3)[own].to_pylist(), b.column(4)[own].to_pylist()
                for index in parts:
                    for q, row, score, same in index.top(keys[own], _matrix(asked, sizes[own], index.values.shape[1]), sizes[own], k + 1):
                        found.append((names[q], int(keys[at + q]), copies[q], row, score, same))
            columns = list(zip(*found, strict=True)) or [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["ask", "query_id", "copies", "vec_id", "score", "own"])

    return run


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vectors(vec_id, embedding)`` → ``(vec_id, q)`` with whole components, of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    whole = lambda v: F.floor(v * F.lit(float(scale)))
    q = F.transform(x, lambda v: F.when(bad(v), 0).when(F.abs(v) < F.lit(2.0**62 / scale), whole(v)).otherwise(F.raise_error(F.lit(f"a component is {TOO_LARGE}")).cast("long")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~F.exists(x, bad)).select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def top_k(vectors: DataFrame, asks: Column, k: int = 20, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k best other rows of each row for which ``asks`` (a condition on ``vec_id``) holds: query_id, rank, vec_id, score."""
    rows = quantised(vectors, scale)
    n_rows, n_asking = rows.agg(F.count("*"), F.count_if(asks)).first()
    blocks = max(1, -(-n_rows // block_rows))
    # a cell is a block and a part of the queries: as many as there are partitions, unless blocks are more or queries few
    shares = max(1, min(-(-shuffle_partitions(vectors.sparkSession) // blocks), n_asking // (4 * BATCH)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n, *keys: F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    # dealt by id and place, so that an id that repeats fills no block of its own
    dealt = rows.select(part(blocks, F.col("vec_id"), F.monotonically_increasing_id()).alias("block"), every(shares).alias("share"), F.lit(0).alias("asks"), "vec_id", "q", F.lit(None).cast("string").alias("ask"), F.lit(0).cast("long").alias("copies"))
    queries = rows.where(asks).groupBy("vec_id", "q").agg(F.count("*").alias("copies"))
    queries = queries.withColumn("ask", F.concat_ws("/", "vec_id", F.md5(F.array_join(F.col("q").cast("array<string>"), ",").cast("binary"))))
    meets = queries.select(every(blocks).alias("block"), part(shares, F.col("ask")).alias("share"), F.lit(1).alias("asks"), "vec_id", "q", "ask", "copies")
    cells = dealt.unionByName(meets).repartitionById(blocks * shares, F.col("block") * shares + F.col("share")).sortWithinPartitions("asks", "vec_id", "ask")
    found = cells.select("asks", "vec_id", "q", "ask", "copies").mapInArrow(_search(k), "ask string, query_id long, copies long, vec_id long, score long, own int")
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    # the first row that is the query's own is the query itself
    ranked = ranked.withColumn("selves", F.sum("own").over(best.rowsBetween(Window.unboundedPreceding, 0)))
    score = F.when((F.col("own") == 1) & (F.col("score") == LARGEST), F.raise_error(F.lit(f"a score is {TOO_LARGE}")).cast("long")).otherwise(F.col("score"))
    others = ranked.where("NOT (own = 1 AND selves = 1)").withColumn("score", score).withColumn("rank", (F.col("rank") - F.least("selves", F.lit(1))).cast("int")).where(F.col("rank") <= k)
    repeats = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return others.select("query_id", "rank", "vec_id", "score", repeats.alias("_")).drop("_")
