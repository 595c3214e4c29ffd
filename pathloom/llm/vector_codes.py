"""Compressing vectors to codes: k-means codebooks for parts of vectors, assigned by exponion search in whole numbers.

A component x is floor(scale * x); a vector is cut into equal consecutive parts, and each part position has
a codebook. A part's search starts at its entry of the round before, a. An entry j that is as near as a has
|c_j - c_a| <= |c_j - x| + |x - c_a| <= 2 |x - c_a|, so that only the entries within that radius around c_a can
win or tie: a's neighbours are scanned in order of their distance while D(a, j) <= 4 d(x, a), both squared, and no
further. Rows with the same start and like distances share the radius of the farthest among them. All distances are
whole numbers, ties go to the lower index, and nothing is pruned that could tie.

A round is one scan of the table. It sends out counts and component sums per part and entry, from which the
next codebooks follow on the driver: their number is a parameter, whatever the table's size. A row's entry of the round
before is not stored: the codebooks of the earlier rounds travel with the task, which walks a part through them, each
search starting where the last one ended. For ``rounds`` rounds that is about rounds / 2 short searches a scan and no
table written; storing entries would write all vectors once a round.

Cases: vectors that are null or hold null or non-finite components take no part; null ids and repeated ids are
rows like others (null ids come last among the first entries, equal ids by their vectors); with fewer
rows than entries the codebooks have as many entries as there are rows; an empty table gives no rows. Vectors of
unequal length, or of one that the parts do not divide, are a ValueError, as are components whose distances
do not fit 64 bits. Other columns of the table are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import in_parts

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Rows of one start that share a radius.
BLOCK = 256


@dataclass
class Codebook:
    """The entries of one part position, with each entry's neighbours in order of distance, itself first."""

    entries: np.ndarray
    near: np.ndarray = field(init=False)
    apart: np.ndarray = field(init=False)
    norms: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        gaps = self.entries[:, None, :] - self.entries[None, :, :]
        d = (gaps * gaps).sum(axis=2)
        np.fill_diagonal(d, -1)  # an entry leads its own list, also where another is equal to it
        self.near = np.argsort(d, axis=1, kind="stable")
        self.apart = np.take_along_axis(d, self.near, axis=1)
        self.norms = (self.entries * self.entries).sum(axis=1)

    def search(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry of each row of ``x``, its squared distance, and how many distances were taken.

        Rows with one start go in blocks, the farthest from it first; a block scans the start's list inside the radius of its first row.
        """
        norms = np.einsum("ij,ij->i", x, x)
        own = norms - 2 * np.einsum("ij,ij->i", x, self.entries[start]) + self.norms[start]
        order = np.lexsort((-own, start))
        ends = np.searchsorted(start[order], np.arange(len(self.entries) + 1))
        best, least, taken = start.copy(), own.copy(), len(x)
        for a in np.flatnonzero(np.diff(ends)):
            for at in range(ends[a], ends[a + 1], BLOCK):
                rows = order[at : min(at + BLOCK, ends[a + 1])]
                inside = int(np.searchsorted(self.apart[a], 4 * own[rows[0]], side="right"))
                if inside > 1:
                    entries = np.sort(self.near[a, :inside])  # in order, so that the first of equal distances is the lower entry
                    d = norms[rows, None] - 2 * (x[rows] @ self.entries[entries].T) + self.norms[entries]
                    place = d.argmin(axis=1)
                    best[rows], least[rows] = entries[place], d[np.arange(len(rows)), place]
                    taken += d.size
        return best, least, taken


Books = list[Codebook]


def walk(x: np.ndarray, history: list[Books]) -> tuple[np.ndarray, np.ndarray]:
    """Entries and squared distances of all parts of ``x`` (rows, parts, width) after searches through all rounds' codebooks."""
    code = np.zeros(x.shape[:2], np.int64)
    error = np.zeros(x.shape[:2], np.int64)
    for books in history:
        for p, book in enumerate(books):
            code[:, p], error[:, p], _ = book.search(x[:, p], code[:, p])
    return code, error


def floors(vectors: pa.Array, scale: int) -> np.ndarray:
    """Vectors of one length as whole numbers, a row each."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(values * scale)
    if len(x) and np.abs(x).max() >= 1 << 62:
        raise ValueError("components are too large for exact distances")
    return x.astype(np.int64).reshape(len(sizes), -1)


def fitting(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null and has finite components only."""
    v = F.col(vector).cast("array<double>")
    return df.where(v.isNotNull() & ~F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True))))


def _check(df: DataFrame, parts: int, scale: int) -> int:
    """The length of the vectors; ValueError if they differ, do not fall into parts, or have components that are too large."""
    largest = F.max(F.array_max(F.transform("v", lambda x: F.abs(F.floor(x * scale).cast("double")))))
    low, high, most = df.agg(F.min(F.size("v")), F.max(F.size("v")), largest).first()
    if low is None:
        return 0
    if low != high or not low or low % parts:
        raise ValueError(f"vectors have {low} to {high} components, which are not {parts} equal parts")
    if 4 * (low // parts) * (2 * int(most or 0) + 2) ** 2 >= 1 << 63:
        raise ValueError("components are too large for exact distances")
    return low


def _sums(df: DataFrame, history: list[Books], scale: int, parts: int) -> DataFrame:
    """(part, entry, dim, n, total) of the rows by their entries after ``history``; a task sends a row per component of a codebook."""
    entries, width = len(history[0][0].entries), history[0][0].entries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), object)
        for b in batches:
            if not b.num_rows:
                continue
            x = floors(b.column(0), scale).reshape(b.num_rows, parts, width)
            code, _ = walk(x, history)
            for p in range(parts):
                n[p] += np.bincount(code[:, p], minlength=entries)
                order = np.argsort(code[:, p], kind="stable")
                used, first = np.unique(code[order, p], return_index=True)
                total[p, used] += np.add.reduceat(x[order, p], first, axis=0)
        if n.any():
            p, e, d = (z.ravel() for z in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(d), pa.array(np.repeat(n.ravel(), width)), pa.array([str(int(z)) for z in total.ravel()])], names=["part", "entry", "dim", "n", "total"])

    made = df.select("v").mapInArrow(in_parts(run, 4096), "part long, entry long, dim long, n long, total string")
    return made.groupBy("part", "entry", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def _moved(books: Books, sums: DataFrame) -> Books:
    """Codebooks whose entries are the floors of their parts' means; entries without parts stay."""
    new = [b.entries.copy() for b in books]
    for r in sums.collect():  # a row per component of a codebook
        if r.n:
            new[r.part][r.entry, r.dim] = int(r.total) // int(r.n)
    return [Codebook(e) for e in new]


def first_books(df: DataFrame, entries: int, parts: int, scale: int) -> Books:
    """Codebooks of the parts of the vectors with the smallest ids."""
    rows = [[int(z) for z in r.x] for r in df.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select(F.transform("v", lambda x: F.floor(x * scale)).alias("x")).collect()]
    x = np.array(rows, np.int64).reshape(len(rows), parts, -1)
    return [Codebook(x[:, p].copy()) for p in range(parts)]


def fit(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Books]:
    """The codebooks of all rounds, the first ones before any; empty without vectors."""
    df = fitting(vectors, vector).select(F.col(id_).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    if not _check(df, parts, scale):
        return []
    history = [first_books(df, entries, parts, scale)]
    for _ in range(rounds):
        history.append(_moved(history[-1], _sums(df, history, scale, parts)))
    return history


def encode(vectors: DataFrame, history: list[Books], keep: list[str], vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Columns ``keep`` with ``code`` (a byte per part, as binary) and ``error``, the squared distances summed over parts."""
    df = fitting(vectors, vector).select(*keep, F.col(vector).cast("array<double>").alias("__v"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    if not history:
        return df.select(*keep, F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    parts = len(history[0])
    if len(history[0][0].entries) > 256:
        raise ValueError("a code has a byte per part, so a codebook has 256 entries at most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = floors(b.column(b.num_columns - 1), scale).reshape(b.num_rows, parts, -1)
                code, error = walk(x, history)
                codes = pa.array([row.tobytes() for row in code.astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], codes, pa.array(error.sum(axis=1))], names=[*keep, "code", "error"])

    return df.mapInArrow(in_parts(run, 4096), f"{kinds}, code binary, error long")


def numbers(books: Books) -> str:
    """All components of codebooks as text, by part, entry and place, with commas between."""
    return ",".join(str(int(z)) for b in books for z in b.entries.ravel())


def digest(books: Books) -> str:
    return hashlib.sha256(numbers(books).encode()).hexdigest()


def decoded(code: Column, books: Books, scale: int = SCALE) -> Column:
    """The vector that a code stands for, from codebooks as literal arrays: the entries side by side, divided by ``scale``."""
    parts = [F.get(F.array(*(F.array(*(F.lit(float(z) / scale) for z in e)) for e in b.entries)), F.conv(F.hex(F.substring(code, p + 1, 1)), 16, 10).cast("int")) for p, b in enumerate(books)]
    return F.concat(*parts)
