"""SimHash near-duplicate groups through a byte-position inverted index.

Fingerprints: 64 bits over XXH64 hashes (seed 42) of word shingles, repeats
included. Two fingerprints that differ in at most three bits agree in at least
five of their eight byte positions. The postings of single bytes would pair
almost everything, so the index intersects postings four positions at a time:
a fixed system of four-subsets that has a member inside every five-subset, so
that each linked pair shares a posting. A pair of a posting has four matches
by that; its tally goes on over the other four positions, pairs that stay
below five are dropped, and only the rest is verified bit by bit. A posting
yields a star per component, never all its pairs. Postings that are long are
dealt anew by a fifth byte before the shuffle, and split on equal parts of their
free bits within a task, which loses no link. Components
of the stars are found with distributed star contractions.

Defined cases: null text is the empty text; a text without words has the
fingerprint zero and is linked like any other; null ``doc_id`` rows take part
and never become a component's id unless it has no other; repeated rows and
exact copies share a fingerprint and are indexed once; rows of one ``doc_id``
with different texts are rows of their own; an empty table gives an empty
result; other columns are ignored by ``near_duplicates`` and kept by
``deduplicate``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import cut, if_small, in_parts, key_groups, on_cores, shuffle_partitions, text_hash, texts_of, without_rows
from pathloom.llm.components import components

#: Linked at this many differing bits or fewer.
MAX_BITS = 3
#: Shared positional bytes that MAX_BITS guarantees.
LEAST_SHARED = 8 - MAX_BITS
#: A fingerprint of more than one in so many rows is hot.
HOT_SHARE = 1000
#: Postings up to this length are compared pair by pair at once.
BLOCK = 1024
#: Postings that should be longer than this, by one fingerprint in SAMPLE, are split before the shuffle.
LONG, SAMPLE = 65_536, 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of one UTF-8 text: words are runs of anything but ASCII white space, A-Z lowered."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    n = len(words) - width + 1
    return of_hashes(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, n))


def of_hashes(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero without any."""
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs(doc_id, text)`` → ``(doc_id, text_hash, fp)``, ``fp`` as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t, shingle) for t in texts_of(b.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_hash(), F.col("text").cast("binary")).mapInArrow(in_parts(run), "doc_id long, text_hash long, fp long")


@cache
def covering_quads() -> list[tuple[int, ...]]:
    """Four-subsets of the eight byte positions such that each five-subset contains one; greedy, so the same everywhere."""
    left, quads = {frozenset(x) for x in combinations(range(8), LEAST_SHARED)}, []
    while left:
        best = max(combinations(range(8), 4), key=lambda q: (sum(set(q) <= x for x in left), q))
        quads.append(best)
        left = {x for x in left if not set(best) <= x}
    return quads


def _keys(fp: str) -> list[Column]:
    keys = []
    for i, quad in enumerate(covering_quads()):
        key = F.lit(i).cast("long")
        for p in quad:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(F.col(fp), 8 * p).bitwiseAND(F.lit(255).cast("long")))
        keys.append(key)
    return keys


def _linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs are linked: positions that agree are tallied, and bits counted only where the tally suffices."""
    apart = a ^ b
    out = (apart.view(np.uint8).reshape(*apart.shape, 8) == 0).sum(axis=-1) >= LEAST_SHARED
    out[out] = np.bitwise_count(apart[out]) <= MAX_BITS
    return out


def _stars(fps: np.ndarray, free: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect the distinct ``fps`` just as all their links do; they can differ only in the bits ``free``."""
    n = len(fps)
    if n < 2:
        return
    if len(free) <= MAX_BITS:
        yield np.broadcast_to(fps[:1], n - 1), fps[1:]
    elif n <= BLOCK:
        near = _linked(fps[:, None], fps[None, :])
        label = np.arange(n)
        while True:
            new = np.where(near, label[None, :], n).min(axis=1)
            new = new[new]
            if (new == label).all():
                break
            label = new
        joined = np.flatnonzero(label != np.arange(n))
        yield fps[label[joined]], fps[joined]
    else:  # of MAX_BITS + 1 parts of the free bits, one is equal in each linked pair
        for part in np.array_split(np.array(free, np.uint64), MAX_BITS + 1):
            mask = np.bitwise_or.reduce(np.uint64(1) << part)
            order = np.argsort(fps & mask, kind="stable")
            ends = np.flatnonzero(np.diff(fps[order] & mask)) + 1
            rest = tuple(x for x in free if x not in set(part.tolist()))
            for group in np.split(fps[order], ends):
                yield from _stars(group, rest)


FURTHER = 1 << 40  # a key with a fifth position: this bit, the position in bits 41 to 43, its byte from bit 44 on


def _fixed(k: int) -> tuple[int, ...]:
    """The byte positions that are equal in a posting."""
    quad = covering_quads()[k >> 32 & 255]
    return (*quad, k >> 41 & 7) if k & FURTHER else quad


def _further(fp: str, k: str) -> Column:
    """The keys of a long posting with one byte more: of the four other positions, three bits or fewer leave one equal."""
    quad = F.shiftrightunsigned(k, 32)
    byte = lambda p: F.shiftrightunsigned(F.col(fp), 8 * p).bitwiseAND(F.lit(255).cast("long"))
    more = lambda p: F.col(k).bitwiseOR(F.lit(FURTHER | p << 41)).bitwiseOR(F.shiftleft(byte(p), 44))
    out = F.array().cast("array<bigint>")
    for i, own in enumerate(covering_quads()):
        out = F.when(quad == i, F.array(*(more(p) for p in range(8) if p not in own))).otherwise(out)
    return out


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, fp) sorted by k → edges (u, v). Short postings are compared all at once, by distance in the order."""
    for k, raw in key_groups(batches):
        fp = raw.view(np.uint64)
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        size = np.diff(np.append(start, len(k)))
        left, right = [], []
        long = size > 16
        short = np.repeat(~long, size)
        ks, fs = k[short], fp[short]
        for gap in range(1, 16):
            same = np.flatnonzero(ks[gap:] == ks[:-gap])
            if not len(same):
                break
            a, b = fs[same], fs[same + gap]
            hit = _linked(a, b)
            left.append(a[hit]), right.append(b[hit])
        for s, n in zip(start[long], size[long], strict=True):
            for a, b in _stars(np.unique(fp[s : s + n]), tuple(i for i in range(64) if i // 8 not in _fixed(int(k[s])))):
                left.append(a), right.append(b)
        if left and sum(map(len, left)):
            u, v = np.concatenate(left), np.concatenate(right)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])


def links(prints: DataFrame, long: int = LONG, sample: int = SAMPLE) -> DataFrame:
    """Edges (u, v) over the distinct ``prints(fp)``, spanning every group of linked fingerprints.

    Postings that should be longer than ``long``, by one fingerprint in ``sample``, are dealt anew by a fifth byte before the shuffle.
    The sample only decides where a posting is split; one that it misses is split within its task.
    """
    n = shuffle_partitions(prints.sparkSession)
    index = prints.select("fp", F.explode(F.array(*_keys("fp"))).alias("k")).select("k", "fp")
    hot = cut(index.where(F.pmod(F.xxhash64("fp"), F.lit(sample)) == 0).groupBy("k").count().where(F.col("count") * sample > long).select("k"))
    if not on_cores(hot).isEmpty():
        hot = if_small(hot)
        further = index.join(hot, "k", "left_semi").select(F.explode(_further("fp", "k")).alias("k"), "fp")
        index = index.join(hot, "k", "left_anti").unionByName(further)
    index = index.repartition(n, "k").sortWithinPartitions("k")
    return index.mapInArrow(_postings, "u long, v long")


def _grouped(prints: DataFrame) -> DataFrame:
    """``prints(…, fp)`` with the ``component_id`` of each row; ``prints`` is read more than once."""
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")))
    roots = components(links(classes.select("fp"))).withColumnRenamed("node", "fp")
    grouped = roots.join(classes, "fp")
    least = grouped.groupBy("root").agg(F.min("first_id").alias("least_id"))
    named = grouped.join(least, "root").select("fp", "least_id")
    named = cut(classes.join(named, "fp", "left").select("fp", "n", F.coalesce("least_id", "first_id").alias("component_id")))
    # fewer than HOT_SHARE fingerprints can have more than that part of the rows: their rows are not dealt by fingerprint
    total = named.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(named.where(F.col("n") * HOT_SHARE > total).select("fp", "component_id"))
    rest = prints.join(hot, "fp", "left_anti").join(named.select("fp", "component_id"), "fp")
    return prints.join(hot, "fp").unionByName(rest)


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs(doc_id, text)`` → ``(doc_id, fp, component_id)``, one row per row of ``docs``."""
    return _grouped(cut(fingerprints(docs, shingle))).select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` without the rows whose group has a row with a smaller ``doc_id``.

    Columns are those of ``docs``. Rows that repeat one ``doc_id`` and its text stay or go together; rows without a ``doc_id`` stay.
    """
    gone = _grouped(cut(fingerprints(docs, shingle))).where("doc_id <> component_id")
    return without_rows(docs, gone.select("doc_id", "text_hash"))
