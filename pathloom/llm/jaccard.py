"""The five-word form of the near-duplicate operator: sets of shingles with an exact Jaccard of 4/5 or more.

The byte-position index with its count filter (``simhash.links``) goes first,
on one fingerprint per set; what it links is verified on the whole sets and
joined. Fingerprints of 64 bits cannot tell all pairs (a Jaccard of 4/5 leaves
most some ten bits apart), so an exact way follows for the rest: the same scheme
over shingles, post, tally, retain what can reach the guaranteed minimum of
matches, verify, for pairs that the first index has not yet joined.

Two sets with a Jaccard of 4/5 or more share at least ceil(4n/5) members of
either, so in any one order of all shingles the first n - ceil(4n/5) + 1
members of both have one in common. Those prefixes are the postings. A pair of
a posting is retained if its sizes and places still allow the minimum; then
its sketches are compared, which count the members of each set by some bits of
their hashes: no more can be shared than the lesser counts add up to. What can
still reach the minimum is verified on the whole sets. No pair at 4/5 or above
is left out. The order only decides how long postings get: shingles that are
frequent in a sample come last.

Of a posting of more than BLOCK sets, PIVOTS are first paired with all others,
and neighbours by size with each other. Pivots are the sets that have the
fewest rarer shingles than the posting's own: in a group of copies those with
the fewest changes, and the same ones in all its postings. Once these pairs are
verified, all pairs between different components follow, so that a large group
costs little more than its members.

Postings that the sample says are longer than WIDE are dealt before the shuffle: their
pivots are found by partial minima, and what is then in other components than
the posting's largest one is paired in cells, a block of sets with another of
the same or a neighbouring size class, so that no task holds or pairs more
than two blocks. The sample only decides which way a posting goes.

A set is known by 128 bits of its hash. Node numbers have 64 of them; sets that
share these and not the others, if there are any, get numbers of their own.

Defined cases: texts below five words are one shingle; null text and texts
without words have the empty set and are copies of one another; null
``doc_id`` rows take part and stay; repeated rows and equal sets are one set;
rows of one ``doc_id`` with different texts are rows of their own; other
columns are kept by ``deduplicate``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.llm import simhash
from pathloom.llm.common import cut, if_small, in_few, in_parts, key_groups, on_cores, shuffle_partitions, text_hash, texts_of, without_rows
from pathloom.llm.components import components

#: Postings up to this length give all their pairs at once; of longer ones so many sets are first paired with all.
BLOCK = 4
PIVOTS = 4
#: Members of a set per count of its sketch, about.
PER_COUNT = 4
#: Postings that should be longer than this, by the sample, are dealt in cells of blocks of so many sets.
WIDE, CELL = 1_024, 1_024
#: Pairs that one task compares, about; no fewer tasks than cores.
CHECKED = 4_096
#: One in so many documents is read for the order, of which so many shingles are kept.
SAMPLE, FREQUENT = 16, 200_000


def shingles(text: bytes, shingle: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 hashes (seed 42) of the word shingles; words as in ``simhash``."""
    words = text.lower().split()
    width = min(shingle, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, len(words) - width + 1))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _signature(found: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """Two halves of a hash of 128 bits; the first one may be cut to fewer bits, for tests."""
    whole = xxhash.xxh3_128_intdigest(found.tobytes(), 42)
    return whole & ((1 << bits) - 1), whole >> 64


def _signatures(sets: list[np.ndarray], bits: int) -> list[pa.Array]:
    both = [_signature(x, bits) for x in sets]
    return [_signed(np.array([b[i] for b in both], np.uint64)) for i in range(2)]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def sketch(found: np.ndarray) -> np.ndarray:
    """How many members have which low bits: a power of two of counts that a byte holds."""
    bits = max(0, (len(found) // PER_COUNT).bit_length() - 1)
    while True:
        counts = np.bincount((found & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
        if counts.max() < 256:
            return counts.astype(np.uint8)
        bits += 1


def most_shared(a: np.ndarray, b: np.ndarray) -> int:
    """A bound on the members that the sets of two sketches share."""
    width = min(len(a), len(b))
    a, b = (x.reshape(-1, width).sum(axis=0, dtype=np.int64) for x in (a, b))
    return int(np.minimum(a, b).sum())


def frequent(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the shingles that a sample holds most often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts_of(b.column(1)):
                yield pa.RecordBatch.from_arrays([_signed(shingles(t, shingle))], names=["h"])

    part = _texts(docs).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).mapInArrow(in_parts(run), "h long")
    rows = part.groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(FREQUENT).collect()
    rows = sorted((r["h"] % (1 << 64), r["count"]) for r in rows)
    return np.array([h for h, _ in rows], np.uint64), np.array([c for _, c in rows], np.int64)


def prefixes(docs: DataFrame, shingle: int, known: tuple[np.ndarray, np.ndarray], bits: int = 64) -> DataFrame:
    """``(doc_id, text_hash, sig, more, n, fp, sketch, prefix)``: both halves of a set's hash, its size, fingerprint and sketch, and the members in its prefix, in the order of ``known``."""
    order = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = order.value
        for b in batches:
            sets, sizes, prints, sketches, firsts = [], [], [], [], []
            for t in texts_of(b.column(2)):
                found = shingles(t, shingle)
                n = len(found)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                    first = found[np.argsort(np.where(hashes[at] == found, counts[at], 0), kind="stable")]
                else:
                    first = found
                sets.append(found), sizes.append(n), prints.append(simhash.of_hashes(found)), sketches.append(sketch(found).tobytes()), firsts.append(first[: n - -(-4 * n // 5) + 1].tobytes())
            columns = [b.column(0), b.column(1), *_signatures(sets, bits), pa.array(sizes, pa.int32()), _signed(np.array(prints, np.uint64)), pa.array(sketches, pa.binary()), pa.array(firsts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "sig", "more", "n", "fp", "sketch", "prefix"])

    rows = docs.select(F.col("doc_id").cast("long"), text_hash(), F.col("text").cast("binary"))
    return rows.mapInArrow(in_parts(run), "doc_id long, text_hash long, sig long, more long, n int, fp long, sketch binary, prefix binary")


def told_apart(rows: DataFrame, alike: DataFrame | None) -> DataFrame:
    """``rows(sig, more, …)`` without ``more``; a ``sig`` in ``alike``, which different sets share, is replaced by one of both halves."""
    if alike is None:
        return rows.drop("more")
    marked = rows.join(if_small(alike.withColumn("__alike", F.lit(True))), "sig", "left")
    return marked.withColumn("sig", F.when(F.col("__alike"), F.xxhash64("sig", "more")).otherwise(F.col("sig"))).drop("more", "__alike").select(*(c for c in rows.columns if c != "more"))


def shared_signatures(rows: DataFrame) -> DataFrame | None:
    """The signatures of ``rows(sig, more)`` that different sets share, None if there are none, as is to be expected."""
    alike = cut(rows.groupBy("sig").agg(F.min("more").alias("a"), F.max("more").alias("b")).where("a <> b").select("sig"))
    return None if on_cores(alike).isEmpty() else alike


def _exploded(batches: Iterator[pa.RecordBatch], wide: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (sig, n, prefix) → postings (k, ni, sig, wide): a set's size and the member's place in one number, and whether k is in ``wide``, which is sorted."""
    seen: set[int] = set()
    for b in batches:
        # equal sets of a task are posted once; those of other tasks meet in the postings
        fresh = [x not in seen and not seen.add(x) for x in b.column(0).to_pylist()]
        b = b.filter(pa.array(fresh, pa.bool_()))
        members = [np.frombuffer(x, np.int64) for x in b.column(2).to_pylist()]
        sizes = np.array([len(m) for m in members], np.int64)
        if sizes.sum():
            k, i = np.concatenate(members), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            sig, n = (np.repeat(b.column(c).to_numpy(zero_copy_only=False), sizes) for c in (0, 1))
            ni = n.astype(np.int64) << 32 | i
            among = wide[np.minimum(np.searchsorted(wide, k), len(wide) - 1)] == k if len(wide) else np.zeros(len(k), bool)
            for at in range(0, len(k), 1 << 16):
                s = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(k[s]), pa.array(ni[s]), pa.array(sig[s]), pa.array(among[s])], names=["k", "ni", "sig", "wide"])


def _unpacked(ni: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ni >> 32, ni & 0xFFFFFFFF


def _may(n: np.ndarray, i: np.ndarray, a, b) -> np.ndarray:
    """Whether sets a and b, of which no earlier member is shared, can reach 4/5: 9 shared >= 4 (n_a + n_b)."""
    return 9 * np.minimum(n[a] - i[a], n[b] - i[b]) >= 4 * (n[a] + n[b])


_PAIRS = "u long, v long, k long, ni long, sig long"
_NAMES = [x.split()[0] for x in _PAIRS.split(", ")]


def _pair_batch(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(u), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), none, none, none], names=_NAMES)


def _first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by (k, ni, sig) → pairs (u, v); of long ones those of their pivots and neighbours, and their own rows again."""
    for k, ni, sig in key_groups(batches):
        once = np.concatenate([[True], (k[1:] != k[:-1]) | (sig[1:] != sig[:-1])])
        k, ni, sig = k[once], ni[once], sig[once]
        n, i = _unpacked(ni)
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        size = np.diff(np.append(start, len(k)))
        long = np.repeat(size > BLOCK, size)
        short = np.flatnonzero(~long & np.repeat(size > 1, size))
        for gap in range(1, BLOCK):
            a, b = short[:-gap], short[gap:]
            same = k[a] == k[b]
            if not same.any():
                break
            a, b = a[same], b[same]
            may = _may(n, i, a, b)
            if may.any():
                yield _pair_batch(sig[a[may]], sig[b[may]])
        if long.any():
            at = np.flatnonzero(long)
            # places in each posting by how far ahead of the shingle a set has rarer ones: those with least are the most common of their kind
            order = at[np.lexsort((sig[at], i[at], k[at]))]
            first = np.repeat(np.flatnonzero(np.concatenate([[True], k[order][1:] != k[order][:-1]])), size[size > BLOCK])
            for pivot in range(PIVOTS):
                a, b = order[first + pivot], order
                may = (np.arange(len(order)) > first + pivot) & _may(n, i, a, b)
                yield _pair_batch(sig[a[may]], sig[b[may]])
            a, b = at[:-1], at[1:]
            may = (k[a] == k[b]) & _may(n, i, a, b)
            yield _pair_batch(sig[a[may]], sig[b[may]])
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(k[at]), pa.array(ni[at]), pa.array(sig[at])], names=_NAMES)


def _rest_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, ni, sig, root) of long postings, sorted → all pairs between different roots."""
    for k, ni, sig, root in key_groups(batches):
        n, i = _unpacked(ni)
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        for s, e in zip(start, np.append(start[1:], len(k)), strict=True):
            if (root[s:e] == root[s]).all():
                continue
            for a in range(s, e - 1):
                # sorted by size: the last set that is not too large for this one
                b = np.arange(a + 1, a + 1 + int(np.searchsorted(n[a + 1 : e], 5 * n[a] // 4, side="right")))
                b = b[root[b] != root[a]]
                b = b[_may(n, i, a, b)]
                if len(b):
                    yield _pair_batch(np.broadcast_to(sig[a], len(b)), sig[b])


def long_postings(rows: DataFrame, wide: int) -> np.ndarray:
    """The members, sorted, whose postings should hold more than ``wide`` different sets, by one set in SAMPLE of ``rows(sig, n, prefix)``; the longest FREQUENT."""
    none = np.zeros(0, np.int64)
    part = rows.where(F.pmod(F.xxhash64("sig"), F.lit(SAMPLE)) == 0).select("sig", "n", "prefix").dropDuplicates(["sig"])
    postings = part.mapInArrow(in_parts(lambda batches: _exploded(batches, none)), "k long, ni long, sig long, wide boolean")
    counts = postings.groupBy("k").count().where(F.col("count") * SAMPLE > wide).orderBy(F.desc("count"), "k").limit(FREQUENT)
    return np.sort(np.array([r.k for r in counts.select("k").collect()], np.int64))


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, ni, sig) → for each k those of the PIVOTS sets with the fewest rarer shingles; a few rows per k are held."""
    held: dict[int, list[tuple[int, int, int]]] = {}
    for b in batches:
        for k, ni, sig in zip(*(c.to_pylist() for c in b.columns), strict=True):
            own = held.setdefault(k, [])
            own.append((ni & 0xFFFFFFFF, sig, ni))
            if len(own) > 64:
                held[k] = sorted(set(own))[:PIVOTS]
    rows = [(k, ni, sig) for k, own in held.items() for _, sig, ni in sorted(set(own))[:PIVOTS]]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["k", "ni", "sig"])


def _n(ni: str) -> Column:
    return F.shiftright(ni, 32)


def _left(ni: str) -> Column:
    """A set's members from its place in the posting on."""
    return _n(ni) - F.col(ni).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def pivot_pairs(wide: DataFrame) -> DataFrame:
    """Pairs (u, v) of the sets of long postings ``wide(k, ni, sig)`` with their postings' pivots."""
    parts = shuffle_partitions(wide.sparkSession)
    least = wide.mapInArrow(_least, "k long, ni long, sig long").repartition(parts, "k").mapInArrow(_least, "k long, ni long, sig long")
    pivots = if_small(cut(least.select("k", F.col("ni").alias("p_ni"), F.col("sig").alias("p_sig"))))
    rest = F.least(_left("ni"), _left("p_ni"))
    pairs = wide.join(pivots, "k").where((F.col("sig") != F.col("p_sig")) & (9 * rest >= 4 * (_n("ni") + _n("p_ni"))))
    return pairs.select(F.least("sig", "p_sig").alias("u"), F.greatest("sig", "p_sig").alias("v"))


def _cell_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, ni, sig, root, side) sorted by cell → pairs of its sides with different roots that can reach 4/5. Side 2 is both."""
    for cell, ni, sig, root, side in key_groups(batches):
        n, i = _unpacked(ni)
        start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        for s, e in zip(start, np.append(start[1:], len(cell)), strict=True):
            at = np.arange(s, e)
            others = at[side[s:e] != 0]
            for a in at[side[s:e] != 1]:
                b = others[root[others] != root[a]]
                b = b[_may(n, i, a, b)]
                if len(b):
                    yield _pair_batch(np.broadcast_to(sig[a], len(b)), sig[b])


def cell_pairs(wide: DataFrame, cell: int) -> DataFrame:
    """Pairs (u, v) of long postings ``wide(k, ni, sig, root)`` between different roots, no more than two blocks of ``cell`` sets in a task at once.

    Sets of the posting's largest root are not paired with one another. Size classes are by powers of 1.26, so sets whose sizes
    allow 4/5, a ratio of 1.25 at most, are in the same class or in neighbouring ones.
    """
    parts = shuffle_partitions(wide.sparkSession)
    counts = cut(wide.groupBy("k", "root").agg(F.count("*").alias("n")))
    largest = counts.groupBy("k").agg(F.max_by("root", F.struct("n", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1").select("k", "top")
    size_class = F.floor(F.log(F.greatest(_n("ni"), F.lit(1)).cast("double")) / float(np.log(1.26))).cast("int")
    rows = cut(wide.join(if_small(cut(largest)), "k").select("k", "ni", "sig", "root", size_class.alias("c"), (F.col("root") == F.col("top")).alias("top")))
    blocks = lambda own: F.ceil(F.count_if(own) / cell).cast("int")
    sizes = rows.groupBy("k", "c").agg(blocks(~F.col("top")).alias("o"), blocks(F.col("top")).alias("t"))
    sizes = sizes.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("c", F.struct("o", "t")))).alias("of"))
    rows = rows.join(if_small(cut(sizes)), "k")

    def every(kind: str, step: int) -> Column:
        n = F.coalesce(F.try_element_at("of", F.col("c") + step)[kind], F.lit(0))
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    own = F.try_element_at("of", F.col("c"))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("sig"), F.greatest(F.when(F.col("top"), own["t"]).otherwise(own["o"]), F.lit(1))).cast("int"))
    side = lambda kind, c1, b1, c2, b2, which: F.struct(F.xxhash64("k", F.lit(kind), c1, b1, c2, b2).alias("cell"), which.cast("int").alias("side"))
    c, b, zero, one = F.col("c"), F.col("b"), F.lit(0), F.lit(1)
    same = F.transform(every("o", 0), lambda x: side(0, c, F.least(b, x), c, F.greatest(b, x), F.when(b == x, 2).when(b < x, 0).otherwise(1)))
    up = F.transform(every("o", 1), lambda x: side(0, c, b, c + 1, x, zero))
    down = F.transform(every("o", -1), lambda x: side(0, c - 1, x, c, b, one))
    to_top = lambda d: F.transform(every("t", d), lambda x: side(1, c, b, c + d, x, zero))
    from_top = lambda d: F.transform(every("o", d), lambda x: side(1, c + d, x, c, b, one))
    with_top, of_top = [to_top(d) for d in (-1, 0, 1)], [from_top(d) for d in (-1, 0, 1)]
    cells = F.when(F.col("top"), F.concat(*of_top)).otherwise(F.concat(same, up, down, *with_top))
    dealt = rows.select("ni", "sig", "root", F.explode(cells).alias("x")).select("x.cell", "ni", "sig", "root", "x.side")
    return dealt.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(_cell_pairs, _PAIRS).select("u", "v").distinct()


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The ``pairs(u, v)``, which should be cut, whose sketches allow 4/5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(2, 6)]
            keep = [9 * most_shared(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) >= 4 * (m + n) for m, x, n, y in zip(*columns, strict=True)]
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left, right = (classes.select(F.col("sig").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}")) for k in "uv")
    both = _with_both(pairs, left, right, on_cores(pairs).count()).select("u", "v", "n_u", "s_u", "n_v", "s_v")
    return both.mapInArrow(in_parts(run), "u long, v long")


def _with_both(pairs: DataFrame, left: DataFrame, right: DataFrame, rows: int) -> DataFrame:
    """The ``pairs(u, v)``, so many ``rows``, with what ``left(u, …)`` and ``right(v, …)`` have once for each node."""
    least = pairs.sparkSession.sparkContext.defaultParallelism
    first = in_few(in_few(pairs, rows).join(left, "u"), rows, CHECKED, least)
    return in_few(first.join(right, "v"), rows, CHECKED, least)


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, alike: DataFrame | None = None, bits: int = 64) -> DataFrame:
    """The ``pairs(u, v)`` of signatures whose sets have a Jaccard of 4/5 or more. Only the texts of such signatures are read as sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t, shingle) for t in texts_of(b.column(0))]
            yield pa.RecordBatch.from_arrays([*_signatures(found, bits), pa.array([x.tobytes() for x in found], pa.binary())], names=["sig", "more", "members"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep.append(9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y)))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    pairs = cut(likely(pairs, classes))
    rows = on_cores(pairs).count()
    nodes = if_small(cut(in_few(pairs, rows).select(F.explode(F.array("u", "v")).alias("sig")).distinct()))
    # a class is read from the rows of its first id, or from those without one
    ids = if_small(cut(classes.join(nodes, "sig", "left_semi").select("first_id").distinct()))
    texts = _texts(docs)
    near = texts.where("doc_id is not null").join(ids, F.col("doc_id") == F.col("first_id"), "left_semi").unionByName(texts.where("doc_id is null"))
    of = cut(told_apart(near.select("text").mapInArrow(in_parts(sets), "sig long, more long, members binary"), alike).join(nodes, "sig", "left_semi").dropDuplicates(["sig"]))
    left, right = of.select(F.col("sig").alias("u"), F.col("members").alias("x")), of.select(F.col("sig").alias("v"), F.col("members").alias("y"))
    return cut(_with_both(pairs, left, right, rows).select("u", "v", "x", "y").mapInArrow(in_parts(check), "u long, v long"))


def print_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (u, v) of the signatures of ``classes(sig, fp)`` that the byte-position index finds: each with the first of its fingerprint, and the first ones of linked fingerprints."""
    firsts = cut(classes.groupBy("fp").agg(F.min("sig").alias("first")))
    same = classes.select("fp", "sig").join(firsts, "fp").where("sig <> first").select(F.col("first").alias("u"), F.col("sig").alias("v"))
    left, right = (firsts.select(F.col("fp").alias(k), F.col("first").alias(f"s_{k}")) for k in "uv")
    near = cut(simhash.links(firsts.select("fp")).distinct())
    near = _with_both(near, left, right, on_cores(near).count())
    return cut(same.unionByName(near.select(F.least("s_u", "s_v").alias("u"), F.greatest("s_u", "s_v").alias("v"))).distinct())


def still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``pairs(u, v)`` that are not in one component of ``roots(node, root)``."""
    roots = if_small(roots)
    for k in "uv":
        pairs = pairs.join(roots.select(F.col("node").alias(k), F.col("root").alias(f"r_{k}")), k, "left")
    return pairs.where("r_u is null or r_v is null or r_u <> r_v").select("u", "v")


def links(docs: DataFrame, rows: DataFrame, classes: DataFrame, shingle: int, wide: np.ndarray | None = None, cell: int = CELL, alike: DataFrame | None = None, bits: int = 64) -> DataFrame:
    """Edges (u, v) over the signatures of ``rows(sig, n, prefix)`` that connect all pairs at 4/5 or above.

    Fingerprints come first, and the postings of shingles for what is not joined by them.
    ``wide`` are the shingles, sorted, whose postings are dealt before the shuffle.
    """
    spark = docs.sparkSession
    parts, wide = shuffle_partitions(spark), np.zeros(0, np.int64) if wide is None else wide
    shared = spark.sparkContext.broadcast(wide)
    check = lambda pairs: verified(docs, classes, pairs, shingle, alike, bits)
    by_print = print_pairs(classes)
    by_print = in_few(by_print, on_cores(by_print).count())
    linked = check(by_print)
    postings = rows.select("sig", "n", "prefix").mapInArrow(in_parts(lambda batches: _exploded(batches, shared.value)), "k long, ni long, sig long, wide boolean")
    far = cut(postings.where("wide").select("k", "ni", "sig").distinct()) if len(wide) else None
    found = cut(postings.where("NOT wide").select("k", "ni", "sig").repartition(parts, "k").sortWithinPartitions("k", "ni", "sig").mapInArrow(_first_pairs, _PAIRS))
    pairs = found.where("k is null").select("u", "v")
    pairs = (pairs if far is None else pairs.unionByName(pivot_pairs(far))).distinct()
    stars = lambda roots: roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    roots = cut(components(linked))
    pairs = cut(still_apart(pairs, roots))
    pairs = in_few(pairs, on_cores(pairs).count())
    roots = cut(components(stars(roots).unionByName(check(pairs))))
    joined = stars(roots)
    named = if_small(roots.withColumnRenamed("node", "sig"))
    labelled = lambda df: df.join(named, "sig", "left").select("k", "ni", "sig", F.coalesce("root", "sig").alias("root"))
    more = []
    long = found.where("k is not null").select("k", "ni", "sig")
    if not on_cores(long).isEmpty():
        more.append(labelled(long).repartition(parts, "k").sortWithinPartitions("k", "ni", "sig").mapInArrow(_rest_pairs, _PAIRS).select("u", "v").distinct())
    if far is not None:
        more.append(cell_pairs(cut(labelled(far)), cell))
    if not more:
        return joined
    rest = more[0] if len(more) == 1 else more[0].unionByName(more[1]).distinct()
    return joined.unionByName(check(cut(rest.join(pairs.unionByName(by_print), ["u", "v"], "left_anti"))))


def _grouped(docs: DataFrame, shingle: int, wide: int = WIDE, cell: int = CELL, bits: int = 64) -> DataFrame:
    """(doc_id, text_hash, sig, component_id) for the rows of groups that hold more than one row."""
    known = frequent(docs, shingle)
    rows = cut(prefixes(docs, shingle, known, bits))
    alike = shared_signatures(rows)
    rows = told_apart(rows, alike)
    classes = cut(rows.groupBy("sig").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("sketch").alias("sketch")))
    far = long_postings(rows, wide)
    roots = cut(components(links(docs, rows, classes, shingle, far, cell, alike, bits)).withColumnRenamed("node", "sig"))
    grouped = cut(classes.select("sig", "first_id").join(if_small(roots), "sig"))
    grouped = in_few(grouped, on_cores(grouped).count())
    least = grouped.groupBy("root").agg(F.min("first_id").alias("least_id"))
    named = if_small(cut(grouped.join(least, "root").select("sig", "least_id")))
    named = classes.join(named, "sig", "left").where("rows > 1 or least_id is not null").select("sig", F.coalesce("least_id", "first_id").alias("component_id"))
    return rows.select("doc_id", "text_hash", "sig").join(if_small(cut(named)), "sig")


def near_duplicates(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """``docs(doc_id, text)`` → ``(doc_id, sig, component_id)`` for the rows of groups that hold more than one row."""
    return _grouped(docs, shingle).select("doc_id", "sig", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """``docs`` without the rows whose group has a row with a smaller ``doc_id``.

    Columns are those of ``docs``. Rows that repeat one ``doc_id`` and its text stay or go together; rows without a ``doc_id`` stay.
    """
    return without_rows(docs, _grouped(docs, shingle).where("doc_id <> component_id").select("doc_id", "text_hash"))
