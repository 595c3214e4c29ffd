"""Long postings that are dealt in cells, sets whose numbers collide, and fingerprints that share most of their bytes."""

import random

import numpy as np
import pytest

from pathloom.llm import jaccard, simhash


def _families(rng):
    """Families of near copies around shared boilerplate: some linked, some just below, so that postings have several components."""
    word = lambda: "".join(rng.choices("abcdefghijkl", k=rng.randint(3, 7)))
    common = [word() for _ in range(40)]
    texts = []
    for _ in range(12):
        own = [word() for _ in range(rng.choice([3, 6, 10, 14]))]
        for _ in range(rng.randint(2, 14)):
            copy = common + own
            for at in rng.sample(range(len(copy)), rng.randint(0, 2)):
                copy[at] = word()
            texts.append(" ".join(copy[rng.randint(0, 3) :]))
    return texts + [" ".join(word() for _ in range(50)) for _ in range(20)] + texts[:5]


def _groups(texts):
    sets = [set(jaccard.shingles(t.encode()).tolist()) for t in texts]
    root = list(range(len(texts)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    members = {}
    for i in range(len(texts)):
        members.setdefault(find(i), []).append(i)
    return {i: m[0] for m in members.values() if len(m) > 1 for i in m}


@pytest.mark.parametrize(("wide", "cell", "bits"), [(0, 3, 64), (0, 1000, 64), (0, 1, 3), (10**9, 3, 0)])
def test_wide_postings_and_colliding_numbers(spark, wide, cell, bits):
    """All frequent postings go by cells, of a few sets each, and with few bits most sets share their number."""
    texts = _families(random.Random(7))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    old, jaccard.SAMPLE = jaccard.SAMPLE, 1
    try:
        got = {r.doc_id: r.component_id for r in jaccard._grouped(docs, 5, wide, cell, bits).collect()}
    finally:
        jaccard.SAMPLE = old
    assert got == _groups(texts)


def test_one_opening_gives_few_pairs(spark):
    """20,000 sets that share one opening and differ else."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('all of these texts open like this ', array_join(transform(sequence(1, 12), i -> md5(concat(id, '/', i))), ' ')) AS text").repartition(4)
    known = jaccard.frequent(docs, 5)
    rows = jaccard.prefixes(docs, 5, known).drop("more")
    found = rows.select("sig", "n", "prefix").mapInArrow(lambda b: jaccard._exploded(b, np.zeros(0, np.int64)), "k long, ni long, sig long, wide boolean")
    assert found.groupBy("k").count().agg({"count": "max"}).first()[0] <= 4
    assert jaccard._grouped(docs, 5).count() == 0


def test_pairs_of_a_cell_are_bounded(spark):
    """3,000 sets of one posting in blocks of 64: every pair of different roots once, whatever the block."""
    rng = random.Random(2)
    rows = [(5, rng.randint(95, 130) << 32, i, i % 7 if i % 3 else 100) for i in range(600)]
    wide = spark.createDataFrame(rows, "k long, ni long, sig long, root long")
    want = {(a[2], b[2]) for x, a in enumerate(rows) for b in rows[x + 1 :] if a[3] != b[3] and 9 * min(a[1] >> 32, b[1] >> 32) >= 4 * ((a[1] >> 32) + (b[1] >> 32))}
    assert {tuple(r) for r in jaccard.cell_pairs(wide, 64).collect()} == want


@pytest.mark.parametrize("long", [1, 40, 10**9])
def test_long_postings_of_fingerprints(spark, long):
    """Fingerprints that share most bytes, in groups of more than a posting's length."""
    rng = random.Random(4)
    base = rng.getrandbits(64)
    prints = {base ^ sum(1 << rng.randrange(24) for _ in range(rng.randint(0, 9))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long").repartition(3)
    parent = {p: p for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in simhash.links(df, long=long, sample=1).collect():
        x, y = top(u % (1 << 64)), top(v % (1 << 64))
        assert ((u ^ v) % (1 << 64)).bit_count() <= 3 or find(u % (1 << 64)) == find(v % (1 << 64))
        parent[max(x, y)] = min(x, y)
    assert {p: top(p) for p in prints} == {p: find(p) for p in prints}
