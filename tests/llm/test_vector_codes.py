"""Codebooks and codes against a plain search of all entries; the radius; odd tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def _brute(rows, scale, parts, entries, rounds):
    """(id, code, error) of each kept row and the codebooks, with whole numbers of Python and no pruning."""
    kept = [(i, v, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))[:entries]
    books = [[list(cut[n][p]) for n in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for x in cut:
                of.setdefault(near(x[p], books[p])[1], []).append(x[p])
            books[p] = [[sum(c) // len(of[e]) for c in zip(*of[e])] if e in of else c for e, c in enumerate(books[p])]
    found = [[near(x[p], books[p]) for p in range(parts)] for x in cut]
    return sorted((str(i), bytes(e for _, e in f), sum(d for d, _ in f)) for (i, _, _), f in zip(kept, found)), ",".join(str(z) for b in books for c in b for z in c)


def _rows(n, seed=1, width=8):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0, 0.4, width)]) for i in range(n)]


@pytest.mark.parametrize("entries", [1, 5, 16])
def test_as_a_plain_search(spark, entries):
    rows = _rows(300) + [(None, [0.5] * 8), (7, [0.5] * 8), (7, [-0.25] * 8), (900, None), (901, [0.0] * 7 + [float("nan")]), (902, [float("inf")] + [0.0] * 7), (903, [None] + [1.0] * 7)]
    rows += [(1000 + i, [1.0] * 8) for i in range(200)]  # a third of the rows are one vector
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(5)
    history = vc.fit(table, parts=4, entries=entries, rounds=3)
    got = vc.encode(table, history, ["vec_id"]).collect()
    want, numbers = _brute(rows, vc.SCALE, 4, entries, 3)
    assert sorted((str(r.vec_id), bytes(r.code), r.error) for r in got) == want and vc.numbers(history[-1]) == numbers


def test_ties_go_to_the_lower_entry_though_the_search_starts_elsewhere():
    book = vc.Codebook(np.array([[0, 0], [4, 0], [2, 0], [2, 0], [9, 9]], np.int64))
    x = np.array([[1, 0], [3, 0], [2, 0], [2, 5]], np.int64)
    want = [min((int(((r - c) ** 2).sum()), e) for e, c in enumerate(book.entries)) for r in x]
    for start in range(5):
        best, least, _ = book.search(x, np.full(4, start))
        assert [(int(d), int(e)) for d, e in zip(least, best)] == want


def test_the_radius_spares_distances():
    rng = np.random.default_rng(3)
    centres = rng.integers(-10_000, 10_000, (64, 4))
    x = centres[rng.integers(0, 64, 2000)] + rng.integers(-20, 20, (2000, 4))
    book = vc.Codebook(centres)
    best, _, _ = book.search(x, np.zeros(2000, np.int64))
    again, _, taken = book.search(x, best)
    assert (again == best).all() and taken < 2000 * 4


def test_few_rows_no_rows_and_bad_rows(spark):
    one = spark.createDataFrame([(1, [0.25] * 8, None, "x")], SCHEMA)
    history = vc.fit(one)
    assert [tuple(r) for r in vc.encode(one, history, ["vec_id", "label"]).collect()] == [(1, None, bytearray(8), 0)]
    empty = one.limit(0)
    assert vc.fit(empty) == [] and vc.encode(empty, [], ["vec_id"]).columns == ["vec_id", "code", "error"] and vc.encode(empty, [], ["vec_id"]).count() == 0
    for bad in ([(1, [0.5] * 8), (2, [0.5] * 16)], [(1, [0.5] * 7)], [(1, [1e9] * 8)], [(1, [])]):
        with pytest.raises(ValueError):
            vc.fit(spark.createDataFrame(bad, "vec_id long, embedding array<double>"))


def test_codes_decode(spark):
    rows = _rows(40, 4)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    history = vc.fit(table, entries=64, rounds=2)
    r = vc.encode(table, history, ["vec_id", "embedding"]).select("embedding", "error", vc.decoded(F.col("code"), history[-1]).alias("back")).collect()
    for x in r:
        off = [math.floor(vc.SCALE * a) - vc.SCALE * b for a, b in zip(x.embedding, x.back)]
        assert round(sum(o * o for o in off)) == x.error
