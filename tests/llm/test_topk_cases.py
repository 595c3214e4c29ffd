"""Top-k with large components, repeated ids, empty vectors and scores that do not fit."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.llm import bitslice_topk


def _brute(rows, k):
    """All answers of all rows that ask, with whole numbers of Python."""
    fine = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (i, v) in enumerate(fine):
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for n, (j, w) in enumerate(fine) if n != at)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def test_large_components_repeated_ids_and_empty_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 5)]) for i in range(90)]
    rows += [(20, [2e6, 1.0, 0.0, 0.0, 0.0]), (20, [-3e6, 0.5, 1.0, 0.0, 0.0]), (21, [1e8, 0.0, 0.0, -1.0, 0.25]), (40, rows[40][1]), (40, rows[40][1]), (60, []), (61, []), (80, None), (100, [float("inf")]), (None, [1.0])]
    rows += [(120, [0.0, 1e6, 0.0, 0.0, 0.0]), (140, [0.0, 0.0, 0.0, 1e12]), (33, [1.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for block_rows in (1 << 14, 25):
        got = bitslice_topk.top_k(table, F.col("vec_id") % 20 == 0, k=7, block_rows=block_rows)
        assert sorted(map(tuple, got.collect())) == _brute(rows, 7)


def test_queries_of_few_blocks_are_dealt(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i) * 20, [float(x) for x in rng.integers(-3, 3, 3)]) for i in range(700)]
    got = bitslice_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=3)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 3)


@pytest.mark.parametrize("rows", [[(0, [1e300]), (1, [0.0])], [(0, [1e9, 0.0]), (1, [1e9, 1.0])]])
def test_what_does_not_fit_is_told(spark, rows):
    with pytest.raises(Exception, match=bitslice_topk.TOO_LARGE):
        bitslice_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()


def test_hot_id(spark):
    rows = [(20, [float(i % 7), 1.0]) for i in range(60)] + [(i, [1.0, float(i)]) for i in range(1, 15)]
    answers = defaultdict(int)
    for r in bitslice_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=20).collect():
        answers[r.query_id] += 1
    assert answers == {20: 60 * 20}
