"""The pipeline's near-duplicate stage against all pairs of sets of five-word shingles."""

import random

import corpus_pipeline
from pathloom.llm import jaccard


def _kept(texts):
    sets = [set(jaccard.shingles((t or "").encode()).tolist()) for t in texts]
    root = list(range(len(texts)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i for i in range(len(texts)) if find(i) == i}


def test_near_copies_go_at_four_fifths(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=rng.randint(3, 7)))
    line = [word() for _ in range(12)]
    texts = [None, "", " \n", "one two", "One  two", "one", "one two three four five six", "one two three four five six seven"]
    for n in (9, 40, 150, 600):
        for _ in range(6):
            base = [word() for _ in range(n)] + (line if rng.random() < 0.5 else [])
            texts.append(" ".join(base))
            for changes in (1, 2, max(1, n // 60), max(1, n // 40)):
                copy = list(base)
                for at in rng.sample(range(n), changes):
                    copy[at] = word()
                texts.append(" ".join(copy))
    base = [word() for _ in range(100)]  # a group above a posting's block
    for _ in range(90):
        copy = list(base)
        for at in rng.sample(range(100), rng.randint(0, 4)):
            copy[at] = word()
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()} == _kept(texts)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").count() == 0


def test_the_byte_position_index_goes_first(spark):
    """Fingerprints of near copies link pairs that shingles need not be asked for; only pairs at four fifths are joined by them."""
    rng = random.Random(5)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(400)] for _ in range(12)]
    copies = [[*x[:395], "other", *x[396:]] for x in base]
    docs = spark.createDataFrame(list(enumerate(" ".join(x) for x in base + copies)), "doc_id long, text string").repartition(3)
    rows = jaccard.prefixes(docs, 5, jaccard.frequent(docs, 5)).cache()
    id_of = {r.sig: r.doc_id for r in rows.collect()}
    found = {tuple(sorted((id_of[u], id_of[v]))) for u, v in jaccard.print_pairs(rows.select("sig", "fp")).collect()}
    assert found and all(b - a == 12 for a, b in found)
    roots = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3)], "node long, root long")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (4, 3), (2, 5), (6, 7)], "u long, v long")
    assert sorted(map(tuple, jaccard.still_apart(pairs, roots).collect())) == [(1, 3), (2, 5), (6, 7)]
