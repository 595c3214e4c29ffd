"""Counts against plain loops, bounds against exact sums, the guarantee on fresh documents, odd tables."""

import random
from collections import Counter
from fractions import Fraction
from math import comb

import pytest

from pathloom.llm import quality_rules as qr


def _plain(text):
    words = qr.WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + o for i, w in enumerate(windows) if w in often for o in range(5)}
    lines, seen, doubled = [x for x in text.split("\n") if qr.WORD.findall(x)], set(), 0
    for x in lines:
        doubled += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), doubled, len(hit), len(lines)


def test_counts_as_plain_loops():
    rng = random.Random(2)
    texts = ["", " \n\t", "a", "a a a a a", "a a a a a a", "a b c d e a b c d e", "x y z w", "#*\n#*\n \n#*", "é" * 9 + "|<>", "a\x0bb\x0cc\x1cd"]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += [" ".join(rng.choice("abc") for _ in range(3000))]
    for t in texts:
        assert qr.counts_of(t) == _plain(t)


@pytest.mark.parametrize(("k", "n", "p"), [(0, 1, 0.5), (0, 600, 0.01), (3, 50, 0.2), (9, 50, 0.2), (11, 50, 0.2), (49, 50, 0.2), (50, 50, 0.2), (2, 1000, 0.01), (0, 0, 0.1)])
def test_binomial_tail(k, n, p):
    q = Fraction(p)
    exact = sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(min(k, n) + 1))
    assert abs(qr.at_most(k, n, p) - float(exact)) < 1e-9
    assert qr.at_most(10**6, 10**9, 0.01) < 1e-300 and qr.at_most(10**8, 10**9, 0.01) > 0.99


def test_walk_ends_at_the_first_cutoff_that_is_not_certified():
    assert qr.certified(2000, [0, 1, 2000, 0], 0.01, 0.01) == 2
    assert qr.certified(100, [0], 0.01, 0.01) == 0 and qr.certified(0, [0, 0], 0.5, 0.5) == 0


def _corpus(seed, n, junk=0.2):
    """(doc_id, text, lang, quality): junk is full of symbols, and some good documents have a few."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        bad = rng.random() < junk
        share = 0.9 if bad else rng.choice([0, 0, 0, 0, 0.05, 0.15, rng.random() * 0.3])
        words = [f"w{rng.randint(0, 10**6)}" + ("#" if rng.random() < share else "") for _ in range(40)]
        out.append((i, " ".join(words), rng.choice(["en", "en", "de", None]), int(not bad)))
    return out


def test_false_rejection_holds_on_fresh_documents(spark):
    known, fresh = _corpus(1, 6000), _corpus(9, 3000)
    table = lambda rows: qr.counted(spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").repartition(4), ["doc_id", "lang"])
    labels = spark.createDataFrame([(r[0], r[3]) for r in known], "doc_id long, quality int")
    limits = qr.cutoffs(qr.good_documents(table(known), labels), "lang")
    assert {r.stratum for r in limits.where("symbols is not null").collect()} == {"en", "de", None}
    judged = {r.doc_id: r.kept for r in qr.judged(table(known), labels).collect()}
    assert len(judged) == 6000
    for lang in ("en", "de", None):
        good = [judged[r[0]] for r in known if r[2] == lang and r[3]]
        assert sum(not x for x in good) <= qr.ALPHA * len(good)
        junk = [judged[r[0]] for r in known if r[2] == lang and not r[3]]
        assert sum(junk) <= 0.05 * len(junk)
    cut = {r.stratum: r.symbols for r in limits.collect()}
    counts = {r.doc_id: r for r in table(fresh).collect()}
    for lang in ("en", "de", None):
        good = [1000 * counts[r[0]].n_symbols >= cut[lang] * counts[r[0]].n_words for r in fresh if r[2] == lang and r[3]]
        assert sum(good) <= qr.ALPHA * len(good)


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, stratum string, cut_symbols int, kept int"
    rows = [(1, None, None, "s", 1, 1), (1, "a " * 12, "en", "s", 1, 1), (None, "# " * 5000, "en", "s", 1, 1), (2, "", "en", "s", 1, 1), (3, "word" * 200_000, "en", "s", 1, 1), (4, " ".join(f"w{i}" for i in range(20)), "en", "s", 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (77, 1), (2, None)], "doc_id long, quality int")
    for own in (labels, labels.limit(0)):
        got = qr.judged(qr.counted(docs, ["doc_id", "lang", "stratum", "cut_symbols"]), own).collect()
        assert len(got) == 6 and {r.doc_id for r in got if r.kept} == {4}
    assert qr.judged(qr.counted(docs.limit(0), ["doc_id", "lang"]), labels).count() == 0
