"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents of any kind are the
unlabelled set, in which toxic ones hide at the rate of the class prior. A
linear classifier in numpy minimises the class-prior-corrected risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

by gradient steps that turn around while the estimated negative risk is below
zero. The prior is the share of toxic documents among the labelled ones that
may be learnt from. Inputs are the words of the text and their character
four-grams, as present or absent; those that the positives hold far more often
than the unlabelled are selected, all statistics over the training sample.
Two things bind the fit beyond the risk: weights stay at zero or above, since
features are signs of the positives by selection; and of the bias that the risk
gives only its part in the weights' steps is left, since after the last step
the bias is set anew so that the mean score of the unlabelled sample is the
prior, which makes scores probabilities of that sample.

Bounds (parameters): ``max_positive`` and ``max_unlabelled`` rows, picked by
the hash of their key, are what the driver fits on; all rows are scored.

Defined cases: null text is empty and scores as a text without known features;
without positives or without text to learn from every score is the prior (0 if
nothing is labelled); repeated rows score alike; a document with several label
rows is toxic if one of them is 1, labels other than 1 are not toxic, null
labels are none; an empty table gives an empty result; other columns of ``docs`` are ignored by
``score`` and kept by ``reject``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import cut, in_parts, kept_rows, texts_of

BUCKETS = 1 << 22
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> set[int]:
    """The word, its start, and its character four-grams, as buckets."""
    marked = f"<{word}>"
    grams = {marked[i : i + 4] for i in range(len(marked) - 3)}
    return {zlib.crc32(x.encode()) % BUCKETS for x in (marked, "^" + word[:5], *grams)}


class Features:
    """Distinct features of a text, of all kinds or only of those in ``known`` (bucket → place)."""

    def __init__(self, known: dict[int, int] | None = None, memo: int = 128 << 20):
        self.known, self.limit, self.held = known, memo, 0  # bytes, about
        self.memo: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> np.ndarray:
        found: set[int] = set()
        memo = self.memo
        for word in set(_WORD.findall(text.lower())):
            ids = memo.get(word)
            if ids is None:
                ids = word_features(word)
                ids = tuple(ids if self.known is None else [self.known[x] for x in ids if x in self.known])
                size = 200 + 4 * len(word) + 40 * len(ids)
                if self.held + size > self.limit:
                    memo.clear()
                    self.held = 0
                if size <= self.limit:
                    memo[word] = ids
                    self.held += size
            if ids:
                found.update(ids)
        return np.fromiter(sorted(found), np.int32, len(found))


@dataclass
class Model:
    prior: float
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    known: dict[int, int] = field(default_factory=dict)

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        if not self.known:
            return np.full(len(rows), self.prior)
        return 1 / (1 + np.exp(-np.clip(_sums(self.weights, rows) + self.bias, -50, 50)))


def _sums(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(r) for r in rows], np.int64)
    total = np.concatenate([[0.0], np.cumsum(weights[np.concatenate([np.zeros(0, np.int32), *rows])])])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _counts(rows: list[np.ndarray]) -> np.ndarray:
    """In how many rows each bucket occurs."""
    n = np.zeros(BUCKETS, np.int32)
    for r in rows:
        n[r] += 1
    return n


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def risks(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The risk of the positives, weighed by the prior, and that of the negatives as estimated, which can be below zero."""
    return prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()


def gradients(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """What a step goes along, by the scores before the sigmoid: the gradient of the sum of both risks, or, while the second is below zero, of minus the second."""
    against_p, against_u = prior * _sigmoid(zp) / len(zp), _sigmoid(zu) / len(zu)
    if risks(zp, zu, prior)[1] < 0:
        return against_p, -against_u
    return prior * (_sigmoid(zp) - 1) / len(zp) - against_p, against_u


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, least: int = 5, ratio: float = 2.0, most: int = 20_000, epochs: int = 400, rate: float = 0.05, l2: float = 5e-5) -> Model:
    """Non-negative PU fit over rows of feature buckets. Texts that repeat count once."""
    positive, unlabelled = (list({r.tobytes(): r for r in rows}.values()) for rows in (positive, unlabelled))
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(min(max(prior, 0.0), 1.0))
    in_p, in_u = _counts(positive), _counts(unlabelled)
    seen = np.flatnonzero(in_p >= least)
    share_p, share_u = in_p[seen] / len(positive), in_u[seen] / len(unlabelled)
    # a toxic feature is 1/prior times as frequent among the positives; the lower bound of its share counts
    bound = share_p - 2 * np.sqrt(share_p * (1 - share_p) / len(positive))
    strong = bound > ratio * share_u
    chosen = seen[strong][np.argsort((share_u / share_p)[strong], kind="stable")[:most]]
    known = {int(x): i for i, x in enumerate(chosen)}
    if not known:
        return Model(prior)

    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    rows_p, rows_u = ([(x := place[r])[x >= 0] for r in rows] for rows in (positive, unlabelled))

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    (ip, jp), (iu, ju) = flat(rows_p), flat(rows_u)
    w, b = np.zeros(len(known)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, epochs + 1):
        zp = np.bincount(jp, w[ip], len(rows_p)) + b
        zu = np.bincount(ju, w[iu], len(rows_u)) + b
        gp, gu = gradients(zp, zu, prior)
        g = np.bincount(ip, gp[jp], len(w)) + np.bincount(iu, gu[ju], len(w)) + l2 * w
        gb = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= scale * m / (np.sqrt(v) + 1e-8)
        b -= scale * mb / (np.sqrt(vb) + 1e-8)
        np.maximum(w, 0, out=w)  # features were selected as signs of the positives
    zu = np.bincount(ju, w[iu], len(rows_u))
    low, high = -50.0, 50.0
    for _ in range(60):  # the mean score over the unlabelled is the prior
        b = (low + high) / 2
        low, high = (b, high) if _sigmoid(zu + b).mean() < prior else (low, b)
    return Model(prior, w, b, known)


def train(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, max_positive: int = 4000, max_unlabelled: int = 10000) -> Model:
    """Fit on rows of ``docs(doc_id, text)``, positives by ``labels(doc_id, toxic)``; ``may_learn``: a condition on ``doc_id``.

    At most ``max_positive`` and ``max_unlabelled`` distinct rows reach the driver, whatever the number of rows that share an id.
    """
    may_learn = F.lit(True) if may_learn is None else may_learn
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).cast("int").alias("toxic")).where(may_learn & F.col("toxic").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = marked.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not toxic:
        return Model(0.0)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(may_learn & F.col("doc_id").isNotNull())
    by_hash = [F.xxhash64("doc_id", F.lit(1)), "doc_id"]
    picked_p = marked.where("toxic = 1").select("doc_id").orderBy(*by_hash).limit(max_positive)
    picked_u = keyed.select("doc_id").distinct().orderBy(*by_hash).limit(max_unlabelled)
    picked = picked_p.select("doc_id", F.lit(1).alias("kind")).unionByName(picked_u.select("doc_id", F.lit(0).alias("kind")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for b in batches:
            found = [features.of(t).tobytes() for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["kind", "features"])

    # the picked keys are at most max_positive + max_unlabelled longs
    rows = cut(keyed.join(F.broadcast(picked), "doc_id").select("kind", "text").mapInArrow(in_parts(run), "kind int, features binary").distinct())
    hashed = rows.where(F.octet_length("features") > 0).withColumn("h", F.xxhash64("features"))
    sides = []
    for kind, most in ((1, max_positive), (0, max_unlabelled)):  # an id can have any number of rows, so the bound holds for rows too
        own = hashed.where(F.col("kind") == kind)
        last = own.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0]  # only hashes meet in one place
        bounded = own.where(F.col("h") <= (0 if last is None else last)).select("features").toLocalIterator()
        sides.append(sorted((np.frombuffer(r[0], np.int32) for r in bounded), key=lambda r: r.tobytes()))  # rows come in any order
    return fit(*sides, toxic / n)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)`` → ``(doc_id, score, predicted)``. The model has a bounded number of weights."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value.known)
        for b in batches:
            s = shared.value.scores([features.of(t) for t in texts_of(b.column(1))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(in_parts(run), "doc_id long, score double, predicted int")


def reject(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value.known)
        for b in batches:
            yield kept_rows(b, (shared.value.scores([features.of(t) for t in texts_of(b.column(place))]) < threshold).tolist())

    return docs.mapInArrow(in_parts(run), docs.schema)
