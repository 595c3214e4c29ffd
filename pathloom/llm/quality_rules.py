"""Quality rules whose cutoffs are chosen under a bound on false rejection.

A rule rejects a document whose value is beyond a cutoff. For each stratum (here a language) and each rule, a ladder of cutoffs
fixed in advance is walked from the most lenient one down. At a cutoff, k of the stratum's n held-out documents that
are labelled good would be rejected; it is certified if the exact binomial (Clopper-Pearson) upper bound of the
rejection rate is at most the rule's limit, that is if P(Bin(n, limit) <= k) <= level. The walk ends at the first cutoff that
is not certified, and the last certified one is used; so a ladder is one test in a fixed sequence and needs no correction of
its own. Across strata and rules the level is divided by their number (Bonferroni), and the limit by the number of rules,
so that with probability 1 - ``delta`` no stratum's rate of falsely rejected documents is above ``alpha``. A rule that is not
certified in a stratum rejects nothing there, as in strata with few or no labels.

Counts come from one pass over the texts; ladders are counted by Spark, a row per stratum, and cutoffs stay a table,
which is broadcast if its count allows.

Cases: a null or empty text has no words; a null stratum is one of its own; labels are one per document (good if any says
so), null ones none; labels without a document do not count; each row of a repeated document counts as one; empty
tables give no rows, and without labels nothing is rejected but by the base. Documents that fail the base take no part in the
calibration: the rules do not decide on them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import cut, if_small, in_parts, texts_of, unused

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class Rule:
    """Rejects if 1000 * ``part`` / ``whole`` is at least (or, with ``low``, at most) a cutoff; ``ladder`` runs from lenient to strict."""

    name: str
    part: str
    whole: str
    ladder: tuple[int, ...]
    low: bool = False

    def rejects(self, cutoff: Column | int) -> Column:
        """True where the rule rejects; false where the whole is zero or the cutoff null."""
        x, y = 1000 * F.col(self.part), cutoff * F.col(self.whole)
        return F.coalesce((F.col(self.whole) > 0) & ((x <= y) if self.low else (x >= y)), F.lit(False))


#: Per mille: symbols, repeated words and letters by words, doubled lines by lines.
RULES = (
    Rule("symbols", "n_symbols", "n_words", (5000, 3000, 2000, 1500, 1000, 700, 500, 400, 300, 250, 200, 150, 100)),
    Rule("long_words", "word_chars", "n_words", (20000, 15000, 12000, 10000, 9000, 8500, 8000, 7500, 7000, 6750, 6500, 6250, 6000)),
    Rule("short_words", "word_chars", "n_words", (1000, 1500, 2000, 2500, 3000, 3250, 3500, 3750, 4000, 4250), low=True),
    Rule("doubled_lines", "n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400, 300, 250, 200, 150)),
    Rule("repeated_words", "n_repeat_words", "n_words", (200, 190, 180, 170, 160, 150, 140, 130, 120, 110, 100, 80, 60)),
)
ALPHA, DELTA = 0.05, 0.05


def repeated_words(words: list[str], size: int = 5) -> int:
    """How many words are in a window of ``size`` words that is found twice or more."""
    if len(words) <= size:
        return 0
    number: dict[str, int] = {}
    base = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    windows, wide = base, 1
    while wide < size:  # numbers of windows of ``wide`` words, doubled until they have ``size``
        step = min(wide, size - wide)
        pairs = windows[: len(windows) - step] * (int(windows.max()) + 1) + windows[step:]
        windows, wide = np.unique(pairs, return_inverse=True)[1].astype(np.int64), wide + step
    again = np.bincount(windows)[windows] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(again)] += again
    edges[size : size + len(again)] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum())


def counts_of(text: str) -> tuple[int, ...]:
    """COUNTS of one text."""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(SYMBOL.findall(text)), len(lines) - len(set(lines)), repeated_words(words), len(lines)


def counted(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with COUNTS and ``base_failed``, for every row."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                each = zip(*map(counts_of, texts_of(b.column(b.num_columns - 1))), strict=True)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(c, pa.int64()) for c in each)], names=[*keep, *COUNTS])

    made = docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(in_parts(run), f"{kinds}, " + ", ".join(f"{c} long" for c in COUNTS))
    return made.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def at_most(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed from the largest term down until the rest is nothing."""
    if k >= n:
        return 1.0
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    if k >= n * p:  # the median is n p or one beside it, so this is beyond any level of interest
        return 1.0 - sum(_falling(math.exp(log(k + 1)), lambda i: (n - i) / (i + 1) * p / (1 - p), range(k + 1, n)))
    return sum(_falling(math.exp(log(k)), lambda i: i / (n - i + 1) * (1 - p) / p, range(k, 0, -1)))


def _falling(term: float, ratio, places: range) -> Iterator[float]:
    yield term
    for i in places:
        term *= ratio(i)
        if term < 1e-18:
            return
        yield term


def certified(n: int, rejected: list[int], limit: float, level: float) -> int:
    """How many cutoffs of a ladder, from the first on, are certified; ``rejected`` are the good documents that each would reject."""
    for i, k in enumerate(rejected):
        if n == 0 or at_most(k, n, limit) > level:
            return i
    return len(rejected)


def cutoffs(good: DataFrame, stratum: str, rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, n_good, a cutoff for each rule, or null) from the good documents' counts, for every stratum that has any.

    The number of strata, of which one row each is made, counts for the correction.
    """
    ladders = [F.array(*(F.count_if(r.rejects(F.lit(c))) for c in r.ladder)).alias(r.name) for r in rules]
    seen = cut(good.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n_good"), *ladders))
    level, limit = delta / (max(seen.count(), 1) * len(rules)), alpha / len(rules)
    kind = seen.schema["stratum"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(1).to_pylist()
            out = []
            for r, column in zip(rules, b.columns[2:], strict=True):
                sure = [certified(m, k, limit, level) for m, k in zip(n, column.to_pylist(), strict=True)]
                out.append(pa.array([r.ladder[s - 1] if s else None for s in sure], pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *out], names=["stratum", "n_good", *(r.name for r in rules)])

    return seen.mapInArrow(run, f"stratum {kind}, n_good long, " + ", ".join(f"{r.name} long" for r in rules))


def good_documents(counts: DataFrame, labels: DataFrame, quality: str = "quality") -> DataFrame:
    """Rows that pass the base and are labelled good."""
    ids = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(quality).alias("__good")).where("__good = 1").select("__id")
    return counts.where(~F.col("base_failed")).join(ids, F.col("doc_id").cast("long") == F.col("__id"), "left_semi")


def judged(counts: DataFrame, labels: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``counts`` with ``rejected_by`` (names of rules) and ``kept``: false if the base fails or a certified rule rejects."""
    fixed = cut(counts)
    limits = cut(cutoffs(good_documents(fixed, labels), stratum, rules, alpha, delta))
    named = limits.select(F.col("stratum").alias(s := unused("stratum", fixed)), *(F.col(r.name).alias(unused(f"cut_{r.name}", fixed)) for r in rules))
    joined = fixed.join(if_small(named), F.col(stratum).eqNullSafe(F.col(s)), "left")
    by = F.filter(F.array(*(F.when(r.rejects(F.col(unused(f"cut_{r.name}", fixed))), F.lit(r.name)) for r in rules)), lambda x: x.isNotNull())
    return joined.select(*fixed.columns, by.alias("rejected_by")).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
