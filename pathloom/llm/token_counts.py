"""Token counts of a document's sections, from one encoding of the whole document.

A document is the concatenation of its fields with a separator. It is encoded
once; each token's byte span follows from its place, since the pieces of a
byte-level vocabulary tile the text. Spans are joined with the sections by
interval, and a token that crosses a boundary goes, by rule, to

* ``"start"``: the section that holds its first byte;
* ``"most"``: the section that holds most of its bytes, the earlier of equals.

Separators and bytes outside all sections belong to the section before them.

Defined cases: null fields are empty and get zero tokens of their own bytes;
an empty document has rows with zero tokens; repeated rows give repeated
results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.llm.bpe import encoder, in_slices
from pathloom.llm.common import in_parts, texts_of

SCHEMA = "doc_id long, section string, section_no int, start long, end long, tokens long, crossing long, doc_tokens long"


def attribute(ends: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """Section of each token. ``ends``: token ends in bytes; ``starts``: of the sections, ascending from 0."""
    begins = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(starts, begins, side="right") - 1
    if rule == "start":
        return first
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    best, most = first.copy(), np.zeros(len(ends), np.int64)
    bounds = np.append(starts, np.iinfo(np.int64).max)
    for step in range(int((last - first).max(initial=0)) + 1):
        at = np.minimum(first + step, last)
        held = np.minimum(ends, bounds[at + 1]) - np.maximum(begins, bounds[at])
        best = np.where(held > most, at, best)
        most = np.maximum(most, held)
    return best


def token_counts(docs: DataFrame, fields: dict[str, Column | str], vocabulary: str = "byte_bpe_50k", separator: str = "\n", rule: str = "most") -> DataFrame:
    """One row per document and field of ``fields`` (name → column), in that order.

    ``start`` and ``end`` are the field's span in the whole document in code points.
    ``crossing`` counts the tokens it was given that reach into another section.
    """
    if rule not in ("start", "most"):
        raise ValueError(f"no such rule: {rule}")
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for b in batches:
            keys, at = b.column(0).to_pylist(), 0
            parts = list(zip(*(texts_of(b.column(i + 1)) for i in range(len(names))), strict=True))
            wholes = [separator.join(x) for x in parts]
            for texts in in_slices(wholes):
                rows = []
                for ids in bpe.encode(texts):
                    ends = np.cumsum(bpe.id_bytes[np.frombuffer(ids, "<u4")])
                    chars = np.cumsum([0, *(len(x) + len(separator) for x in parts[at][:-1])])
                    starts = np.cumsum([0, *(len(x.encode()) + len(separator.encode()) for x in parts[at][:-1])])
                    owner = attribute(ends, starts, rule)
                    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                    across = np.searchsorted(starts, begins, side="right") != np.searchsorted(starts, ends - 1, side="right")
                    tokens = np.bincount(owner, minlength=len(names))
                    crossing = np.bincount(owner[across], minlength=len(names))
                    rows += [(keys[at], n, i, int(chars[i]), int(chars[i]) + len(parts[at][i]), int(tokens[i]), int(crossing[i]), len(ends)) for i, n in enumerate(names)]
                    at += 1
                kinds = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 5]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    columns = [(F.col(c) if isinstance(c, str) else c).cast("string").alias(f"f{i}") for i, c in enumerate(fields.values())]
    return docs.select(F.col("doc_id").cast("long"), *columns).mapInArrow(in_parts(run), SCHEMA)


def with_title(docs: DataFrame, vocabulary: str = "byte_bpe_50k", rule: str = "most") -> DataFrame:
    """Counts of the fields language, source, title (the first line) and body (all the rest) of ``docs``.

    A text without a line break is all title.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    title = F.substring_index(text, "\n", 1)
    body = F.substring(text, F.length(title) + 2, F.length(text))
    return token_counts(docs, {"lang": "lang", "source": "source", "title": title, "body": body}, vocabulary, "\n", rule)
