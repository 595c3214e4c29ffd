"""Sum-of-squares online packing of tokenised documents into windows.

Each task packs its rows as they come. A document longer than a window fills
whole windows first; its rest goes to the fill level that minimises the sum
over levels of the squared count of open windows at that level, a new window
being level zero. Counts and windows are kept in a level array. At most
``max_open`` windows are open at a time. When so many are, no new one is begun:
a document that fits none whole is cut at the end of one, which thereby gets
full, and goes on in a new one; that window too is the one with the least sum
of squares. At the end of a task the pieces in its open windows are strung
together and cut into full windows, and what then remains into windows whose
sizes are powers of two, so that nothing is padded.

A task's windows are written together, so a lost task's are replaced by those
of its repetition; these can differ if its rows come in another order, which a
shuffle before the packing leaves open. Write the pieces before reading them
more than once.

Defined cases: null text is the empty text, a document of the closing id only;
repeated rows are packed once each; an empty table gives no pieces; a document
may have any length; texts that spell a special token are ordinary text; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.bpe import encoder, in_slices
from pathloom.llm.common import in_parts, texts_of

#: One piece: document, its first id's place there, ids of the document in all, the piece's ids as bytes.
Piece = tuple[int | None, int, int, bytes]
SCHEMA = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    def __init__(self, window: int = 1024, max_open: int = 32):
        self.window, self.max_open, self.open = window, max_open, 0
        self.counts = np.zeros(window + 1, np.int64)  # the last level is full windows, which count nothing
        self.levels: list[list[list[Piece]]] = [[] for _ in range(window)]

    def level_for(self, size: int) -> int:
        """Fill level to place ``size`` ids at: least sum of squares, then the fuller window; whole if any level allows it."""
        below, above = self.counts[: self.window + 1 - size], self.counts[size:]
        # (above+1)^2 - above^2 - (below^2 - (below-1)^2); a window that gets full leaves no square
        change = 2.0 * above + 1 - (2.0 * below - 1)
        change[-1] = 1 - 2.0 * below[-1]
        change[below == 0] = np.inf
        change[0] = 2.0 * above[0] + 1 if self.open < self.max_open else np.inf
        best = len(change) - 1 - int(np.argmin(change[::-1]))
        if change[best] < np.inf:
            return best
        # all open windows are fuller: one gets full, and the rest begins another at the level it is left with
        full, rest = self.counts[self.window + 1 - size : self.window], self.counts[1:size]
        change = np.where(full > 0, 2.0 * rest + 1 - (2.0 * full - 1), np.inf)
        return self.window - 1 - int(np.argmin(change[::-1]))

    def _take(self, level: int) -> list[Piece]:
        """An open window of a level, or a new one."""
        if not level:
            return []
        self.counts[level] -= 1
        self.open -= 1
        return self.levels[level].pop()

    def _put(self, level: int, held: list[Piece]) -> None:
        self.levels[level].append(held)
        self.counts[level] += 1
        self.open += 1

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list[Piece]]:
        """Windows that became full."""
        total, width = len(ids) // 4, 4 * self.window
        for at in range(0, len(ids), width):
            part = ids[at : at + width]
            size = len(part) // 4
            if size == self.window:
                yield [(doc_id, at // 4, total, part)]
                continue
            level = self.level_for(size)
            held, room = self._take(level), self.window - level
            held.append((doc_id, at // 4, total, part[: 4 * room]))
            if size < room:
                self._put(level + size, held)
                continue
            yield held
            if size > room:
                self._put(size - room, [(doc_id, at // 4 + room, total, part[4 * room :])])

    def close(self) -> Iterator[list[Piece]]:
        """All open windows, strung together and cut into full ones and powers of two."""
        held = [piece for level in reversed(self.levels) for window in level for piece in window]
        left = sum(len(x[3]) // 4 for x in held)
        self.__init__(self.window, self.max_open)
        room, window = 0, []
        for doc_id, start, total, ids in held:
            at = 0
            while at < len(ids):
                if not room:
                    room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                    left -= room
                part = ids[at : at + 4 * room]
                window.append((doc_id, start + at // 4, total, part))
                at += len(part)
                room -= len(part) // 4
                if not room:
                    yield window
                    window = []


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k", window: int = 1024, end_id: int = 0, max_open: int = 32, keep_ids: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` → one row per piece: its place in its document and in its window, its ids and their CRC-32.

    ``max_open`` bounds the windows that a task keeps open. ``keep_ids=False`` leaves the column ``ids`` null, for callers that need the layout only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, packer, end = encoder(vocabulary), Packer(window, max_open), int(end_id).to_bytes(4, "little")
        base, made = TaskContext.get().partitionId() << 40, 0
        rows: list[tuple] = []

        def note(full: list[Piece]) -> None:
            nonlocal made
            offset = 0
            for doc_id, start, total, ids in full:
                rows.append((doc_id, start, len(ids) // 4, ids if keep_ids else None, zlib.crc32(ids), total, base + made, offset))
                offset += len(ids) // 4
            made += 1

        def out() -> pa.RecordBatch:
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            kinds = [pa.binary() if x == "ids" else pa.int64() for x in names]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for b in batches:
            keys, at = b.column(0).to_pylist(), 0
            for texts in in_slices(texts_of(b.column(1))):
                for ids in bpe.encode(texts):
                    for full in packer.add(keys[at], ids + end):
                        note(full)
                    at += 1
                yield out()
                rows.clear()
        for full in packer.close():
            note(full)
        yield out()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(in_parts(run), SCHEMA)
