"""Byte-level BPE ids for whole texts, fast enough to run over a corpus.

A text is cut at single spaces. Under the tokenizer's pattern a piece with its
leading space is encoded alike wherever it stands, unless white space precedes
*and* follows that space; texts with such a place are encoded whole. Pieces
come from a bounded memo, so a frequent word is merged only once per worker.
Pieces beyond Latin script go to the ``tokenizers`` library itself, the others
to its vocabulary in rank form, which gives the same ids (tests compare them).
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: A space with white space before it, and white space or the end after it: its run is one unit.
_RUN = re.compile(r"\s (?:\s|\Z)")
_BEYOND_LATIN = re.compile(r"[^\x00-ɏ]")


class Encoder:
    """``encode(texts)`` returns little-endian uint32 ids as bytes for each text."""

    def __init__(self, name: str = "byte_bpe_50k", memo: int = 600_000):
        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.exact.encode_special_tokens = True  # their strings are ordinary text here
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        #: UTF-8 bytes of each id; ids without a rank are the special tokens, never produced.
        self.id_bytes = np.zeros(max(ranks.values()) + 2, np.int64)
        for piece, rank in ranks.items():
            self.id_bytes[rank] = len(piece)
        self.memo: dict[str, bytes] = {}
        self.limit = memo

    def whole(self, text: str) -> bytes:
        if _BEYOND_LATIN.search(text):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Memorise pieces: together in one go, told apart by their spaces, if that is safe, or else one by one."""
        text = " " + " ".join(pieces)
        if _RUN.search(text) or _BEYOND_LATIN.search(text):
            odd = [x for x in pieces if not x or x[0].isspace() or x[-1].isspace() or _BEYOND_LATIN.search(x)]
            self.memo.update((x, self.whole(" " + x)) for x in odd)
            return self._learn(list(set(pieces).difference(odd))) if len(odd) < len(pieces) else None
        ids = np.array(self.ranks.encode_ordinary(text), "<u4")
        raw = np.frombuffer(text.encode(), np.uint8)
        starts = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.flatnonzero(raw == 32), side="right")
        starts, flat = (4 * starts).tolist(), ids.tobytes()
        self.memo.update(zip(pieces, map(flat.__getitem__, map(slice, starts, [*starts[1:], len(flat)])), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the memo is cut back between calls only, so pass texts of a few MB at a time."""
        if len(self.memo) > self.limit:
            self.memo.clear()
        cut = [None if _RUN.search(x) else x.split(" ") for x in texts]
        new: set[str] = set().union(*(x[1:] for x in cut if x)).difference(self.memo)
        if new:
            self._learn(list(new))
        of = self.memo.__getitem__
        return [self.whole(text) if pieces is None else (self.whole(pieces[0]) if pieces[0] else b"") + b"".join(map(of, pieces[1:])) for text, pieces in zip(texts, cut, strict=True)]


def in_slices(texts: list[str], most: int = 1 << 21) -> Iterator[list[str]]:
    """Consecutive texts of ``most`` characters together, or a single longer one."""
    part: list[str] = []
    size = 0
    for x in texts:
        if part and size + len(x) > most:
            yield part
            part, size = [], 0
        part.append(x)
        size += len(x)
    if part:
        yield part


@functools.lru_cache(maxsize=2)
def encoder(name: str = "byte_bpe_50k") -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(name)
