"""The place where a picture encoder is put in: batches of pictures in, tokens out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Takes the pictures of a batch and gives (pictures, tokens, width) numbers.
Encoder = Callable[[list], np.ndarray]


def encoded(df: DataFrame, key: str, picture: str, make: Callable[[], Encoder], tokens: int, width: int, batch: int = 64) -> DataFrame:
    """``df`` → rows (key, token, vector), ``tokens`` for each picture, as an encoder gives them.

    ``make`` is called once per task, where the pictures are, so a model is loaded there. ValueError if an encoder gives
    another shape or a number that is not finite. Null pictures give no rows.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                encode = encode or make()
                out = np.asarray(encode(part.column(1).to_pylist()), np.float32)
                if out.shape != (part.num_rows, tokens, width) or not np.isfinite(out).all():
                    raise ValueError(f"the encoder gave {out.shape} for {part.num_rows} pictures, or numbers that are not finite")
                keys = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), tokens)))
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, width), pa.int32()), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.tile(np.arange(tokens), part.num_rows), pa.int32()), vectors], names=[key, "token", "vector"])

    return df.where(F.col(picture).isNotNull()).select(key, picture).mapInArrow(run, f"{key} {kind}, token int, vector array<float>")
