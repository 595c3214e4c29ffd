"""Difference hashes of small grey pictures, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows and compared columns of a picture; it is one pixel wider.
SIDE = 8


def difference_hash(pixels: Column) -> Column:
    """16 hex digits of a row-major 9 by 8 picture: a bit is set where a pixel is brighter than the next of its row.

    The first comparison is the highest bit. Null where the picture does not have 72 pixels.
    """
    def bit(place: Column) -> Column:
        at = (F.floor(place / SIDE) * (SIDE + 1) + place % SIDE).cast("int")
        return (F.get(pixels, at) > F.get(pixels, at + 1)).cast("int")

    def digit(i: Column) -> Column:
        value = sum((bit(4 * i + j) * (1 << (3 - j)) for j in range(4)), F.lit(0))
        return F.lower(F.hex(value.cast("long")))

    digits = F.transform(F.sequence(F.lit(0), F.lit(SIDE * SIDE // 4 - 1)), digit)
    return F.when(F.size(pixels) == SIDE * (SIDE + 1), F.array_join(digits, ""))
