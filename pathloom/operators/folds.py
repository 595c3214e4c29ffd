"""Measures with a state of their own: reset, update, merge and result, folded in pieces and merged in order.

A measure's rows are dealt in ranges of (keys, order), so a key however large is parted over tasks. Each task folds
the stretches of keys that it has, row by row, into one state each; the states of a key, few and small, are then
merged in the order of their stretches. ``merge`` must be associative; it need not be commutative.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame


class Measure(Protocol):
    """A state is anything that JSON can hold."""

    def reset(self) -> Any:
        """The state before any row."""

    def update(self, state: Any, row: dict) -> Any:
        """The state after a row."""

    def merge(self, left: Any, right: Any) -> Any:
        """The state of two stretches, the left one before the right one."""

    def result(self, state: Any) -> float | None:
        """The measure's value."""


@dataclass(frozen=True)
class Patience:
    """A meter that each row moves by ``step(row)`` and that stays within its bounds.

    What a stretch of rows does to the meter is a clipped shift, x to min(high, max(low, x + shift)), and shifts of this
    kind follow one another as one of the same kind; so stretches can be folded before the value they start from is known.
    """

    step: Callable[[dict], float]
    low: float = 0.0
    high: float = 10.0
    start: float = 0.0

    def reset(self) -> list[float]:
        return [0.0, self.low, self.high]

    def update(self, state: list[float], row: dict) -> list[float]:
        return self.merge(state, [float(self.step(row)), self.low, self.high])

    def merge(self, left: list[float], right: list[float]) -> list[float]:
        (a, low, high), (b, own_low, own_high) = left, right
        clip = lambda x: min(own_high, max(own_low, x))
        return [a + b, clip(low + b), clip(high + b)]

    def result(self, state: list[float]) -> float:
        shift, low, high = state
        return min(high, max(low, self.start + shift))


def measured(df: DataFrame, keys: list[str], order: list[str], columns: list[str], measure: Measure, name: str) -> DataFrame:
    """(keys, ``name``): the measure of each key's rows in ``order``, which is unique within a key. ``columns`` are what ``update`` sees."""
    wanted = list(dict.fromkeys([*keys, *order, *columns]))
    fields = {f.name: f.dataType.simpleString() for f in df.select(*wanted).schema}
    states = ", ".join(f"`{k}` {fields[k]}" for k in [*keys, *order]) + ", __state string"
    if not keys:
        raise ValueError("a measure is of a key's rows")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per stretch of a key: its first place in the order, and its state."""
        held, head, state = None, None, None
        out: list[tuple] = []

        def shut(rows: list[tuple]) -> pa.RecordBatch:
            data = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(data, [*kinds, pa.string()], strict=True)], names=[*keys, *order, "__state"])

        kinds: list[pa.DataType] = []
        for b in batches:
            kinds = [b.schema.field(c).type for c in [*keys, *order]]
            for row in b.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != held or head is None:
                    if head is not None:
                        out.append((*head, json.dumps(state)))
                    held, state = key, measure.reset()
                    head = (*key, *(row[o] for o in order))
                state = measure.update(state, row)
            if len(out) >= 4096:
                yield shut(out)
                out = []
        if head is not None:
            out.append((*head, json.dumps(state)))
        if out:
            yield shut(out)

    def join(stretches: pa.Table) -> pa.Table:
        ordered = stretches.sort_by([(o, "ascending") for o in order])
        state = None
        for own in ordered.column("__state").to_pylist():
            state = json.loads(own) if state is None else measure.merge(state, json.loads(own))
        value = pa.array([measure.result(state)], pa.float64())
        return pa.table([*(ordered.column(k).slice(0, 1) for k in keys), value], names=[*keys, name])

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(*wanted).repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(fold, states).groupBy(*keys).applyInArrow(join, ", ".join(f"`{k}` {fields[k]}" for k in keys) + f", `{name}` double")
