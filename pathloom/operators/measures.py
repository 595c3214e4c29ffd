"""Named measures over a table, each a column that may use the measures before it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame


class Measures:
    """Measures in the order of their registration; what one needs must be registered before it."""

    def __init__(self) -> None:
        self.columns: dict[str, Callable[[], Column]] = {}

    def add(self, name: str, column: Callable[[], Column], needs: tuple[str, ...] = ()) -> Measures:
        """``column`` builds the expression when it is applied, so none is needed without a session."""
        if name in self.columns:
            raise ValueError(f"two measures are named {name}")
        missing = [x for x in needs if x not in self.columns]
        if missing:
            raise ValueError(f"{name} needs {', '.join(missing)} before it")
        self.columns[name] = column
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with a column per measure."""
        for name, column in self.columns.items():
            df = df.withColumn(name, column())
        return df
