"""Queries by name, gathered from the modules that define them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pathloom.plans import datasets, files, metrics, rollouts  # noqa: F401  they register their queries
from pathloom.plans.registry import ORACLES, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
