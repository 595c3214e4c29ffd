"""Versions of a table beside each other, and numbered pointers to them, so that a reader finds a whole one at any moment.

``target/versions/NAME`` holds a version; ``target/pointers/NUMBER`` is a file with the name of one. A version is built
under a stage name, checked, and moved to its name; then a pointer with the next number is created, which fails if
another publisher has taken that number, and the next one is tried. Readers take the highest pointer that is whole.
Pointers are never written over: a rename that overwrites is not one step in every store, and creating a file is.

Rule for old versions: those that none of the last ``keep`` pointers names are removed after a publish, and with them their
pointers. A reader that has resolved a version can read it until ``keep`` further ones are published. Failed builds leave all as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from pathloom.sources import sinks


def pointers(spark: SparkSession, target: str) -> list[tuple[int, str]]:
    """(number, version's name) of all whole pointers, newest first. Their number is bounded by what publishing keeps."""
    fs, folder = sinks.file_system(spark, f"{target.rstrip('/')}/pointers")
    if not fs.exists(folder):
        return []
    found = []
    for f in fs.listStatus(folder):
        if f.getPath().getName().isdigit():
            text = sinks.read_small(spark, f.getPath().toString()).decode()
            if text.endswith("\n"):  # else it is being written
                found.append((int(f.getPath().getName()), text.strip()))
    return sorted(found, reverse=True)


def current(spark: SparkSession, target: str) -> str:
    """The path of the newest version; FileNotFoundError if none was published."""
    found = pointers(spark, target)
    if not found:
        raise FileNotFoundError(f"{target} has no version")
    return f"{target.rstrip('/')}/versions/{found[0][1]}"


def read(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(current(spark, target))


def _point(spark: SparkSession, target: str, name: str) -> int:
    """Create the next pointer; a number that somebody else takes meanwhile is passed over."""
    number = max([n for n, _ in pointers(spark, target)], default=0) + 1
    while True:
        fs, p = sinks.file_system(spark, f"{target}/pointers/{number:012d}")
        try:
            out = fs.create(p, False)
        except Py4JJavaError as e:
            if not fs.exists(p):
                raise e
            number += 1
            continue
        try:
            out.write(bytearray(f"{name}\n".encode()))
        finally:
            out.close()
        return number


def publish(spark: SparkSession, target: str, build: Callable[[str], None], validate: Callable[[str], None] | None = None, keep: int = 2) -> str:
    """Build a version, check it, point to it; its path."""
    if keep < 1:
        raise ValueError("the newest version is always kept")
    target = target.rstrip("/")
    stage, name = f"{target}/_stage-{uuid.uuid4().hex}", uuid.uuid4().hex
    try:
        build(stage)
        if validate:
            validate(stage)
        sinks.make_folder(spark, f"{target}/versions")
        sinks.move(spark, stage, f"{target}/versions/{name}")
    finally:
        if sinks.exists(spark, stage):
            sinks.remove(spark, stage)
    _point(spark, target, name)
    prune(spark, target, keep)
    return f"{target}/versions/{name}"


def rollback(spark: SparkSession, target: str, steps: int = 1) -> str:
    """Point to the version that was current ``steps`` pointers ago, if it is still kept."""
    target = target.rstrip("/")
    found = pointers(spark, target)
    if len(found) <= steps:
        raise FileNotFoundError(f"{target} keeps {len(found)} versions")
    _point(spark, target, found[steps][1])
    return f"{target}/versions/{found[steps][1]}"


def prune(spark: SparkSession, target: str, keep: int) -> int:
    """Remove versions that none of the last ``keep`` pointers names; how many were removed."""
    found = pointers(spark, target)
    live, gone = {name for _, name in found[:keep]}, found[keep:]
    for number, _ in gone:  # pointers first: no pointer names a version that is not there
        sinks.remove(spark, f"{target}/pointers/{number:012d}")
    dropped = {name for _, name in gone} - live
    for name in dropped:
        sinks.remove(spark, f"{target}/versions/{name}")
    return len(dropped)
