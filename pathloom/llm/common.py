"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of up to so many rows of a few numbers, which are counted, are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1 << 20
#: Rows of a few numbers that one task takes: a table that is counted has no more partitions than such tasks.
TASK_ROWS = 1 << 17


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset a new local one, in local mode only (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint, which outlives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list:
    """A text or binary column as a list, with null as the empty value."""
    empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
    return [empty if x is None else x for x in column.to_pylist()]


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, made longer until no column of ``frames`` has it, whatever its case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def on_cores(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than there are cores, for reading a table that is cut: small partitions cost a task each."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def in_few(df: DataFrame, rows: int, each: int = TASK_ROWS, least: int = 1) -> DataFrame:
    """``df``, known to have up to so many ``rows``, in no more partitions than they ask for; ``least`` of them where it is made from larger tables."""
    return df.coalesce(max(least, -(-rows // each)))


def if_small(df: DataFrame) -> DataFrame:
    """``df``, which should be cut, with a hint to broadcast it if its count allows."""
    rows = on_cores(df).limit(BROADCAST_ROWS + 1).count()
    return F.broadcast(in_few(df, rows)) if rows <= BROADCAST_ROWS else df


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are in ``gone(doc_id, text_hash)``; rows without an id stay."""
    a, b = unused("gone_id", docs), unused("gone_hash", docs)
    side = gone.where("doc_id is not null").select(F.col("doc_id").alias(a), F.col("text_hash").alias(b))
    return docs.join(if_small(cut(side.distinct())), (F.col("doc_id").cast("long") == F.col(a)) & (text_hash() == F.col(b)), "left_anti")


def text_hash():
    """A hash of the column ``text``, which tells apart the texts of one id."""
    return F.xxhash64(F.col("text").cast("binary"))


def key_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of batches sorted by the first, cut so that no key is parted."""
    carry: list[list[np.ndarray]] = []
    for b in batches:
        if not b.num_rows:
            continue
        now = [b.column(c).to_numpy(zero_copy_only=False) for c in range(b.num_columns)]
        if now[0][0] == now[0][-1] and (not carry or carry[-1][0][-1] == now[0][0]):
            carry.append(now)
            continue
        last = int(np.flatnonzero(now[0] != now[0][-1])[-1]) + 1
        yield [np.concatenate(x) for x in zip(*carry, [x[:last] for x in now], strict=True)]
        carry = [[x[last:] for x in now]]
    if carry:
        yield [np.concatenate(x) for x in zip(*carry, strict=True)]


Batches = Iterator[pa.RecordBatch]


def in_parts(run: Callable[[Batches], Batches], rows: int = 1024) -> Callable[[Batches], Batches]:
    """A function for ``mapInArrow`` that is given ``rows`` rows at a time, and whose worker returns its free memory at the end.

    Workers are kept for later stages, so what one stage leaves allocated would add up with what the next one needs.
    """

    @functools.wraps(run)
    def wrapped(batches: Batches) -> Batches:
        yield from run(b.slice(at, rows) for b in batches for at in range(0, max(b.num_rows, 1), rows))
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return wrapped


def kept_rows(batch: pa.RecordBatch, keep: list[bool]) -> pa.RecordBatch:
    return batch.filter(pa.array(keep, pa.bool_()))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if it is read in fewer parts than there are, as from one small file; else as it is.

    A table of many files or row groups is thus never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
