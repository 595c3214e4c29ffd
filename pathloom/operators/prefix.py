"""Global running numbers without a window over the whole table.

Rows are range-partitioned once; sums per partition (as many as partitions) get
their running total, which each partition's own running sum is added to.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset a new local one, in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


#: Tables of up to so many rows of a few numbers or names, which are counted, are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1 << 20


def if_small(df: DataFrame) -> DataFrame:
    """``df``, which should be checkpointed, with a hint to broadcast it if its count allows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def running_before(df: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows before each in ``order`` (unique, ascending)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("__v", value.cast("long")).repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id())
    dealt = checkpointed(dealt)  # the ranges are sampled, so they are fixed here
    parts = dealt.groupBy("__part").agg(F.sum("__v").alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))  # one row per partition
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.coalesce(F.sum("__v").over(inside), F.lit(0)))
    return out.drop("__part", "__start", "__v")
