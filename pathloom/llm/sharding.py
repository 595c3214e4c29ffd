"""Sharding by extendible hashing: a directory over hash-prefix bits.

A key's hash is a 60-bit number, the start of its MD5. The directory begins as
one bucket; a bucket with more bytes than a shard may have splits on its next
bit, and only such a bucket. Byte sums of fine prefixes are aggregated once;
they sum up to those of every coarser prefix, so the depth at which a bucket
first fits is found on that small table without passing over the rows again,
a few bits at a time: each subtree of so many bits is one small group, and only
its root's sum goes on. Prefixes that are still too large at the finest depth,
as with a hot key, go on with deeper bits of their rows only. Rows that no bit
can part, as they share all bits, overflow into chains of pages of their
bucket, as many chains as their bytes need; equal sizes in a chain are ordered
by their rows' hashes.

Shards are named by their bits (``""`` is the undivided bucket), ``~n`` added
for a page of a chain, and hold at most ``limit`` bytes unless one row alone
is larger, which is then a shard by itself.

Defined cases: null keys hash as the empty string; null text has no bytes;
rows that repeat a key share a bucket or its chains; an empty table gives an
empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.llm.common import cut, unused

#: Bits of a key's hash; fifteen hexadecimal digits, which a signed long can hold.
BITS = 60
#: Bits beyond those that even shares would need, read from the rows at once.
SPARE = 6
#: Bits of a subtree that is settled at once.
SUBTREE = 10
#: Shards, and rows too large for any, that one chain of pages holds, about.
CHAIN_SHARDS, CHAIN_ROWS = 64, 4096


def key_hash(key: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _shift(x: Column, by: Column | int) -> Column:
    return F.call_function("shiftright", x, F.lit(by) if isinstance(by, int) else by)


def _fitting(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """``cells(prefix, bytes)`` at depth ``high`` → ``(prefix, depth)``: the depth at which each first fits, null if beyond ``high``."""
    top = max(low, high - SUBTREE)

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        prefix, size = pdf["prefix"].to_numpy(), pdf["bytes"].to_numpy()
        leaf = np.full(len(prefix), -1)
        for depth in range(top, high + 1):
            _, bucket = np.unique(prefix >> (high - depth), return_inverse=True)
            sums = np.zeros(len(prefix), np.int64)
            np.add.at(sums, bucket, size)
            leaf = np.where((leaf < 0) & (sums[bucket] <= limit), depth, leaf)
        return pd.DataFrame({"prefix": prefix, "leaf": pd.array(np.where(leaf < 0, None, leaf), "Int32")})

    root = _shift(F.col("prefix"), high - top)
    own = cells.select("prefix", "bytes").groupBy(root.alias("root")).applyInPandas(settle, "prefix long, leaf int")
    if top == low:
        return own.withColumnRenamed("leaf", "depth")
    # a subtree that fits as a whole is a part of a coarser one
    above = _fitting(cut(cells.groupBy(root.alias("prefix")).agg(F.sum("bytes").alias("bytes"))), low, top, limit)
    joined = own.withColumn("root", root).join(above.select(F.col("prefix").alias("root"), "depth"), "root", "left")
    return joined.select("prefix", F.when(F.col("leaf") == top, F.col("depth")).otherwise(F.col("leaf")).alias("depth"))


def _directories(slim: DataFrame, limit: int) -> tuple[list[tuple[int, DataFrame, int]], int]:
    """Directories (their depth, ``(prefix, leaf)``, entries), each for the buckets that the one before leaves open (null leaf).

    And the bytes of the largest bucket that no bit can part, or 0.
    """
    out, left, low = [], slim.where(F.col("bytes") <= limit), 0
    most = left.agg(F.sum("bytes")).first()[0] or 0
    while True:
        high = min(BITS, low + max(1, -(-most // limit)).bit_length() + SPARE)
        cells = cut(left.groupBy(_shift(F.col("hash"), BITS - high).alias("prefix")).agg(F.sum("bytes").alias("bytes")))
        found = cut(_fitting(cells, low, high, limit))
        deepest, n_open = found.agg(F.max("depth"), F.count_if(F.col("depth").isNull())).first()
        depth = high if n_open or deepest is None else deepest
        directory = cut(found.select(_shift(F.col("prefix"), high - depth).alias("prefix"), F.col("depth").alias("leaf")).distinct())
        out.append((depth, directory, directory.count()))
        if not n_open:
            return out, 0
        open_ = found.where("depth is null").select("prefix")
        most = cells.join(open_, "prefix").agg(F.max("bytes")).first()[0]
        if high == BITS:
            return out, most
        left = left.join(open_, _shift(F.col("hash"), BITS - high) == F.col("prefix"), "left_semi")
        low = high + 1


def assign(rows: DataFrame, key: str, size: Column, limit: int, broadcast_entries: int = 500_000) -> DataFrame:
    """``rows`` with ``shard`` (string), ``depth`` (int) and ``row_bytes`` (long); columns of these names are replaced.

    ``size`` is the expression of a row's bytes, ``limit`` the bytes of a shard. A
    directory of at most ``broadcast_entries`` entries, which are counted, is
    broadcast to the rows; a larger one is joined on its prefixes.
    """
    made = ("shard", "depth", "row_bytes")
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in made]
    hash_, salt = unused("key_hash", rows), unused("salt", rows)
    base = rows.select(*kept, F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("row_bytes"), key_hash(F.col(f"`{key}`")).alias(hash_))
    slim = cut(base.select(F.col(hash_).alias("hash"), F.col("row_bytes").alias("bytes")))
    directories, hot = _directories(slim, limit)
    leaf = F.lit(None).cast("int")
    for i, (depth, directory, entries) in enumerate(directories):
        prefix, own = unused(f"prefix_{i}", rows), unused(f"leaf_{i}", rows)
        side = directory.select(F.col("prefix").alias(prefix), F.col("leaf").alias(own))
        side = F.broadcast(side) if entries <= broadcast_entries else side
        base = base.join(side, _shift(F.col(hash_), BITS - depth) == F.col(prefix), "left")
        leaf = F.coalesce(leaf, F.col(own))
    placed = base.withColumn("depth", F.when(F.col("row_bytes") <= limit, leaf))
    bits = F.lpad(F.bin(hash_), BITS, "0")
    columns = [*kept, *map(F.col, made)]
    fitting = placed.where("depth is not null").withColumn("shard", F.substring(bits, F.lit(1), F.col("depth"))).select(*columns)
    large = slim.where(F.col("bytes") > limit).count()
    if not large and not hot:
        return fitting
    # rows that no bit can part: pages of their bucket; half a shard a page leaves room for the row that crosses its end
    salts = 1 + max(hot // (CHAIN_SHARDS * limit), large // CHAIN_ROWS)
    over = cut(placed.where("depth is null").drop("depth").withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(salts))))  # the salts are fixed here
    comparable = [F.col(f"`{c}`") for c, kind in over.dtypes if "map<" not in kind and "variant" not in kind]
    big = F.col("row_bytes") * 2 > limit
    chain = Window.partitionBy(hash_, salt, big).orderBy("row_bytes", F.xxhash64(*comparable))
    running = F.sum("row_bytes").over(chain.rowsBetween(Window.unboundedPreceding, 0))
    page = F.when(big, F.concat(F.lit("r"), F.row_number().over(chain).cast("string"))).otherwise(F.floor(running / F.lit(max(limit // 2, 1))).cast("string"))
    name = F.concat(bits, F.lit("~"), F.col(salt).cast("string"), F.lit("."), page)
    paged = over.withColumn("shard", name).withColumn("depth", F.lit(BITS)).select(*columns)
    return fitting.unionByName(paged)


def manifest(assigned: DataFrame) -> DataFrame:
    """Rows and bytes of each shard."""
    return assigned.groupBy("shard", "depth").agg(F.count("*").alias("n_rows"), F.sum("row_bytes").alias("n_bytes"))


def write(assigned: DataFrame, path: str) -> None:
    """One folder per shard under ``path``, in Parquet; a shard is within the limit, so it is one task's work."""
    assigned.repartition("shard").write.partitionBy("shard").mode("overwrite").parquet(path)
