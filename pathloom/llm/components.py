"""Connected components of a distributed edge table, by alternating stars.

Each round first hangs every larger neighbour on the smallest one it can see
(large star), then every smaller neighbour and the node itself (small star).
Minima are partial aggregates and joins, so a node with very many edges is
never gathered in one task. Each round ends in a reliable checkpoint; rounds
grow with the logarithm of the longest chain. Edges are counted in each round and
held in as few partitions as they ask for, so few edges cost few tasks and files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import cut, in_few, on_cores


def _stars(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    if large:
        near = in_few(edges.unionByName(back), rows)
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return in_few(in_few(out, rows).where("u <> v").distinct(), rows)


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` → ``(node, root)``: for each node of an edge the smallest node it reaches.

    Nulls, self-loops, repeated and reversed edges are harmless; no edges give no rows.
    """
    edges = edges.where("u is not null and v is not null and u <> v")
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = on_cores(edges).agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        edges = in_few(edges, state[0])
        if state == seen or state[0] == 0:
            break
        seen = state
        edges = cut(_stars(_stars(edges, True, 2 * state[0]), False, 2 * state[0]))
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
