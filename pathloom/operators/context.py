"""Token-budgeted history indexes: how much history fits, which frames, and their flat layout."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.operators.prefix import running_before
from pathloom.operators.sequence import steps


def blocks_plain(budget: int, current: int = 64, block: int = 4) -> int:
    """History frames that fit beside the current frame's tokens."""
    return max(0, (budget - current) // block)


def blocks_marked(budget: int, cameras: int = 1) -> int:
    """The same where each frame and block of each camera carries a marker token."""
    return max(0, (budget - 65 * cameras) // (5 * cameras))


def counts(frames: DataFrame, budget: int, current: int = 64, block: int = 4) -> DataFrame:
    """History length and tokens of every frame as an anchor; position is enough, no frame is gathered."""
    place = F.row_number().over(steps()) - 1
    n = F.least(place, F.lit(blocks_plain(budget, current, block))).cast("long")
    return frames.select("*", n.alias("n_blocks")).withColumn("total_tokens", F.lit(current) + F.col("n_blocks") * block)


def blocks_of_episode(length: Column, n: int) -> Column:
    """Blocks of all anchors of an episode, in closed form."""
    r = F.least(length - 1, F.lit(n))
    return r * (r + 1) / 2 + F.greatest(F.lit(0), length - 1 - r) * n


def references(frames: DataFrame, n: int, cameras: list[str]) -> DataFrame:
    """One row per anchor, selected frame and camera, oldest first: step, camera and reference.

    ``step`` numbers the selected frames, ``token_count_after`` the blocks up to the row. Only here is history exploded.
    """
    got = frames.select("episode_id", "frame_index", F.collect_list("frame_index").over(steps().rowsBetween(-n, -1)).alias("chosen"))
    rows = got.select("episode_id", "frame_index", F.posexplode("chosen").alias("step", "ref_frame"))
    names = F.array(*map(F.lit, cameras))
    rows = rows.select("*", F.posexplode(names).alias("camera_index", "camera"))
    rows = rows.withColumn("ref", F.format_string("%s/%06d/%s", "episode_id", "ref_frame", "camera"))
    return rows.withColumn("token_count_after", F.col("step") * len(cameras) + F.col("camera_index") + 1)


def offsets(counted: DataFrame, order: list[str], count: str = "n_blocks") -> DataFrame:
    """Where each anchor's blocks start in the flat array: totals per episode first, then within each episode."""
    totals = counted.groupBy("episode_id", order[0]).agg(F.sum(count).alias("total"))
    starts = running_before(totals, [order[0]], F.col("total"), "start").select("episode_id", "start")
    inside = F.coalesce(F.sum(count).over(Window.partitionBy("episode_id").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.join(starts, "episode_id").withColumn("offset", F.col("start") + inside).drop("start")


def violations(index: DataFrame, order: list[str], budget: int, current: int = 64, block: int = 4) -> DataFrame:
    """One row of counts, all zero for a sound index: gaps between offsets, too long histories, wrong token sums."""
    ends = F.col("offset") + F.col("n_blocks")
    near = Window.partitionBy("episode_id").orderBy("frame_index")
    first = index.groupBy("episode_id", order[0]).agg(F.min("offset").alias("start"), F.max(ends).alias("end"))
    # the episodes follow on one another: each start is the end of one, but the first
    chained = first.select(F.col("start").alias("at")).where("at > 0").exceptAll(first.select(F.col("end").alias("at")))
    inner = index.withColumn("bad", (F.lag(ends).over(near) != F.col("offset")).cast("long"))
    sums = inner.agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("gaps"), F.count_if(F.col("n_blocks") > blocks_plain(budget, current, block)).alias("too_long"),
        F.count_if(F.col("total_tokens") != current + F.col("n_blocks") * block).alias("wrong_tokens"), F.sum("n_blocks").alias("total_blocks"),
    )
    return sums.crossJoin(chained.agg(F.count("*").alias("loose_episodes")))


def estimate(frames: DataFrame, n: int, bytes_per_block: int = 21) -> DataFrame:
    """Size of an index without building it."""
    lengths = frames.groupBy("episode_id").agg(F.count("*").alias("length"))
    blocks = F.sum(blocks_of_episode(F.col("length"), n)).cast("long")
    return lengths.agg(F.count("*").alias("n_episodes"), F.sum("length").alias("n_frames"), F.sum(F.greatest(F.lit(0), F.col("length") - 1)).cast("long").alias("n_refs"), blocks.alias("n_blocks"), (blocks * bytes_per_block).alias("n_bytes"))


def decay_rate(history: int, budget: int, cameras: int = 1) -> float:
    """Rate at which an exponential selection over ``history`` frames expects to keep what the budget holds."""
    if history <= 0:
        return 0.0
    target = min(float(history), max(0.0, (budget - 65 * cameras) / (5 * cameras)))
    if target <= history * 0.1:
        return 1.0e6
    if target >= history:
        return 0.0
    expected = lambda k: history * (0.9 * -math.expm1(-k) / k + 0.1)  # noqa: E731  falls with k
    low, high = 1e-12, 1.0
    while expected(high) > target:
        high *= 2
    for _ in range(100):
        k = (low + high) / 2
        low, high = (k, high) if expected(k) > target else (low, k)
    return (low + high) / 2


def decay_rates(spark: SparkSession, longest: int, budget: int, cameras: int = 1) -> DataFrame:
    """Rates by anchor position: a table of at most an episode's step limit."""
    return spark.createDataFrame([(a, decay_rate(a, budget, cameras)) for a in range(longest + 1)], "anchor long, rate double")


def keep_probability(frame: Column, anchor: Column, rate: Column) -> Column:
    return F.exp(rate * (frame - anchor) / F.greatest(F.lit(1.0), anchor.cast("double"))) * 0.9 + 0.1


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 16-digit hexadecimal hashes, by halves."""
    half = lambda x, at: F.conv(F.substring(x, at, 8), 16, 10).cast("long")
    return F.bit_count(half(a, 1).bitwiseXOR(half(b, 1))) + F.bit_count(half(a, 9).bitwiseXOR(half(b, 9)))


def history_scores(frames: DataFrame, n: int, time: str = "timestamp_s") -> DataFrame:
    """One row per anchor and selected frame, the last ``n`` before it, oldest first: score 1, distance 64 for the oldest and 0 for the others."""
    item = F.struct("frame_index", F.col(time).alias("timestamp"))
    got = frames.select("episode_id", "frame_index", F.collect_list(item).over(steps().rowsBetween(-n, -1)).alias("chosen"))
    rows = got.select("episode_id", "frame_index", F.posexplode("chosen").alias("step", "c"))
    return rows.select("episode_id", "frame_index", "step", F.col("c.frame_index").alias("ref_frame"), "c.timestamp", F.lit(1.0).alias("score"), F.when(F.col("step") == 0, 64).otherwise(0).alias("distance"))


def context_rows(selected: DataFrame, cameras: list[str]) -> DataFrame:
    """``selected(episode_id, frame_index, step, ref_frame, …)`` for each camera: block number, reference, and a mask that is always on."""
    rows = selected.select("*", F.posexplode(F.array(*map(F.lit, cameras))).alias("camera_index", "camera"))
    ref = F.format_string("%s/%06d/%s", "episode_id", "ref_frame", "camera")
    return rows.withColumns({"block": F.col("step") * len(cameras) + F.col("camera_index"), "ref": ref, "mask": F.lit(True)})


def bats_selection(frames: DataFrame, budget: int, cameras: int = 1, dedup: bool = False, threshold: int = 10) -> DataFrame:
    """Per anchor the frames of highest keep probability that the budget holds, later ones first among equals: rows of
    episode_id, frame_index, step, ref_frame, score, distance, oldest first.

    The probability never falls towards the anchor, so the highest are the latest, and no history is sorted. Distances
    are 64 for the latest and 0 for the others; with ``dedup`` they are those of the hashes, as in ``deduplicated_history``,
    which then also decides what is skipped.
    """
    n = blocks_marked(budget, cameras)
    placed = frames.withColumn("place", (F.row_number().over(steps()) - 1).cast("long"))
    longest = placed.agg(F.max("place")).first()[0] or 0
    rates = F.broadcast(decay_rates(frames.sparkSession, longest, budget, cameras))  # one row per step of the longest rollout
    # an anchor's rate goes along with it: the exploded history is joined to nothing, since Spark takes it for small and would broadcast it
    if dedup:
        chosen = deduplicated_history(frames, n, threshold, places=True).withColumnRenamed("kept_frame", "ref_frame")
        scored = chosen.join(rates, F.col("place") == F.col("anchor"))
    else:
        rated = placed.join(rates, F.col("place") == F.col("anchor"))
        got = rated.select("episode_id", "frame_index", "rate", F.collect_list("frame_index").over(steps().rowsBetween(-n, -1)).alias("chosen"))
        rows = got.select("episode_id", "frame_index", "rate", F.size("chosen").alias("n"), F.posexplode("chosen").alias("step", "ref_frame"))
        scored = rows.withColumn("distance", F.when(F.col("step") == F.col("n") - 1, 64).otherwise(0))
    return scored.select("episode_id", "frame_index", "step", "ref_frame", keep_probability(F.col("ref_frame"), F.col("frame_index"), F.col("rate")).alias("score"), "distance")


def _episodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by their first column, one for each of its values."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        keys = b.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for at, end in zip(cuts, cuts[1:], strict=False):
            if held and end > at and held[0].column(0)[0].as_py() != keys[at]:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            if end > at:
                held.append(b.slice(at, end - at))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def deduplicated_history(frames: DataFrame, n: int, threshold: int = 10, places: bool = False) -> DataFrame:
    """Greedy selection per anchor through all its history, from newest to oldest: a frame is kept if its hash is farther
    than ``threshold`` from the last kept one, until ``n`` are. Rows (episode_id, frame_index, step, kept_frame, distance),
    oldest first; the newest kept has distance 64. With ``places`` also place, that of the anchor in its episode, from 0.

    Which frame follows a kept one does not depend on the anchor: it is found once per frame, and the anchors go along.
    """
    schema = "episode_id string, frame_index long, step int, kept_frame long, distance int" + (", place long" if places else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _episodes(batches):
            frame, high, low = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            follows, apart = np.full(len(frame), -1), np.zeros(len(frame), np.int32)
            for j in range(1, len(frame)):
                for at in range(j, 0, -256):  # back in pieces, since a frame that differs is mostly near
                    part = slice(max(at - 256, 0), at)
                    d = np.bitwise_count(high[part] ^ high[j]) + np.bitwise_count(low[part] ^ low[j])
                    if (far := np.flatnonzero(d > threshold)).size:
                        follows[j], apart[j] = part.start + far[-1], d[far[-1]]
                        break
            now, distance, found = np.arange(len(frame)) - 1, np.full(len(frame), 64, np.int32), []
            for _ in range(n):
                anchors = np.flatnonzero(now >= 0)
                if not len(anchors):
                    break
                found.append((anchors, now[anchors], distance[anchors]))
                distance[anchors], now[anchors] = apart[now[anchors]], follows[now[anchors]]
            if not found:
                continue
            anchor, kept, distance = (np.concatenate(x) for x in zip(*found, strict=True))
            step = np.bincount(anchor, minlength=len(frame))[anchor] - 1 - np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
            columns = [pa.array([b.column(0)[0].as_py()] * len(anchor), pa.string()), pa.array(frame[anchor]), pa.array(step, pa.int32()), pa.array(frame[kept]), pa.array(distance, pa.int32())]
            if places:
                columns.append(pa.array(anchor, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    half = lambda at: F.conv(F.substring("front_dhash", at, 8), 16, 10).cast("long")
    rows = frames.select(F.col("episode_id").cast("string"), F.col("frame_index").cast("long"), half(1).alias("high"), half(9).alias("low"))
    return rows.repartition("episode_id").sortWithinPartitions("episode_id", "frame_index").mapInArrow(run, schema)
