"""Streaming twins of the per-step rules: keyed state for a running episode, and windowed counts with late data."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pathloom.operators.prefix import checkpointed, shared_folder
from pathloom.sources import sinks

STATE = "n_steps long, n_away long, n_stuck long, x double, z double, vx double, vz double, ended string"
OUT = "episode_id string, frame_index long, vx double, vz double, n_away long, n_stuck long, cause string"


class EpisodeRules:
    """Early termination and smoothed velocity of the person, step by step.

    Steps of an episode must arrive in order from one batch to the next; within a batch they are sorted.
    """

    def __init__(self, far: float = 4.0, lost_after: int = 20, stuck_after: int = 60, still: float = 1e-4, alpha: float = 0.35, dt: float = 0.1):
        self.far, self.lost_after, self.stuck_after, self.still, self.alpha, self.dt = far, lost_after, stuck_after, still, alpha, dt

    def advance(self, key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, away, stuck, x, z, vx, vz, ended = state.get if state.exists else (0, 0, 0, None, None, None, None, None)
        if ended is not None:
            return
        out, names = [], ["frame_index", "human_following", "dis_to_human", "human_x", "human_z", "human_collision"]
        steps = sorted((r for part in rows for r in zip(*(part[c].tolist() for c in names), strict=True)), key=lambda r: r[0])
        for frame, following, apart, human_x, human_z, collided in steps:
            if x is not None:
                moved = abs(human_x - x) + abs(human_z - z)
                stuck = stuck + 1 if moved < self.still else 0
                raw = ((human_x - x) / self.dt, (human_z - z) / self.dt)
                vx, vz = raw if vx is None else tuple((1 - self.alpha) * old + self.alpha * new for old, new in zip((vx, vz), raw, strict=True))
            x, z, n = float(human_x), float(human_z), n + 1
            if following:
                away = 0
            elif apart > self.far:
                away += 1
            if away > self.lost_after:
                ended = "Lost"
            elif stuck >= self.stuck_after:
                ended = "HumanStuck"
            elif collided:
                ended = "Collision"
            out.append((key[0], int(frame), vx or 0.0, vz or 0.0, away, stuck, ended))
            if ended is not None:
                break
        state.update((n, away, stuck, x, z, vx, vz, ended))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])


def follow_episodes(steps: DataFrame, **limits: float) -> DataFrame:
    """``steps`` (streaming) → state after each step, until the episode ends; keeps one small row per running episode."""
    # states come and go with the batches of rows; a call per key for them is what most of the time went to
    return steps.groupBy("episode_id").applyInPandasWithState(EpisodeRules(**limits).advance, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LIMITS_STATE = "number long, start long, last long, n long"
LIMITED = "{key} long, number long, start_ms long, end_ms long, n_steps long, cause string"


class EpisodeLimits:
    """Closes an episode after a number of steps, a time since its start, or a time of silence; the next step opens another.

    The times are event-time timeouts, so an episode that goes silent is closed once the watermark has passed its deadline, without
    a step of its own. If a later step of the key comes first, in the same batch, it closes it as of the same deadline. Hence the
    result does not depend on how steps fall into batches, as long as no step is older than the watermark.
    One small row per running episode is kept; a batch's steps of a key are held together, which the trigger bounds.
    """

    def __init__(self, key: str, most_steps: int, most_ms: int, silent_ms: int):
        self.key, self.most_steps, self.most_ms, self.silent_ms = key, most_steps, most_ms, silent_ms

    def _deadline(self, start: int, last: int) -> tuple[int, str]:
        return (start + self.most_ms, "seconds") if start + self.most_ms <= last + self.silent_ms else (last + self.silent_ms, "silent")

    def advance(self, key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, start, last, n = state.get if state.exists else (0, 0, 0, 0)
        out, now = [], state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            deadline, cause = self._deadline(start, last)
            if n and deadline <= now:
                out.append((key[0], number, start, deadline, n, cause))
                number, n = number + 1, 0
        else:
            for ms in sorted(x for r in rows for x in r["ms"].tolist()):
                if n:
                    deadline, cause = self._deadline(start, last)
                    if ms >= deadline:
                        out.append((key[0], number, start, deadline, n, cause))
                        number, n = number + 1, 0
                start, last, n = (start if n else ms), ms, n + 1
                if n == self.most_steps:
                    out.append((key[0], number, start, ms, n, "steps"))
                    number, n = number + 1, 0
        state.update((number, start, last, n))
        if n:  # a timeout is called once the watermark is past it, a deadline is reached with it
            state.setTimeoutTimestamp(max(self._deadline(start, last)[0] - 1, now, 1))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in LIMITED.format(key=self.key).split(", ")])


def limited_episodes(steps: DataFrame, key: str, time: str, late: str, most_steps: int, most_seconds: float, silent_seconds: float) -> DataFrame:
    """``steps`` (streaming) → the episodes that are closed: (key, number, start_ms, end_ms, n_steps, cause)."""
    limits = EpisodeLimits(key, most_steps, int(most_seconds * 1000), int(silent_seconds * 1000))
    timed = steps.withWatermark(time, late).select(F.col(key).cast("long").alias(key), time, F.unix_millis(time).alias("ms"))
    return timed.groupBy(key).applyInPandasWithState(limits.advance, LIMITED.format(key=key), LIMITS_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def streamed_in_runs(spark: SparkSession, slices: list[DataFrame], plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the stream ``plan`` has put out after reading ``slices``, each in a run of its own: the query is stopped and started again from its state."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        for df in slices:
            df.write.mode("append").parquet(f"{root}/in")
            source = spark.readStream.schema(slices[0].schema).parquet(f"{root}/in")
            run = plan(source).writeStream.outputMode("append").format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
            run.awaitTermination()
        return checkpointed(spark.read.parquet(f"{root}/out"))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
        if sinks.exists(spark, root):
            sinks.remove(spark, root)


def windowed_counts(events: DataFrame, time: str, size: str, late: str, keys: list[str]) -> DataFrame:
    """Counts and value sums per event-time window, with events later than ``late`` dropped from closed windows."""
    w = events.withWatermark(time, late).groupBy(F.window(time, size), *keys)
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def append_once(path: str):
    """A sink for ``foreachBatch`` that replaces a batch's own folder, so a repeated batch is written once."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return put


def collected(spark: SparkSession, path: str, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the stream ``plan`` over the Parquet files at ``path`` has put out once all that is there is read."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")
    try:
        run = plan(source).writeStream.outputMode("append").format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        return checkpointed(spark.read.parquet(f"{root}/out"))
    finally:
        if sinks.exists(spark, root):
            sinks.remove(spark, root)
