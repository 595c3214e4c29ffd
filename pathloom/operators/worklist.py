"""Joins from references to frames to source videos, each asserted one to one, and the sharded layout of the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.operators.prefix import running_before

#: Column order of a worklist.
COLUMNS = ["ref_id", "ref", "episode_id", "frame_index", "camera_name", "data_index", "video_key", "video_frame_index", "chunk_index", "file_index", "video_path"]


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def assert_unique(df: DataFrame, keys: list[str], label: str) -> None:
    if not duplicates(df, keys).isEmpty():
        raise ValueError(f"{label} repeats keys of {', '.join(keys)}")


def require_columns(df: DataFrame, names: list[str], label: str) -> None:
    """The columns must be there and hold no null."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"{label} lacks {', '.join(missing)}")
    if not df.where(" OR ".join(f"`{n}` IS NULL" for n in names)).isEmpty():
        raise ValueError(f"{label} holds nulls in {', '.join(names)}")


def video_path(key: Column, chunk: Column, file: Column) -> Column:
    return F.format_string("videos/%s/chunk-%03d/part-%03d.mp4", key, chunk, file)


def assemble(refs: DataFrame, frame_records: DataFrame, video_index: DataFrame) -> DataFrame:
    """refs ⨝ frames on (episode, frame) ⨝ videos on the data index. Each right side at most once per key; ``audit`` tells."""
    frames = frame_records.select("episode_id", "frame_index", "data_index")
    videos = video_index.select("data_index", "video_key", "video_frame_index", "chunk_index", "file_index")
    joined = refs.join(frames, ["episode_id", "frame_index"]).join(videos, "data_index")
    return joined.withColumn("video_path", video_path(F.col("video_key"), F.col("chunk_index"), F.col("file_index"))).select(*COLUMNS)


def audit(refs: DataFrame, frame_records: DataFrame, video_index: DataFrame) -> DataFrame:
    """One row of counts, zero if the joins are one to one: references without a frame or video, repeated keys, other cameras, gaps in ids."""
    f = frame_records.groupBy("episode_id", "frame_index").agg(F.count("*").alias("n_f"), F.min("data_index").alias("data_index"))
    v = video_index.groupBy("data_index").agg(F.count("*").alias("n_v"))
    j = refs.join(f, ["episode_id", "frame_index"], "left").join(v, "data_index", "left")
    ids = F.max("ref_id") - F.min("ref_id") + 1
    return j.agg(
        F.count_if(F.col("n_f").isNull()).alias("without_frame"), F.count_if(F.col("n_f").isNotNull() & F.col("n_v").isNull()).alias("without_video"), F.count_if(F.col("n_f") > 1).alias("repeated_frames"),
        F.count_if(F.col("n_v") > 1).alias("repeated_videos"), F.count_if(F.col("camera_name") != "front").alias("other_cameras"), F.coalesce(ids - F.count_distinct("ref_id"), F.lit(0)).alias("id_gaps"),
    )


def checked(refs: DataFrame, frame_records: DataFrame, video_index: DataFrame) -> DataFrame:
    """``assemble`` after an audit that raises ValueError at the first violation."""
    found = audit(refs, frame_records, video_index).first().asDict()
    if bad := {k: n for k, n in found.items() if n}:
        raise ValueError(f"references do not join one to one: {bad}")
    return assemble(refs, frame_records, video_index)


def looked_up(df: DataFrame, table: DataFrame, keys: list[str], value: str, out: str | None = None) -> DataFrame:
    """``df`` with the ``value`` that ``table`` has for its keys, named ``out``. A key that is not there is an error when rows are read."""
    name = out or value
    side = table.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col(value).alias("__value"), F.lit(True).alias("__there"))
    joined = df.join(side, [F.col(k) == F.col(f"__{k}") for k in keys], "left")
    missing = F.raise_error(F.concat_ws(" ", F.lit(f"no {value} for"), *(F.col(k).cast("string") for k in keys))).cast(dict(table.dtypes)[value])
    return joined.select(*df.columns, F.when(F.col("__there"), F.col("__value")).otherwise(missing).alias(name))


def first_use_ids(refs: DataFrame, ref: str, order: list[str]) -> DataFrame:
    """(ref, ref_id): references numbered from 0 in the order of their first use; ``order`` tells uses apart."""
    first = refs.groupBy(ref).agg(F.min(F.struct(*order)).alias("first"))
    return running_before(first, ["first"], F.lit(1), "ref_id").select(ref, "ref_id")


def with_cameras(frames: DataFrame, cameras: list[str]) -> DataFrame:
    """Every frame with every camera, in the order given; a fixed array, so no join is needed."""
    return frames.select("*", F.posexplode(F.array(*map(F.lit, cameras))).alias("camera_index", "camera_name"))


def normalized_cameras(names: list[str], known: list[str]) -> list[str]:
    """Ordered without repeats; must be some and all known."""
    out = list(dict.fromkeys(names))
    if not out or set(out) - set(known):
        raise ValueError(f"cameras must be some of {known}: {names}")
    return out


def video_bounds(work: DataFrame) -> DataFrame:
    return work.groupBy("video_path").agg(F.min("video_frame_index").alias("first_frame"), F.max("video_frame_index").alias("last_frame"))


def pilot(work: DataFrame, k: int) -> DataFrame:
    """The first reference of each video, and of those ``k`` evenly spaced ones, places cut down to whole numbers."""
    first = running_before(work.groupBy("video_path").agg(F.min("ref_id").alias("ref_id")), ["ref_id"], F.lit(1), "place")
    placed = first.withColumn("n", F.lit(first.count()))
    step = lambda i: F.floor(i * (F.col("n") - 1).cast("double") / max(k - 1, 1) + 1e-9)
    wanted = F.exists(F.sequence(F.lit(0), F.least(F.lit(k), F.col("n")).cast("int") - 1), lambda i: step(i) == F.col("place"))
    return placed.where((F.col("n") <= k) | wanted).select("video_path", "ref_id")


def shard_map(work: DataFrame, shard_size: int = 8192, world: int = 8) -> DataFrame:
    shard = F.floor(F.col("ref_id") / shard_size)
    return work.select("ref_id", shard.alias("shard"), (F.col("ref_id") % shard_size).alias("row_index"), (shard % world).alias("owner"))


def chunk_files(episode_rank: Column, per_file: int = 20, per_chunk: int = 50) -> tuple[Column, Column]:
    """(chunk, file) of an episode by its place."""
    file = F.floor(episode_rank / per_file)
    return F.floor(file / per_chunk), file % per_chunk


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed run has still to do."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")
