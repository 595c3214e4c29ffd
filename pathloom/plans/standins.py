"""Rollout tables read out of the driver's event table, for queries and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.operators.prefix import running_before


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str, with_index: bool = False) -> DataFrame:
    """One row per step of a rollout: a user is an episode, its events in time order are the frames."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    e = e.withColumn("frame_index", (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long"))
    if with_index:
        sizes = e.groupBy("user_id").agg(F.count("*").alias("n"))
        e = e.join(running_before(sizes, ["user_id"], F.col("n"), "offset").select("user_id", "offset"), "user_id")
    scene = F.concat(F.lit("scene"), (F.col("user_id") % 7).cast("string"))
    k, value, index = F.col("k").cast("double"), F.col("value"), F.col("frame_index").cast("double")
    return e.select(
        F.concat(scene, F.lit("_"), F.col("user_id").cast("string")).alias("episode_id"), scene.alias("scene_id"), F.col("user_id").alias("source_episode_id"), "frame_index",
        *([(F.col("offset") + F.col("frame_index")).alias("idx")] if with_index else []),
        (index / 10.0).alias("timestamp_s"), F.least(value / 100.0, F.lit(1.0)).alias("vx"), ((k - 50) / 50.0).alias("vy"),
        (((F.col("event_id") * 37) % 201 - 100).cast("double") / 100.0).alias("wz"), (index / 10.0 + k / 100.0).alias("robot_x"), F.lit(0.1).alias("robot_y"),
        (value / 50.0).alias("robot_z"), ((F.col("k") % 63 - 31).cast("double") / 10.0).alias("robot_yaw"), (1 + F.col("k") % 5).cast("double").alias("dis_to_human"),
        F.col("event_type").isin("click", "view", "signup").alias("human_following"), ((F.col("event_type") == "error") & (F.col("k") < 5)).alias("human_collision"),
        F.substring(F.md5((F.col("k") % 8).cast("string").cast("binary")), 1, 16).alias("front_dhash"),
    )


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    collided = F.max(F.col("human_collision").cast("int"))
    following = F.sum(F.col("human_following").cast("long"))
    status = F.when(collided == 1, "Collision").when(following * 2 < F.count("*"), "Lost").otherwise("Normal")
    return frames(spark, sf_dir).groupBy("episode_id").agg(F.min("scene_id").alias("scene_id"), F.count("*").alias("total_step"), following.alias("following_step"), collided.alias("collision"), status.alias("status"))


FRAMES_SQL = """
WITH RECURSIVE ev AS (
  SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_index FROM events),
frames AS MATERIALIZED (
  SELECT concat('scene', user_id % 7, '_', user_id) AS episode_id, concat('scene', user_id % 7) AS scene_id, user_id AS source_episode_id, frame_index,
    CAST(row_number() OVER (ORDER BY user_id, frame_index) - 1 AS BIGINT) AS idx, frame_index::DOUBLE / 10::DOUBLE AS timestamp_s,
    least(value / 100::DOUBLE, 1::DOUBLE) AS vx, (k::DOUBLE - 50) / 50::DOUBLE AS vy, ((event_id * 37) % 201 - 100)::DOUBLE / 100::DOUBLE AS wz,
    frame_index::DOUBLE / 10::DOUBLE + k::DOUBLE / 100::DOUBLE AS robot_x, 0.1::DOUBLE AS robot_y, value / 50::DOUBLE AS robot_z,
    ((k % 63) - 31)::DOUBLE / 10::DOUBLE AS robot_yaw, (1 + k % 5)::DOUBLE AS dis_to_human, event_type IN ('click', 'view', 'signup') AS human_following,
    (event_type = 'error' AND k < 5) AS human_collision, substr(md5((k % 8)::VARCHAR), 1, 16) AS front_dhash FROM ev),
episodes AS MATERIALIZED (
  SELECT episode_id, min(scene_id) AS scene_id, count(*) AS total_step, sum(human_following::INT)::BIGINT AS following_step, max(human_collision::INT) AS collision,
    CASE WHEN max(human_collision::INT) = 1 THEN 'Collision' WHEN sum(human_following::INT) * 2 < count(*) THEN 'Lost' ELSE 'Normal' END AS status
  FROM frames GROUP BY episode_id)
"""
