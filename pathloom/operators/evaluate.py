"""Episode results: normalisation, summary rates, acceptance, and why an episode failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What a final status is called among the reasons.
STATUS_REASONS = {"Lost": "lost_main_human", "HumanStuck": "main_human_stuck", "Collision": "human_collision"}


def following_rate(following_step: Column, total_step: Column, stored: Column | None = None) -> Column:
    """Steps followed over steps, at least one; a stored rate where the steps followed are unknown."""
    rate = following_step.cast("double") / F.greatest(total_step.cast("double"), F.lit(1.0))
    return rate if stored is None else F.when(following_step.isNotNull(), rate).otherwise(F.coalesce(stored, F.lit(0.0)))


def summary(episodes: DataFrame) -> DataFrame:
    """SR and CR are over episodes, TR over steps. ``episodes(success, collision, rate, total_step)``; one row, zeros for no episodes."""
    steps = F.sum("total_step")
    rate = F.when(steps > 0, F.sum(F.col("rate") * F.col("total_step")) / steps).otherwise(0.0)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return episodes.agg(
        F.count("*").alias("n"), zero(F.avg(F.col("success").cast("double"))).alias("success_rate"), zero(F.avg(F.col("collision").cast("double"))).alias("collision_rate"),
        zero(rate).alias("tracking_rate"), zero(rate).alias("mean_following_rate"), zero(F.avg(F.col("total_step").cast("double"))).alias("mean_total_step"),
        F.coalesce(F.sum((F.col("collision") > 0).cast("long")), F.lit(0)).alias("collision_episodes"),
    )


def status_counts(episodes: DataFrame) -> DataFrame:
    return episodes.groupBy("status").agg(F.count("*").alias("n_episodes"))


def keep_successful(status: Column, finish: Column, success: Column) -> Column:
    """The predicate of the sample converter: finished, a positive success number, or a status that speaks of success."""
    return F.coalesce(finish, F.lit(False)) | F.coalesce(success.cast("double") > 0, F.lit(False)) | F.coalesce(F.contains(F.lower(status), F.lit("success")), F.lit(False))


def accepted(total_step: Column, success: Column, status: Column, rate: Column, longest_stuck: Column, min_rate: float = 0.5, stuck_limit: int = 60) -> Column:
    return (total_step > 0) & success & (status == "Normal") & (rate >= min_rate) & (longest_stuck < stuck_limit)


def failure_reasons(status: Column, total_step: Column, finish: Column, collision: Column, followed: Column, visible: Column, rate: Column, min_rate: float = 0.5) -> Column:
    """Ordered reason codes without repeats; an unknown rejection if none applies."""
    known = F.lit(None).cast("string")
    for name, reason in STATUS_REASONS.items():
        known = F.when(status == name, reason).otherwise(known)
    first = F.when(status.isin(*STATUS_REASONS), known).when(status != "Normal", F.concat(F.lit("status_"), F.lower(status)))
    off = lambda c: ~F.coalesce(c, F.lit(False))
    rest = [
        F.when(total_step == 0, "empty_trajectory"), F.when(off(finish), "episode_incomplete"), F.when(F.coalesce(collision.cast("double"), F.lit(0.0)) >= 1 - 1e-6, "human_collision"),
        F.when(off(followed), "following_not_achieved"), F.when(off(visible), "target_not_visible_at_end"), F.when(F.coalesce(rate, F.lit(0.0)) < min_rate, "low_following_rate"),
    ]
    found = F.array_distinct(F.filter(F.array(first, *rest), lambda x: x.isNotNull()))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("rollout_rejected_unknown")))


def early_end(steps: DataFrame, far: float = 4.0, lost_after: int = 20, stuck_after: int = 60, still: float = 1e-4) -> DataFrame:
    """First step at which each episode ends early, and why; nulls if it does not.

    ``steps(episode_id, frame_index, human_following, dis_to_human, human_x, human_z, human_collision)``.
    Lost counts steps that neither follow nor are near, from the last following step on; near
    steps neither count nor reset. At one step Lost comes before HumanStuck before Collision.
    The lost step itself is not logged, the others are: ``logged_steps`` tells how many rows stay.
    """
    order = Window.partitionBy("episode_id").orderBy("frame_index")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    s = steps.withColumn("island", F.sum(F.col("human_following").cast("int")).over(upto))
    s = s.withColumn("away", (~F.col("human_following") & (F.col("dis_to_human") > far)).cast("int"))
    island = Window.partitionBy("episode_id", "island").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("n_away", F.sum("away").over(island))
    s = longest_runs(s, still)
    cause = F.when((F.col("away") == 1) & (F.col("n_away") > lost_after), "Lost").when(F.col("run") >= stuck_after, "HumanStuck").when(F.col("human_collision"), "Collision")
    first = F.min(F.when(cause.isNotNull(), F.struct("frame_index", cause.alias("cause"))))
    out = s.groupBy("episode_id").agg(first.alias("end"), F.count("*").alias("n_steps"))
    logged = F.when(F.col("end").isNull(), F.col("n_steps")).when(F.col("end.cause") == "Lost", F.col("end.frame_index")).otherwise(F.col("end.frame_index") + 1)
    return out.select("episode_id", F.col("end.frame_index").alias("end_step"), F.col("end.cause").alias("cause"), logged.cast("long").alias("logged_steps"))


def longest_runs(steps: DataFrame, still: float = 1e-4) -> DataFrame:
    """Steps with ``run``: how many consecutive steps up to here the human has hardly moved (L1 in the plane)."""
    order = Window.partitionBy("episode_id").orderBy("frame_index")
    moved = F.abs(F.col("human_x") - F.lag("human_x").over(order)) + F.abs(F.col("human_z") - F.lag("human_z").over(order))
    s = steps.withColumn("stuck", F.coalesce(moved < still, F.lit(False)).cast("int"))
    s = s.withColumn("moves", F.sum(1 - F.col("stuck")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return s.withColumn("run", F.sum("stuck").over(Window.partitionBy("episode_id", "moves").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0))).drop("stuck", "moves")


def failure_distances(steps: DataFrame) -> DataFrame:
    """Smallest and last finite distance to the human, and the largest guard correction (0 without)."""
    fine = F.col("dis_to_human").isNotNull() & ~F.isnan("dis_to_human") & (F.abs("dis_to_human") < float("inf"))
    d = F.when(fine, F.col("dis_to_human"))
    return steps.groupBy("episode_id").agg(F.min(d).alias("min_distance"), F.max_by(d, F.when(fine, F.col("frame_index"))).alias("last_distance"), F.coalesce(F.max("correction"), F.lit(0.0)).alias("max_correction"))


def tail(steps: DataFrame, n: int, columns: list[str]) -> DataFrame:
    """The last ``n`` steps of each episode as an array; only those are gathered."""
    last = Window.partitionBy("episode_id").orderBy(F.desc("frame_index"))
    kept = steps.withColumn("__r", F.row_number().over(last)).where(F.col("__r") <= max(1, n))
    return kept.groupBy("episode_id").agg(F.array_sort(F.collect_list(F.struct("frame_index", *columns))).alias("recent_steps"))
