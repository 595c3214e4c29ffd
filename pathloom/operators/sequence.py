"""Window and fold operators over the steps of an episode (key ``episode_id``, order ``frame_index``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def steps() -> WindowSpec:
    """An episode's steps in order."""
    return Window.partitionBy("episode_id").orderBy("frame_index")


def so_far() -> WindowSpec:
    return steps().rowsBetween(Window.unboundedPreceding, 0)


def history(value: Column | str, n: int) -> Column:
    """Up to ``n`` values before the current step, oldest first."""
    return F.collect_list(value).over(steps().rowsBetween(-n, -1)) if n > 0 else F.array()


def following(value: Column | str, n: int) -> Column:
    """The current value and those after it, ``n`` in all at most; not padded."""
    return F.collect_list(value).over(steps().rowsBetween(0, n - 1))


def pad_to_length(items: Column, length: Column | int, empty: Column | None = None) -> Column:
    """Cut, or repeat the last item. Without any, ``empty`` is repeated (null unless given); for lists of lists that is the empty list."""
    length = F.lit(length) if isinstance(length, int) else length
    last = F.when(F.size(items) > 0, F.get(items, F.size(items) - 1)).otherwise(F.lit(None) if empty is None else empty)
    padded = F.concat(items, F.array_repeat(last, F.greatest(length - F.size(items), F.lit(0)).cast("int")))
    return F.slice(padded, F.lit(1), F.greatest(length, F.lit(0)))


def _advance(acc: Column, vx: Column, vy: Column, wz: Column, dt: float) -> tuple[Column, Column, Column]:
    """One Euler step; the heading before the step turns the velocity."""
    c, s = F.cos(acc["yaw"]), F.sin(acc["yaw"])
    return acc["x"] + (c * vx - s * vy) * dt, acc["y"] + (s * vx + c * vy) * dt, acc["yaw"] + wz * dt


def velocity(vx: str = "vx", vy: str = "vy", wz: str = "wz") -> Column:
    return F.struct(F.col(vx).alias("vx"), F.col(vy).alias("vy"), F.col(wz).alias("wz"))


#: Steps of an episode that are folded at a time.
RUN = 64
POSES = "array<struct<x:double,y:double,yaw:double>>"


def _start() -> Column:
    zero = F.lit(0.0)
    return F.struct(zero.alias("x"), zero.alias("y"), zero.alias("yaw"), F.lit(True).alias("ok"), F.array().cast(POSES).alias("poses"))


def _walk(velocities: Column, dt: float, flip: bool, stop_at_invalid: bool, finish: Callable[[Column], Column] = lambda poses: poses) -> Column:
    """Poses after each step of an array of velocities, and what ``finish`` makes of them.

    ``finish`` sees a bound variable, so the fold is not evaluated again for each use of its result.
    """
    sign = -1.0 if flip else 1.0

    def merge(acc: Column, v: Column) -> Column:
        fine = F.lit(True)
        if stop_at_invalid:
            for name in ("vx", "vy", "wz"):
                fine = fine & F.coalesce(~F.isnan(v[name]) & (F.abs(v[name]) < float("inf")), F.lit(False))
        ok = acc["ok"] & fine
        x, y, yaw = _advance(acc, v["vx"], v["vy"] * sign, v["wz"] * sign, dt)
        pose = F.struct(x.alias("x"), y.alias("y"), yaw.alias("yaw"))
        moved = F.struct(x.alias("x"), y.alias("y"), yaw.alias("yaw"), F.lit(True).alias("ok"), F.concat(acc["poses"], F.array(pose)).alias("poses"))
        held = F.struct(acc["x"].alias("x"), acc["y"].alias("y"), acc["yaw"].alias("yaw"), F.lit(False).alias("ok"), acc["poses"].alias("poses"))
        return F.when(ok, moved).otherwise(held)

    return F.aggregate(velocities, _start(), merge, lambda acc: finish(acc["poses"]))


def _zeros(n: Column | int) -> Column:
    zero = F.lit(0.0)
    return F.array_repeat(F.struct(zero.alias("x"), zero.alias("y"), zero.alias("yaw")), n)


def action_chunk(horizon: int = 8, dt: float = 0.1) -> Column:
    """Exactly ``horizon`` poses ahead, lateral and turning axes flipped; the last valid one repeats, zeros without any."""
    padded = lambda poses: F.when(F.size(poses) == 0, _zeros(horizon)).otherwise(pad_to_length(poses, horizon))
    return _walk(following(velocity(), horizon), dt, flip=True, stop_at_invalid=True, finish=padded)


def _ahead(df: DataFrame, n: int, dt: float, flip: bool) -> DataFrame:
    """``df(episode_id, frame_index, vx, vy, wz)`` → where each step starts (turn, px, py) and where it and the ``n - 1`` after it end.

    With Θ and P the headings and positions of the whole episode, the pose after step e as seen from step s is P after e
    less P before s, turned back by Θ before s. So all windows come from running sums over one sort, without folds. A
    velocity that is absent or not finite moves nothing and is counted in ``n_bad``, up to and with its step.
    """
    order = steps()
    before, now = (order.rowsBetween(Window.unboundedPreceding, x) for x in (-1, 0))
    fine = F.lit(True)
    for name in ("vx", "vy", "wz"):
        fine = fine & F.coalesce(~F.isnan(name) & (F.abs(name) < float("inf")), F.lit(False))
    sign = -1.0 if flip else 1.0
    d = df.select("episode_id", "frame_index", fine.alias("ok"), *(F.when(fine, F.col(n) * s).otherwise(0.0).alias(n) for n, s in (("vx", 1.0), ("vy", sign), ("wz", sign))))
    d = d.withColumns({"turn": F.coalesce(F.sum(F.col("wz") * dt).over(before), F.lit(0.0)), "n_bad": F.sum((~F.col("ok")).cast("int")).over(now)})
    d = d.withColumns({"dx": (F.cos("turn") * F.col("vx") - F.sin("turn") * F.col("vy")) * dt, "dy": (F.sin("turn") * F.col("vx") + F.cos("turn") * F.col("vy")) * dt})
    d = d.withColumns({p: F.coalesce(F.sum(m).over(before), F.lit(0.0)) for p, m in (("px", "dx"), ("py", "dy"))})
    end = F.struct((F.col("px") + F.col("dx")).alias("x"), (F.col("py") + F.col("dy")).alias("y"), (F.col("turn") + F.col("wz") * dt).alias("yaw"), "n_bad")
    return d.select("episode_id", "frame_index", "ok", "n_bad", "turn", "px", "py", F.collect_list(end).over(order.rowsBetween(0, n - 1)).alias("ends"))


def _pose_rows(d: DataFrame, last: Column, place: Column, none: Column) -> DataFrame:
    """Rows (episode_id, frame_index, step, x, y, yaw) for steps 0 to ``last``: the pose at ``place`` of ``ends``, or ``none`` without one."""
    d = d.withColumn("step", F.explode(F.sequence(F.lit(0), last))).withColumn("end", F.get("ends", place))
    mx, my = F.col("end.x") - F.col("px"), F.col("end.y") - F.col("py")
    poses = {"x": F.cos("turn") * mx + F.sin("turn") * my, "y": F.cos("turn") * my - F.sin("turn") * mx, "yaw": F.col("end.yaw") - F.col("turn")}
    return d.select("episode_id", "frame_index", "step", *(F.when(F.col("end").isNull(), none).otherwise(p).alias(n) for n, p in poses.items()))


def action_chunk_rows(df: DataFrame, horizon: int = 8, dt: float = 0.1) -> DataFrame:
    """``action_chunk`` as rows (episode_id, frame_index, step, x, y, yaw), equal up to rounding."""
    d = _ahead(df, horizon, dt, flip=True)
    valid = F.when(F.col("ok"), F.size(F.filter("ends", lambda e: e["n_bad"] == F.col("n_bad")))).otherwise(0)
    return _pose_rows(d.withColumn("valid", valid), F.lit(horizon - 1), F.least("step", F.col("valid") - 1), F.lit(0.0))


def future_trajectory_rows(df: DataFrame, horizon: int, dt: float = 1.0, beyond: bool = True) -> DataFrame:
    """``future_trajectory`` as rows, equal up to rounding; poses are null from a velocity on that is absent or not finite.

    Without ``beyond`` there are no rows past the episode's end, which is ``indicator_curve`` at one step less of horizon.
    """
    d = _ahead(df, max(horizon, 1), dt, flip=False)
    good = F.col("n_bad") - (~F.col("ok")).cast("int")
    last = F.least(F.size("ends"), F.lit(horizon)) if not beyond else F.lit(max(horizon, 0))
    rows = _pose_rows(d.withColumn("ends", F.transform("ends", lambda e: F.struct(*(F.when(e["n_bad"] == good, e[n]).alias(n) for n in ("x", "y", "yaw"))))), last, F.col("step") - 1, F.lit(0.0))
    return rows


def future_trajectory(horizon: int, dt: float = 1.0) -> Column:
    """The origin and ``horizon`` poses, no flip; steps beyond the end are the origin."""
    if horizon <= 0:
        return _zeros(1)
    padded = lambda poses: F.concat(_zeros(1), poses, _zeros(F.lit(horizon) - F.size(poses)))
    return _walk(following(velocity(), horizon), dt, flip=False, stop_at_invalid=False, finish=padded)


def indicator_curve(horizon: int, dt: float) -> Column:
    """The origin and the points of the steps from here to ``horizon`` further, both ends in; empty for no horizon."""
    if horizon <= 0:
        return F.array().cast(POSES)
    return _walk(following(velocity(), horizon + 1), dt, flip=False, stop_at_invalid=False, finish=lambda poses: F.concat(_zeros(1), poses))


def is_last() -> Column:
    return F.lead("frame_index").over(steps()).isNull()


def longest_run(df: DataFrame, flag: Column, name: str = "longest_run") -> DataFrame:
    """Longest run of consecutive steps for which ``flag`` holds, per episode."""
    f = df.select("episode_id", "frame_index", F.coalesce(flag, F.lit(False)).cast("int").alias("f"))
    f = f.withColumn("island", F.sum(1 - F.col("f")).over(so_far()))
    runs = f.groupBy("episode_id", "island").agg(F.sum("f").alias("n"))
    return runs.groupBy("episode_id").agg(F.max("n").alias(name))


def folded(df: DataFrame, items: Column, start: Column, step: Callable[[Column, Column], Column], out_type: str) -> DataFrame:
    """A recursion over an episode's steps in order: ``step(state, item)`` → state with the field ``out``.

    ``items`` must be a struct that starts with ``frame_index``. One row per step,
    columns episode_id, frame_index and those of ``out``. An episode is bounded by
    the step limit of a rollout, so its steps fit an array; they are folded in runs
    of RUN steps, whose results are only put side by side, so that a long one is
    not copied once a step.
    """
    kind = f"array<struct<frame_index:bigint,out:{out_type}>>"
    lists = df.groupBy("episode_id").agg(F.array_sort(F.collect_list(items)).alias("items"))
    starts = F.sequence(F.lit(1), F.size("items"), F.lit(RUN))

    def merge(acc: Column, x: Column) -> Column:
        state = step(acc["s"], x)
        return F.struct(state.alias("s"), F.concat(acc["outs"], F.array(F.struct(x["frame_index"].alias("frame_index"), state["out"].alias("out")))).alias("outs"))

    def run(acc: Column, at: Column) -> Column:
        one = F.aggregate(F.slice("items", at, RUN), F.struct(acc["s"].alias("s"), F.array().cast(kind).alias("outs")), merge)
        bound = F.transform(F.array(one), lambda r: F.struct(r["s"].alias("s"), F.concat(acc["runs"], F.array(r["outs"])).alias("runs")))
        return bound[0]

    begin = F.struct(start.alias("s"), F.array().cast(f"array<{kind}>").alias("runs"))
    rows = lists.select("episode_id", F.explode(F.aggregate(starts, begin, run, lambda acc: acc["runs"])).alias("r"))
    rows = rows.select("episode_id", F.explode("r").alias("r"))
    return rows.select("episode_id", "r.frame_index", "r.out.*")


def ema_velocity(df: DataFrame, x: str, z: str, dt: float = 0.1, alpha: float = 0.35) -> DataFrame:
    """Velocity in the plane: zero without a position before, raw at the first difference, then smoothed."""
    a = min(max(alpha, 0.0), 1.0)
    items = F.struct("frame_index", F.col(x).alias("x"), F.col(z).alias("z"))
    null = F.lit(None).cast("double")
    state = "struct<px:double,pz:double,vx:double,vz:double,out:struct<vx:double,vz:double>>"

    def step(s: Column, i: Column) -> Column:
        def one(p: str, v: str, q: str) -> Column:
            raw = (i[q] - s[p]) / max(dt, 1e-6)
            return F.when(s[p].isNull(), null).when(s[v].isNull(), raw).otherwise((1 - a) * s[v] + a * raw)

        vx, vz = one("px", "vx", "x"), one("pz", "vz", "z")
        out = F.struct(F.coalesce(vx, F.lit(0.0)).alias("vx"), F.coalesce(vz, F.lit(0.0)).alias("vz"))
        return F.struct(i["x"].alias("px"), i["z"].alias("pz"), vx.alias("vx"), vz.alias("vz"), out.alias("out")).cast(state)

    return folded(df, items, F.lit(None).cast(state), step, "struct<vx:double,vz:double>")


def accumulated_force(df: DataFrame, force: str, least: float = 1.0) -> DataFrame:
    """Force added up over rises of more than ``least``; the baseline follows those and any fall, not small rises."""
    state = "struct<base:double,accum:double,out:struct<accum:double,instant:double>>"

    def step(s: Column, i: Column) -> Column:
        rise = i["f"] - s["base"]
        accum = F.coalesce(s["accum"], F.lit(0.0)) + F.when(rise > least, rise).otherwise(0.0)
        base = F.when(s["base"].isNull() | (rise > least) | (rise < 0), i["f"]).otherwise(s["base"])
        return F.struct(base.alias("base"), accum.alias("accum"), F.struct(accum.alias("accum"), i["f"].alias("instant")).alias("out")).cast(state)

    return folded(df, F.struct("frame_index", F.col(force).alias("f")), F.lit(None).cast(state), step, "struct<accum:double,instant:double>")


def slew_limited(df: DataFrame, value: str, accel: float, dt: float = 0.1) -> DataFrame:
    """A value in [-1, 1] that moves by at most ``accel * dt`` a step, from zero."""
    state = "struct<v:double,out:struct<limited:double>>"

    def step(s: Column, i: Column) -> Column:
        before = F.coalesce(s["v"], F.lit(0.0))
        wanted = F.least(F.greatest(i["v"], F.lit(-1.0)), F.lit(1.0))
        v = before + F.least(F.greatest(wanted - before, F.lit(-accel * dt)), F.lit(accel * dt))
        return F.struct(v.alias("v"), F.struct(v.alias("limited")).alias("out")).cast(state)

    return folded(df, F.struct("frame_index", F.col(value).alias("v")), F.lit(None).cast(state), step, "struct<limited:double>")


def latched_direction(vx: Column, vz: Column, least: float = 0.08) -> Column:
    """The direction of the last step that moved faster than ``least``."""
    speed = F.sqrt(vx * vx + vz * vz)
    return F.last(F.when(speed > least, F.struct((vx / speed).alias("x"), (vz / speed).alias("z"))), ignorenulls=True).over(so_far())


def first_visits(df: DataFrame, x: str, z: str) -> DataFrame:
    """``df`` with ``reward``: 1 at the first step in each half-metre cell, half-even rounding."""
    cell = [F.bround(F.col(c) * 2) / 2 for c in (x, z)]
    return df.withColumn("reward", (F.row_number().over(Window.partitionBy("episode_id", *cell).orderBy("frame_index")) == 1).cast("int"))


def delta(value: str) -> Column:
    """Minus the change since the step before; zero at the first."""
    return F.coalesce(-(F.col(value) - F.lag(value).over(steps())), F.lit(0.0))


def approach_reward(distance: str, angle: str, radius: float, per_metre: float = 1.0, per_radian: float = 1.0) -> Column:
    """What was gained on the goal since the step before, and, inside ``radius``, on the wanted heading since the last step inside it.

    A value before that is absent or below zero, which marks a measure not taken, gains nothing.
    """
    before = Window.partitionBy("episode_id").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, -1)
    d, a, inside = F.col(distance), F.col(angle), F.coalesce(F.col(distance) < radius, F.lit(False))
    gain = lambda last, now: F.when(last >= 0, last - now).otherwise(0.0)
    turned = gain(F.last(F.when(inside, a), ignorenulls=True).over(before), a)
    return F.coalesce(gain(F.lag(d).over(steps()), d), F.lit(0.0)) * per_metre + F.when(inside, F.coalesce(turned, F.lit(0.0))).otherwise(0.0) * per_radian


def latch(flag: Column) -> Column:
    """True from the first step on at which ``flag`` held."""
    return F.coalesce(F.max(flag).over(so_far()), F.lit(False))


def latch_reward(flag: Column) -> Column:
    """One at the first step at which ``flag`` holds only."""
    return (flag & ~F.coalesce(F.max(flag).over(steps().rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))).cast("double")


def path_efficiency(df: DataFrame, x: str, z: str, goal: str, success: Column) -> DataFrame:
    """SPL and its soft form per episode; null where the episode starts at its goal."""
    dx, dz = (F.col(c) - F.lag(c).over(steps()) for c in (x, z))
    d = df.select("episode_id", "frame_index", F.col(goal).alias("d"), success.alias("ok"), F.coalesce(F.sqrt(dx * dx + dz * dz), F.lit(0.0)).alias("moved"))
    e = d.groupBy("episode_id").agg(F.min_by("d", "frame_index").alias("d0"), F.max_by("d", "frame_index").alias("d1"), F.max_by("ok", "frame_index").alias("ok"), F.sum("moved").alias("path"))
    share = F.when(F.col("d0") > 0, F.col("d0") / F.greatest("d0", "path"))
    soft = F.when(F.col("d0") > 0, F.greatest(F.lit(0.0), 1 - F.col("d1") / F.col("d0")))
    return e.select("episode_id", (F.col("ok").cast("double") * share).alias("spl"), (soft * share).alias("soft_spl"))


def social_stats(df: DataFrame, near: float = 1.5, slow: float = 0.5, default_step: int = 1500) -> DataFrame:
    """Per-episode ratios of ``df(episode_id, frame_index, dis, vel, found)``; output names as they are known, spelling included.

    ``step_after_found`` starts at one and grows after each step from the first finding on, so the last step divides by
    the steps from then on.
    """
    s = df.withColumn("ever", latch(F.col("found")))
    close = F.col("dis") <= near
    back = close & (F.col("vel") < 0)
    still = close & ~back & (F.abs("vel") < slow)
    count = lambda c: F.count_if(c).cast("double")
    steps, after = F.count("*").cast("double"), F.greatest(F.count_if(F.col("ever")), F.lit(1)).cast("double")
    first = F.coalesce(F.min(F.when(F.col("found"), F.col("frame_index") + 1)), F.lit(default_step))
    return s.groupBy("episode_id").agg(
        F.max("ever").alias("has_found_human"), (count(F.col("found")) / steps).alias("found_human_rate_over_epi"), (count(F.col("found")) / after).alias("found_human_rate_after_encounter_over_epi"),
        (F.sum("dis") / steps).alias("avg_robot_to_human_dis_over_epi"), (F.coalesce(F.sum(F.when(F.col("ever"), F.col("dis"))), F.lit(0.0)) / after).alias("avg_robot_to_human_after_encounter_dis_over_epi"),
        first.cast("long").alias("frist_ecnounter_steps"), F.count_if(F.col("found")).alias("follow_human_steps_after_frist_encounter"), (count(back) / steps).alias("backup_ratio"), (count(still) / steps).alias("yield_ratio"),
    )


def smoothed(df: DataFrame, value: str, alpha: float = 0.4) -> DataFrame:
    """Exponential average that starts at the first value: episode_id, frame_index, ``smoothed``."""
    items = F.struct("frame_index", F.col(value).cast("double").alias("x"))
    start = F.struct(F.lit(None).cast("double").alias("last"), F.struct(F.lit(None).cast("double").alias("smoothed")).alias("out"))

    def step(state: Column, item: Column) -> Column:
        now = F.coalesce(state["last"] * (1 - alpha) + item["x"] * alpha, item["x"], state["last"])
        return F.struct(now.alias("last"), F.struct(now.alias("smoothed")).alias("out"))

    return folded(df, items, start, step, "struct<smoothed:double>")


def within_limits(df: DataFrame, most_steps: int | None = None, most_seconds: float | None = None, time: str = "timestamp_s") -> DataFrame:
    """Steps before an episode's limit of steps or, from its first step on, of seconds; either may be absent."""
    if most_seconds is not None:
        first = F.min(time).over(Window.partitionBy("episode_id"))
        df = df.withColumn("__since", F.col(time) - first).where(F.col("__since") < most_seconds).drop("__since")
    return df if most_steps is None else df.where(F.col("frame_index") < most_steps)
