"""Clearance of a robot to people: the proximity guard, visibility, and distances between agents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.functions import geo


@dataclass(frozen=True)
class GuardLimits:
    start_distance: float = 1.6
    stop_distance: float = 1.0
    approach_gain: float = 1.0
    closing_margin: float = 0.05
    prediction_horizon: float = 0.4
    emergency_distance: float = 0.85
    min_retreat_speed: float = 0.3
    max_tangent_speed: float = 0.2
    max_yaw_speed: float = 0.5
    max_human_speed: float = 2.5
    dt: float = 0.1


def guarded(df: DataFrame, limits: GuardLimits = GuardLimits()) -> DataFrame:
    """Safe world velocity for each row of robot (rx, rz), person (hx, hz) and its velocity (hvx, hvz), wished velocity (vx, vz) and turn (wz).

    Adds distance, predicted, emergency, active, safe_vx, safe_vz, safe_wz and correction. Row-wise, no state.
    """
    g = limits
    c = F.col
    stop, start = max(0.05, g.stop_distance), max(max(0.05, g.stop_distance) + 1e-3, g.start_distance)
    hv = [F.when(F.coalesce(~F.isnan(c("hvx")) & ~F.isnan(c("hvz")), F.lit(False)), c(n)).otherwise(0.0) for n in ("hvx", "hvz")]
    d = df.withColumns({"__hx": hv[0], "__hz": hv[1], "distance": F.hypot(c("hx") - c("rx"), c("hz") - c("rz"))})
    apart = c("distance") >= 1e-6
    hx, hz = geo.clip_speed(c("__hx"), c("__hz"), max(0.1, g.max_human_speed))
    d = d.withColumns({"__nx": F.when(apart, (c("hx") - c("rx")) / c("distance")).otherwise(0.0), "__nz": F.when(apart, (c("hz") - c("rz")) / c("distance")).otherwise(0.0), "__hx": hx, "__hz": hz})
    d = d.withColumn("radial", c("__hx") * c("__nx") + c("__hz") * c("__nz"))
    d = d.withColumn("predicted", F.greatest(F.lit(0.0), c("distance") + c("radial") * max(0.0, g.prediction_horizon)))
    d = d.withColumn("active", (c("distance") < start) | (c("predicted") < start))
    edge = max(stop, g.emergency_distance)
    d = d.withColumn("emergency", c("active") & (~apart | (c("distance") < edge) | (c("predicted") < edge)))
    d = d.withColumn("__toward", c("vx") * c("__nx") + c("vz") * c("__nz"))
    cap = c("radial") + max(0.0, g.approach_gain) * F.greatest(c("distance") - stop, F.lit(0.0)) - max(0.0, g.closing_margin)
    retreat = F.least(F.lit(-max(0.0, g.min_retreat_speed)), -F.greatest(F.lit(0.0), (stop - c("predicted")) / max(g.dt, 1e-3)))
    d = d.withColumn("__cap", F.when(c("emergency"), F.least(cap, retreat)).otherwise(cap))
    tx, tz = c("vx") - c("__toward") * c("__nx"), c("vz") - c("__toward") * c("__nz")
    sx, sz = geo.clip_speed(tx, tz, max(0.0, g.max_tangent_speed))
    safe = F.least(c("__toward"), c("__cap"))
    pick = lambda n, slow, free: F.when(~c("active"), c(f"v{n}")).when(~apart, F.lit(0.0)).otherwise(safe * c(f"__n{n}") + F.when(c("emergency"), slow).otherwise(free))
    turn = F.when(c("emergency"), F.when(apart, F.least(F.greatest(c("wz"), F.lit(-g.max_yaw_speed)), F.lit(g.max_yaw_speed))).otherwise(0.0)).otherwise(c("wz"))
    d = d.withColumns({"safe_vx": pick("x", sx, tx), "safe_vz": pick("z", sz, tz), "safe_wz": turn})
    d = d.withColumn("correction", F.hypot(c("safe_vx") - c("vx"), c("safe_vz") - c("vz")))
    return d.drop("__hx", "__hz", "__nx", "__nz", "__toward", "__cap")


def visible(rx: Column, rz: Column, yaw: Column, hx: Column, hz: Column, most: float = 10.0, half_angle: float = 1.15) -> Column:
    """In reach and within the field of view of a robot that looks along ``yaw``."""
    d = F.hypot(hx - rx, hz - rz)
    return d.between(1e-4, most) & (F.abs(geo.wrap_angle(F.atan2(hz - rz, hx - rx) - yaw)) <= half_angle)


def near_agents(agents: DataFrame, keys: list[str], radius: float) -> DataFrame:
    """Robot (agent 0) against every other agent of the same step within ``radius``; joined on the step, so a handful each."""
    robot = agents.where("agent = 0").select(*keys, F.col("x").alias("rx"), F.col("z").alias("rz"))
    d = F.hypot(F.col("x") - F.col("rx"), F.col("z") - F.col("rz"))
    return agents.where("agent <> 0").join(robot, keys).select(*keys, "agent", d.alias("distance")).where(F.col("distance") <= radius)
