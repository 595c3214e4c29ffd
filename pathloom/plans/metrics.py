"""Queries over per-step metrics, geometry and arrays."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.functions import actions, encode, geo, pixels
from pathloom.operators import guard, measures, sequence, stats
from pathloom.plans.registry import query
from pathloom.plans.standins import FRAMES_SQL, frames, table

R = 6
#: Added before rounding where exact halves are common, which engines round by their own last bit.
TIE = 1e-9


def _rounded(df, keys, names):
    return df.select(*keys, *(F.round(n, R).alias(n) for n in names))


KEYS = ["episode_id", "frame_index"]


@query(FRAMES_SQL + """, walk AS (SELECT episode_id, frame_index, robot_x AS px, robot_z AS pz, NULL::DOUBLE AS vx, NULL::DOUBLE AS vz FROM frames WHERE frame_index = 0
  UNION ALL SELECT f.episode_id, f.frame_index, f.robot_x, f.robot_z,
    CASE WHEN w.vx IS NULL THEN (f.robot_x - px) / 0.1::DOUBLE ELSE 0.65::DOUBLE * w.vx + 0.35::DOUBLE * ((f.robot_x - px) / 0.1::DOUBLE) END,
    CASE WHEN w.vz IS NULL THEN (f.robot_z - pz) / 0.1::DOUBLE ELSE 0.65::DOUBLE * w.vz + 0.35::DOUBLE * ((f.robot_z - pz) / 0.1::DOUBLE) END
  FROM walk w JOIN frames f ON f.episode_id = w.episode_id AND f.frame_index = w.frame_index + 1)
SELECT episode_id, frame_index, round(coalesce(vx, 0) + 1e-9, 6) AS vx, round(coalesce(vz, 0) + 1e-9, 6) AS vz FROM walk""")
def ema_velocity(spark, sf_dir):
    v = sequence.ema_velocity(frames(spark, sf_dir), "robot_x", "robot_z")
    return v.select(*KEYS, *(F.round(F.col(c) + TIE, R).alias(c) for c in ("vx", "vz")))


@query(FRAMES_SQL + """, walk AS (SELECT episode_id, frame_index, robot_z AS base, 0::DOUBLE AS accum, robot_z AS instant FROM frames WHERE frame_index = 0
  UNION ALL SELECT f.episode_id, f.frame_index, CASE WHEN f.robot_z - base > 0.5::DOUBLE OR f.robot_z < base THEN f.robot_z ELSE base END, accum + CASE WHEN f.robot_z - base > 0.5::DOUBLE THEN f.robot_z - base ELSE 0 END, f.robot_z
  FROM walk w JOIN frames f ON f.episode_id = w.episode_id AND f.frame_index = w.frame_index + 1)
SELECT episode_id, frame_index, round(accum, 6) AS accum, round(instant, 6) AS instant FROM walk""")
def force_accum(spark, sf_dir):
    return _rounded(sequence.accumulated_force(frames(spark, sf_dir), "robot_z", 0.5), KEYS, ["accum", "instant"])


@query(FRAMES_SQL + """, walk AS (SELECT episode_id, frame_index, greatest(least(greatest(least(vy, 1), -1), 0.25::DOUBLE), -0.25::DOUBLE) AS v FROM frames WHERE frame_index = 0
  UNION ALL SELECT f.episode_id, f.frame_index, v + greatest(least(greatest(least(f.vy, 1), -1) - v, 0.25::DOUBLE), -0.25::DOUBLE) FROM walk w JOIN frames f ON f.episode_id = w.episode_id AND f.frame_index = w.frame_index + 1)
SELECT episode_id, frame_index, round(v, 6) AS limited FROM walk""")
def slew_limit(spark, sf_dir):
    return _rounded(sequence.slew_limited(frames(spark, sf_dir), "vy", 2.5), KEYS, ["limited"])


@query(FRAMES_SQL + """, d AS (SELECT *, CASE WHEN sqrt(vx * vx + vy * vy) > 0.3 THEN vx / sqrt(vx * vx + vy * vy) END AS x FROM frames)
SELECT episode_id, frame_index, round(last_value(x IGNORE NULLS) OVER (PARTITION BY episode_id ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS direction_x FROM d""")
def motion_latch(spark, sf_dir):
    d = frames(spark, sf_dir).withColumn("d", sequence.latched_direction(F.col("vx"), F.col("vy"), 0.3))
    return d.select(*KEYS, F.round("d.x", R).alias("direction_x"))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, max((dis_to_human < 1.5 AND frame_index > 0)::INT) OVER (PARTITION BY episode_id ORDER BY frame_index) AS collided FROM frames")
def sticky_collision(spark, sf_dir):
    """A collision sticks; the first step resets without being judged."""
    return frames(spark, sf_dir).select(*KEYS, sequence.latch((F.col("dis_to_human") < 1.5) & (F.col("frame_index") > 0)).cast("int").alias("collided"))


@query(FRAMES_SQL + """, m AS (SELECT episode_id, frame_index, robot_z AS d, dis_to_human <= 3 AS ok, coalesce(sqrt(power(robot_x - lag(robot_x) OVER w, 2) + power(robot_z - lag(robot_z) OVER w, 2)), 0) AS moved FROM frames WINDOW w AS (PARTITION BY episode_id ORDER BY frame_index)),
e AS (SELECT episode_id, arg_min(d, frame_index) AS d0, arg_max(d, frame_index) AS d1, arg_max(ok, frame_index) AS ok, sum(moved) AS path FROM m GROUP BY episode_id)
SELECT episode_id, round(CASE WHEN d0 > 0 THEN ok::INT * d0 / greatest(d0, path) END, 6) AS spl, round(CASE WHEN d0 > 0 THEN greatest(0, 1 - d1 / d0) * (d0 / greatest(d0, path)) END, 6) AS soft_spl FROM e""")
def spl(spark, sf_dir):
    return _rounded(sequence.path_efficiency(frames(spark, sf_dir), "robot_x", "robot_z", "robot_z", F.col("dis_to_human") <= 3), ["episode_id"], ["spl", "soft_spl"])


@query(FRAMES_SQL + "SELECT episode_id, frame_index, round(coalesce(-(robot_z - lag(robot_z) OVER (PARTITION BY episode_id ORDER BY frame_index)), 0), 6) AS reward FROM frames")
def delta_reward(spark, sf_dir):
    return _rounded(frames(spark, sf_dir).withColumn("reward", sequence.delta("robot_z")), KEYS, ["reward"])


@query(FRAMES_SQL + """, r AS (SELECT episode_id, frame_index, max((dis_to_human = 1)::INT) OVER (PARTITION BY episode_id ORDER BY frame_index) AS reached FROM frames)
SELECT episode_id, frame_index, reached = 1 AS reached, (reached - coalesce(lag(reached) OVER (PARTITION BY episode_id ORDER BY frame_index), 0))::DOUBLE AS reward FROM r""")
def stage_latch(spark, sf_dir):
    near = F.col("dis_to_human") == 1
    return frames(spark, sf_dir).select(*KEYS, sequence.latch(near).alias("reached"), sequence.latch_reward(near).alias("reward"))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, (row_number() OVER (PARTITION BY episode_id, round_even(robot_x * 2, 0) / 2, round_even(robot_z * 2, 0) / 2 ORDER BY frame_index) = 1)::INT AS reward FROM frames")
def first_visit(spark, sf_dir):
    return sequence.first_visits(frames(spark, sf_dir), "robot_x", "robot_z").select(*KEYS, "reward")


@query(FRAMES_SQL + """, s AS (SELECT episode_id, frame_index, dis_to_human AS dis, vy AS vel, robot_z < 0.2 AS found, max((robot_z < 0.2)::INT) OVER (PARTITION BY episode_id ORDER BY frame_index) AS ever FROM frames)
SELECT episode_id, max(ever) = 1 AS has_found_human, round(avg(found::INT), 6) AS found_human_rate_over_epi, round(sum(found::INT) / greatest(sum(ever), 1), 6) AS found_human_rate_after_encounter_over_epi,
  round(avg(dis), 6) AS avg_robot_to_human_dis_over_epi, round(sum(dis * ever) / greatest(sum(ever), 1), 6) AS avg_robot_to_human_after_encounter_dis_over_epi, coalesce(min(frame_index + 1) FILTER (found), 1500) AS frist_ecnounter_steps,
  sum(found::INT)::BIGINT AS follow_human_steps_after_frist_encounter, round(avg((dis <= 1.5 AND vel < 0)::INT), 6) AS backup_ratio, round(avg((dis <= 1.5 AND vel >= 0 AND vel < 0.5)::INT), 6) AS yield_ratio FROM s GROUP BY episode_id""")
def social_stats(spark, sf_dir):
    f = frames(spark, sf_dir).select(*KEYS, F.col("dis_to_human").alias("dis"), F.col("vy").alias("vel"), (F.col("robot_z") < 0.2).alias("found"))
    s = sequence.social_stats(f)
    return s.select(*(F.round(c, R).alias(c) if t == "double" else F.col(c) for c, t in s.dtypes))


# ---- clearance


@query(FRAMES_SQL + """, g AS (SELECT episode_id, frame_index, vx, vy AS vz, wz, 0::DOUBLE AS rx, 0::DOUBLE AS rz, robot_z AS hx, dis_to_human / 4 AS hz, -vx AS hvx, vy / 2 AS hvz FROM frames),
a AS (SELECT *, sqrt(hx * hx + hz * hz) AS d, least(1, 2.5 / nullif(sqrt(hvx * hvx + hvz * hvz), 0)) AS s FROM g),
b AS (SELECT *, hx / d AS nx, hz / d AS nz, (hvx * hx + hvz * hz) / d * coalesce(s, 1) AS radial FROM a),
c AS (SELECT *, greatest(0, d + radial * 0.4) AS p, vx * nx + vz * nz AS toward FROM b),
e AS (SELECT *, d < 1.6 OR p < 1.6 AS active, (d < 1.6 OR p < 1.6) AND (d < 1 OR p < 1) AS emergency, vx - toward * nx AS tx, vz - toward * nz AS tz FROM c),
l AS (SELECT *, least(toward, CASE WHEN emergency THEN least(radial + greatest(d - 1, 0) - 0.05, -0.3, -greatest(0, (1 - p) / 0.1)) ELSE radial + greatest(d - 1, 0) - 0.05 END) AS safe,
  CASE WHEN emergency AND sqrt(tx * tx + tz * tz) > 0.2 THEN 0.2 / sqrt(tx * tx + tz * tz) ELSE 1 END AS k FROM e)
SELECT episode_id, frame_index, active, emergency, round(p, 6) AS predicted, round(CASE WHEN active THEN safe * nx + tx * k ELSE vx END, 6) AS safe_vx, round(CASE WHEN active THEN safe * nz + tz * k ELSE vz END, 6) AS safe_vz,
  round(CASE WHEN emergency THEN least(greatest(wz, -0.5), 0.5) ELSE wz END, 6) AS safe_wz FROM l""")
def proximity_guard(spark, sf_dir):
    f = frames(spark, sf_dir).select(*KEYS, "vx", F.col("vy").alias("vz"), "wz", F.lit(0.0).alias("rx"), F.lit(0.0).alias("rz"), F.col("robot_z").alias("hx"), (F.col("dis_to_human") / 4).alias("hz"), (-F.col("vx")).alias("hvx"), (F.col("vy") / 2).alias("hvz"))
    return guard.guarded(f).select(*KEYS, "active", "emergency", *(F.round(c, R).alias(c) for c in ("predicted", "safe_vx", "safe_vz", "safe_wz")))


@query(FRAMES_SQL + """, a AS (SELECT *, atan2(vy, vx) - robot_yaw + pi() AS t, sqrt(vx * vx + vy * vy) AS d FROM frames)
SELECT episode_id, frame_index, d BETWEEN 1e-4 AND 10 AND abs(t - 2 * pi() * floor(t / (2 * pi())) - pi()) <= 1.15 AS visible FROM a""")
def visibility(spark, sf_dir):
    zero = F.lit(0.0)
    return frames(spark, sf_dir).select(*KEYS, guard.visible(zero, zero, F.col("robot_yaw"), F.col("vx"), F.col("vy")).alias("visible"))


@query("""WITH a AS (SELECT l_orderkey, l_linenumber AS agent, min(l_quantity) AS x, min(l_tax) AS z FROM lineitem GROUP BY ALL)
SELECT o.l_orderkey, o.agent, round(sqrt(power(o.x - r.x, 2) + power(o.z - r.z, 2)), 6) AS distance FROM a r JOIN a o USING (l_orderkey) WHERE r.agent = 1 AND o.agent > 1 AND sqrt(power(o.x - r.x, 2) + power(o.z - r.z, 2)) <= 10""")
def agent_distances(spark, sf_dir):
    """Lines of an order as the agents of a step, the first as the robot."""
    a = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("x"), F.min("l_tax").alias("z"))
    return guard.near_agents(a.withColumn("agent", F.col("l_linenumber") - 1), ["l_orderkey"], 10.0).select("l_orderkey", (F.col("agent") + 1).alias("agent"), F.round("distance", R).alias("distance"))


# ---- geometry


@query(FRAMES_SQL + """, p AS (SELECT *, vx * cos(robot_yaw) + vy * sin(robot_yaw) AS x, vy * cos(robot_yaw) - vx * sin(robot_yaw) AS y FROM frames)
SELECT episode_id, frame_index, round(sqrt(x * x + y * y), 6) AS rho, round(CASE WHEN x = 0 AND y = 0 THEN 0 ELSE atan2(y, x) END, 5) AS phi FROM p""")
def polar_goal(spark, sf_dir):
    zero = F.lit(0.0)
    x, y = geo.to_frame(F.col("vx"), F.col("vy"), zero, zero, F.col("robot_yaw"))
    rho, phi = geo.polar(x, y)
    return frames(spark, sf_dir).select(*KEYS, F.round(rho, R).alias("rho"), F.round(phi, 5).alias("phi"))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, round(robot_x * cos(robot_yaw) + robot_z * sin(robot_yaw), 6) AS x, round(robot_y, 6) AS y, round(robot_z * cos(robot_yaw) - robot_x * sin(robot_yaw), 6) AS z, round(sin(robot_yaw / 2), 6) AS qy FROM frames")
def quaternion_rotation(spark, sf_dir):
    q = geo.from_yaw(F.col("robot_yaw"))
    x, y, z = geo.rotate(q, F.col("robot_x"), F.col("robot_y"), F.col("robot_z"))
    return frames(spark, sf_dir).select(*KEYS, F.round(x, R).alias("x"), F.round(y, R).alias("y"), F.round(z, R).alias("z"), F.round(q["y"], R).alias("qy"))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, trunc((vy + 1.1) / 0.25)::INT AS cell, round(trunc((vy + 1.1) / 0.25) * 0.25 - 1.1, 6) AS low FROM frames")
def grid_cells(spark, sf_dir):
    cell = geo.grid_cell(F.col("vy"), -1.1, 0.25)
    return frames(spark, sf_dir).select(*KEYS, cell.alias("cell"), F.round(geo.grid_point(cell, -1.1, 0.25), R).alias("low"))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, vx >= 0 AND vy >= 0 AND vx + vy <= 1 AS inside, round(abs(atan2(vy, vx)), 5) AS angle FROM frames WHERE vx > 0")
def planar_tests(spark, sf_dir):
    inside = geo.in_triangle(F.col("vx"), F.col("vy"), (0.0, 0.0), (1.0, 0.0), (0.0, 1.0))
    f = frames(spark, sf_dir).where("vx > 0")
    return f.select(*KEYS, inside.alias("inside"), F.round(geo.angle_between(F.col("vx"), F.col("vy"), F.lit(1.0), F.lit(0.0)), 5).alias("angle"))


@query(FRAMES_SQL + """, p AS (SELECT *, lead(robot_x) OVER w AS x1, lead(robot_z) OVER w AS z1 FROM frames WINDOW w AS (PARTITION BY episode_id ORDER BY frame_index)),
seg AS (SELECT episode_id, frame_index AS i, robot_x AS x0, robot_z AS z0, x1, z1, CASE WHEN power(x1 - robot_x, 2) + power(z1 - robot_z, 2) < 1e-12 THEN 0 ELSE greatest(0, least(1, ((3 - robot_x) * (x1 - robot_x) + (1 - robot_z) * (z1 - robot_z)) / (power(x1 - robot_x, 2) + power(z1 - robot_z, 2)))) END AS t FROM p WHERE x1 IS NOT NULL),
d AS (SELECT *, sqrt(power(3 - (x0 + t * (x1 - x0)), 2) + power(1 - (z0 + t * (z1 - z0)), 2)) AS distance, sqrt(power(x1 - x0, 2) + power(z1 - z0, 2)) AS len FROM seg),
best AS (SELECT episode_id, i, t, distance, len FROM d QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY distance, i) = 1)
SELECT b.episode_id, b.i::INT AS segment, round(b.distance, 6) AS distance, round((1 - b.t) * b.len + coalesce((SELECT sum(len) FROM d WHERE d.episode_id = b.episode_id AND d.i > b.i), 0), 5) AS remaining FROM best b""")
def path_lookahead(spark, sf_dir):
    points = frames(spark, sf_dir).groupBy("episode_id").agg(F.array_sort(F.collect_list(F.struct("frame_index", F.col("robot_x").alias("x"), F.col("robot_z").alias("z")))).alias("p"))
    near = points.select("episode_id", geo.nearest_on_path(F.transform("p", lambda q: F.struct(q["x"].alias("x"), q["z"].alias("z"))), F.lit(3.0), F.lit(1.0), F.lit(2.0)).alias("n"))
    return near.select("episode_id", "n.segment", F.round("n.distance", R).alias("distance"), F.round("n.remaining", 5).alias("remaining"))


@query(FRAMES_SQL + ", w AS (SELECT episode_id, frame_index, exp(-(dis_to_human * dis_to_human) / 3) AS a FROM frames) SELECT episode_id, frame_index, round(a / sum(a) OVER (PARTITION BY episode_id), 6) AS weight FROM w")
def potential_weights(spark, sf_dir):
    a = geo.attraction(F.col("dis_to_human"), 1.0)
    return frames(spark, sf_dir).select(*KEYS, F.round(a / F.sum(a).over(Window.partitionBy("episode_id")), R).alias("weight"))


# ---- arrays and maps


@query("""WITH c AS (SELECT vec_id, i, embedding[i + 1]::DOUBLE AS x FROM embeddings, (SELECT unnest(range(64)) AS i))
SELECT vec_id, (((i // 8) // 4) * 2 + (i % 8) // 4)::BIGINT AS bin, round(avg(x), 6) AS x FROM c GROUP BY ALL""")
def pool_grid(spark, sf_dir):
    cells = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("cell", "x")).withColumn("x", F.col("x").cast("double"))
    return stats.pooled(cells, ["vec_id"], 8, 2).select("vec_id", F.col("bin").cast("long").alias("bin"), F.round("x", R).alias("x"))


@query("""WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT vec_id, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, 0::DOUBLE AS max_abs_diff, true AS all_finite FROM x GROUP BY vec_id""")
def vector_stats(spark, sf_dir):
    s = table(spark, sf_dir, "embeddings").select("vec_id", *stats.vector_summary(F.col("embedding"), F.col("embedding")))
    return s.select("vec_id", F.round("mean", R).alias("mean"), F.round("std", R).alias("std"), "max_abs_diff", "all_finite")


@query("""WITH c AS (SELECT vec_id, i // 8 AS r, i % 8 AS c FROM embeddings, (SELECT unnest(range(64)) AS i) WHERE embedding[i + 1] > 0.2)
SELECT vec_id, min(c)::INT AS cmin, min(r)::INT AS rmin, max(c)::INT AS cmax, max(r)::INT AS rmax, count(*) AS n_cells, count(*) > 2 AND count(*) < 0.95 * 64 AS seen FROM c GROUP BY vec_id""")
def mask_box(spark, sf_dir):
    cells = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "x")).select("vec_id", F.floor(F.col("i") / 8).cast("int").alias("row"), (F.col("i") % 8).alias("col"), "x")
    return stats.bounding_box(cells, ["vec_id"], F.col("x") > 0.2).withColumn("seen", stats.band(F.col("n_cells"), 64, 2))


@query("SELECT event_type AS metric, round(sum(value) / (SELECT count(DISTINCT user_id) FROM events), 4) AS mean FROM events GROUP BY event_type")
def nested_metric_means(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("v"))
    maps = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("m"))
    return stats.nested_means(maps, "user_id", F.col("m")).withColumn("mean", F.round("mean", 4))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, round(avg(robot_z) OVER (PARTITION BY episode_id ORDER BY frame_index) + 1e-9, 6) AS mean FROM frames")
def rolling_mean(spark, sf_dir):
    return frames(spark, sf_dir).select(*KEYS, F.round(stats.rolling_mean("robot_z", ["episode_id"], ["frame_index"]) + TIE, R).alias("mean"))


# ---- commands, smoothing, limits and measures


@query(FRAMES_SQL + """, u AS (SELECT episode_id, frame_index, greatest(least(vx, 1), 0) * 2 AS forward, greatest(least(vy, 1), -1) * 0.5::DOUBLE AS side, greatest(least(wz * 2, 1), -1) * 3 AS turn FROM frames),
s AS (SELECT *, greatest(1, abs(forward * 2) / 2, abs(side * 3) / 0.5::DOUBLE) AS scale FROM u)
SELECT episode_id, frame_index, round(forward, 6) + 0.0 AS forward, round(side, 6) + 0.0 AS "lateral", round(turn, 6) + 0.0 AS turn,
  round(greatest(least(forward / 2, 1), 0), 6) + 0.0 AS n_forward, round(side / 0.5::DOUBLE, 6) + 0.0 AS n_lateral, round(turn / 3, 6) + 0.0 AS n_turn,
  round(forward * 2 / scale + 1e-9, 6) + 0.0 AS fit_forward, round(side * 3 / scale + 1e-9, 6) + 0.0 AS fit_lateral FROM s""")
def action_limits(spark, sf_dir):
    limits = actions.ActionLimits(2.0, 0.5, 3.0, allow_back=False)
    names = ("forward", "lateral", "turn")
    f = frames(spark, sf_dir).select(*KEYS, *(c.alias(n) for n, c in zip(names, actions.physical(F.col("vx"), F.col("vy"), F.col("wz") * 2, limits), strict=True)))
    back = actions.normalized(*map(F.col, names), limits)
    fit = actions.within_axes(F.col("forward") * 2, F.col("lateral") * 3, limits)
    f = f.select("*", *(c.alias(f"n_{n}") for n, c in zip(names, back, strict=True)), (fit[0] + TIE).alias("fit_forward"), (fit[1] + TIE).alias("fit_lateral"))
    return _rounded(f, KEYS, [c for c in f.columns if c not in KEYS])


@query("""WITH e AS (SELECT event_id, list_transform(range(72), lambda i: (event_id * (i + 3) * 7 + i * i) % 256) AS px FROM events),
b AS (SELECT event_id, k, px[k // 8 * 9 + k % 8 + 1] > px[k // 8 * 9 + k % 8 + 2] AS bit FROM e, (SELECT unnest(range(64)) AS k)),
h AS (SELECT event_id, k // 4 AS digit, sum(CASE WHEN bit THEN 8 >> (k % 4)::INT ELSE 0 END)::INT AS v FROM b GROUP BY ALL)
SELECT event_id, string_agg(substr('0123456789abcdef', v + 1, 1), '' ORDER BY digit) AS dhash FROM h GROUP BY event_id""")
def picture_hash(spark, sf_dir):
    grey = F.transform(F.sequence(F.lit(0), F.lit(71)), lambda i: (F.col("event_id") * (i + 3) * 7 + i * i) % 256)
    pictures = table(spark, sf_dir, "events").select("event_id", grey.alias("pixels"))
    return pictures.select("event_id", pixels.difference_hash(F.col("pixels")).alias("dhash"))


@query(FRAMES_SQL + """, walk AS (SELECT episode_id, frame_index, dis_to_human AS smoothed FROM frames WHERE frame_index = 0
  UNION ALL SELECT f.episode_id, f.frame_index, smoothed * 0.6::DOUBLE + f.dis_to_human * 0.4::DOUBLE FROM walk w JOIN frames f ON f.episode_id = w.episode_id AND f.frame_index = w.frame_index + 1)
SELECT episode_id, frame_index, round(smoothed + 1e-9, 6) AS smoothed FROM walk""")
def follow_target(spark, sf_dir):
    s = sequence.smoothed(frames(spark, sf_dir), "dis_to_human", 0.4)
    return s.select(*KEYS, F.round(F.col("smoothed") + TIE, R).alias("smoothed"))


@query(FRAMES_SQL + "SELECT episode_id, count(*) AS n_steps FROM frames WHERE frame_index < 40 AND timestamp_s < 3.05 GROUP BY episode_id")
def step_limits(spark, sf_dir):
    return sequence.within_limits(frames(spark, sf_dir), 40, 3.05).groupBy("episode_id").agg(F.count("*").alias("n_steps"))


@query(FRAMES_SQL + """SELECT episode_id, frame_index, round(cos(robot_yaw) * (3 - robot_x) - sin(robot_yaw) * (1 - robot_z) + 1e-9, 6) AS x, round(0.4::DOUBLE, 6) AS y,
  round(sin(robot_yaw) * (3 - robot_x) + cos(robot_yaw) * (1 - robot_z) + 1e-9, 6) AS z, round(sin((0.5::DOUBLE - robot_yaw) / 2) + 1e-9, 6) AS turn FROM frames""")
def relative_pose(spark, sf_dir):
    here = (F.col(c) for c in ("robot_x", "robot_y", "robot_z"))
    turn, (x, y, z) = geo.relative_pose(geo.from_yaw(F.col("robot_yaw")), *here, geo.from_yaw(F.lit(0.5)), F.lit(3.0), F.lit(0.5), F.lit(1.0))
    return frames(spark, sf_dir).select(*KEYS, F.round(x + TIE, R).alias("x"), F.round(y, R).alias("y"), F.round(z + TIE, R).alias("z"), F.round(turn["y"] + TIE, R).alias("turn"))


@query(FRAMES_SQL + """, m AS (SELECT episode_id, frame_index, (dis_to_human <= 3 AND human_following) AS facing, sum((dis_to_human <= 3 AND human_following)::INT) OVER w AS so_far, frame_index + 1 AS n FROM frames WINDOW w AS (PARTITION BY episode_id ORDER BY frame_index))
SELECT episode_id, frame_index, facing, so_far::BIGINT AS following_step, round(so_far / n, 6) AS following_rate FROM m""")
def measure_chain(spark, sf_dir):
    chain = measures.Measures()
    chain.add("facing", lambda: (F.col("dis_to_human") <= 3) & F.col("human_following"))
    chain.add("following_step", lambda: F.sum(F.col("facing").cast("long")).over(sequence.so_far()), ("facing",))
    chain.add("following_rate", lambda: F.round(F.col("following_step") / (F.col("frame_index") + 1), R), ("following_step",))
    return chain.apply(frames(spark, sf_dir).select(*KEYS, "dis_to_human", "human_following")).drop("dis_to_human", "human_following")


@query(FRAMES_SQL + """, s AS (SELECT episode_id, frame_index, dis_to_human AS d, abs(robot_yaw) AS a, dis_to_human < 3 AS inside, lag(dis_to_human) OVER w AS d0,
  last_value(CASE WHEN dis_to_human < 3 THEN abs(robot_yaw) END IGNORE NULLS) OVER (PARTITION BY episode_id ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a0 FROM frames WINDOW w AS (PARTITION BY episode_id ORDER BY frame_index))
SELECT episode_id, frame_index, round(coalesce(d0 - d, 0) + CASE WHEN inside THEN 0.5 * coalesce(a0 - a, 0) ELSE 0 END, 6) + 0.0 AS reward FROM s""")
def approach_reward(spark, sf_dir):
    f = frames(spark, sf_dir).withColumn("angle", F.abs("robot_yaw"))
    return _rounded(f.withColumn("reward", sequence.approach_reward("dis_to_human", "angle", 3.0, per_radian=0.5)), KEYS, ["reward"])


@query(FRAMES_SQL + """, v AS (SELECT episode_id, frame_index, vx, vy + 0.003 AS vy, sqrt(vx * vx + (vy + 0.003) * (vy + 0.003)) AS n FROM frames WHERE vx <> 0)
SELECT episode_id, frame_index, round(-vy / n / sqrt((1 + vx / n) * 2), 5) AS qy, round(sqrt((1 + vx / n) / 2), 5) AS qw FROM v WHERE vx > 0""")
def heading_quaternion(spark, sf_dir):
    """The turn from the axis x to the direction of travel in the plane of x and z."""
    zero = F.lit(0.0)
    q = geo.between_vectors((F.lit(1.0), zero, zero), (F.col("vx"), zero, F.col("vy") + 0.003))
    return frames(spark, sf_dir).where("vx > 0").select(*KEYS, F.round(q["y"], 5).alias("qy"), F.round(q["w"], 5).alias("qw"))


_PLACES_SQL = ", ".join(f"floor({a})::INT AS {n}0, ceil({a})::INT AS {n}1, {a} - floor({a}) AS {n}t" for n, a in ((n, f"least(greatest(((vec_id * {m}) % 100)::DOUBLE / 20 - 1, 0), 3) / 3 * 3") for n, m in (("x", 7), ("y", 11), ("z", 13))))


@query(f"WITH p AS (SELECT vec_id, embedding::DOUBLE[] AS g, {_PLACES_SQL} FROM embeddings) SELECT vec_id, round(" + " + ".join(
    "*".join(f"{n}t" if up >> i & 1 else f"(1 - {n}t)" for i, n in enumerate("xyz")) + " * g[1 + " + " + ".join(f"{n}{up >> i & 1} * {w}" for i, (n, w) in enumerate((("x", 16), ("y", 4), ("z", 1)))) + "]" for up in range(8)
) + ", 6) + 0.0 AS value FROM p")
def grid_interpolation(spark, sf_dir):
    """Values between the points of a grid of four by four by four, at places that also lie outside it."""
    places = [geo.bin_place((F.col("vec_id") * m % 100).cast("double") / 20 - 1, 0.0, 3.0, 4) for m in (7, 11, 13)]
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(geo.trilinear(F.col("embedding").cast("array<double>"), (4, 4, 4), places), R).alias("value"))


# halving [0.5, 1, 1, 2.5, 4]: the middle item is met first, and nothing lies beyond the last place
LADDER_SQL = "CASE WHEN {0} = 1 THEN 2 WHEN {0} > 2.5 THEN 4 WHEN {0} > 1 THEN 3 WHEN {0} > 0.5 THEN 1 ELSE 0 END"


@query(FRAMES_SQL + f"SELECT episode_id, frame_index, {LADDER_SQL.format('dis_to_human')}::INT AS place, {LADDER_SQL.format('(dis_to_human / 4)')}::INT AS near_place FROM frames")
def sorted_search(spark, sf_dir):
    ladder = F.array(*map(F.lit, [0.5, 1.0, 1.0, 2.5, 4.0]))
    return frames(spark, sf_dir).select(*KEYS, geo.search_place(ladder, F.col("dis_to_human")).alias("place"), geo.search_place(ladder, F.col("dis_to_human") / 4).alias("near_place"))


def _quarters():
    """A stand-in encoder: the mean and the largest value of each quarter of a picture."""
    import numpy as np

    def encode(pictures):
        parts = np.array(pictures, np.float64).reshape(len(pictures), 4, 16)
        return np.stack([parts.mean(axis=2), parts.max(axis=2)], axis=2)

    return encode


@query("""WITH v AS (SELECT vec_id, t::INT AS token, embedding[t * 16 + 1:t * 16 + 16]::DOUBLE[] AS x FROM embeddings, (SELECT unnest(range(4)) AS t))
SELECT vec_id, token, round(list_avg(x), 4) + 0.0 AS mean, round(list_max(x), 4) + 0.0 AS largest FROM v""")
def encoded_pictures(spark, sf_dir):
    """Tokens of a stand-in encoder for every vector as a picture."""
    tokens = encode.encoded(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _quarters, 4, 2)
    return tokens.select("vec_id", "token", F.round(F.col("vector")[0].cast("double"), 4).alias("mean"), F.round(F.col("vector")[1].cast("double"), 4).alias("largest"))
