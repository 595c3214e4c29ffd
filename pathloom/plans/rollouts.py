"""Queries over rollouts: evaluation, failure analysis, history indexes, trajectories and worklists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.functions import geo, text
from pathloom.operators import context, evaluate, sequence, stats, worklist
from pathloom.operators.prefix import shared_folder
from pathloom.plans.registry import ORACLES, query
from pathloom.plans.standins import FRAMES_SQL, episodes, frames, table

HORIZON, BUDGET, CAMERAS = 8, 1024, ["front", "left", "right", "rear"]
R = 6  # digits of rounded results


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = episodes(spark, sf_dir)
    return e.select("*", (F.col("status") == "Normal").alias("success"), evaluate.following_rate(F.col("following_step"), F.col("total_step")).alias("rate"))


RESULTS_SQL = FRAMES_SQL + ", results AS (SELECT *, status = 'Normal' AS success, following_step::DOUBLE / greatest(total_step::DOUBLE, 1) AS rate FROM episodes)"


@query(RESULTS_SQL + f"""
SELECT count(*) AS n, round(avg(success::INT), {R}) AS success_rate, round(avg(collision), {R}) AS collision_rate,
  round(sum(rate * total_step) / sum(total_step), {R}) AS tracking_rate, round(sum(rate * total_step) / sum(total_step), {R}) AS mean_following_rate,
  round(avg(total_step), {R}) AS mean_total_step, sum((collision > 0)::INT)::BIGINT AS collision_episodes FROM results""")
def eval_summary(spark, sf_dir):
    s = evaluate.summary(_results(spark, sf_dir))
    return s.select("n", *(F.round(c, R).alias(c) for c in s.columns[1:-1]), "collision_episodes")


@query(FRAMES_SQL + "SELECT status, count(*) AS n_episodes FROM episodes GROUP BY status")
def eval_by_status(spark, sf_dir):
    return evaluate.status_counts(episodes(spark, sf_dir))


@query(RESULTS_SQL + "SELECT episode_id, round(rate, 6) AS rate, status LIKE '%ormal%' OR rate > 0.9 AS kept FROM results")
def success_filter(spark, sf_dir):
    r = _results(spark, sf_dir)
    return r.select("episode_id", F.round("rate", R).alias("rate"), evaluate.keep_successful(F.replace("status", F.lit("Normal"), F.lit("Success")), F.col("rate") > 0.9, F.lit(None)).alias("kept"))


STUCK_SQL = """, moved AS (SELECT *, (abs(robot_x - lag(robot_x) OVER w) + abs(robot_z - lag(robot_z) OVER w) < 1.0) AS stuck FROM frames WINDOW w AS (PARTITION BY episode_id ORDER BY frame_index)),
islands AS (SELECT *, sum(CASE WHEN coalesce(stuck, false) THEN 0 ELSE 1 END) OVER (PARTITION BY episode_id ORDER BY frame_index) AS island FROM moved),
runs AS (SELECT episode_id, frame_index, sum(coalesce(stuck, false)::INT) OVER (PARTITION BY episode_id, island ORDER BY frame_index) AS run FROM islands)"""


def _steps(spark, sf_dir):
    return frames(spark, sf_dir).withColumns({"human_x": F.col("robot_x"), "human_z": F.col("robot_z")})


@query(FRAMES_SQL + STUCK_SQL + "SELECT episode_id, max(run)::BIGINT AS longest_stuck FROM runs GROUP BY episode_id")
def longest_stuck_run(spark, sf_dir):
    return evaluate.longest_runs(_steps(spark, sf_dir), still=1.0).groupBy("episode_id").agg(F.max("run").alias("longest_stuck"))


@query(RESULTS_SQL + STUCK_SQL + """, longest AS (SELECT episode_id, max(run) AS n FROM runs GROUP BY episode_id)
SELECT episode_id, total_step > 0 AND success AND status = 'Normal' AND rate >= 0.5 AND n < 5 AS accepted FROM results JOIN longest USING (episode_id)""")
def acceptance(spark, sf_dir):
    stuck = evaluate.longest_runs(_steps(spark, sf_dir), still=1.0).groupBy("episode_id").agg(F.max("run").alias("n"))
    r = _results(spark, sf_dir).join(stuck, "episode_id")
    return r.select("episode_id", evaluate.accepted(F.col("total_step"), F.col("success"), F.col("status"), F.col("rate"), F.col("n"), stuck_limit=5).alias("accepted"))


REASONS_SQL = RESULTS_SQL + """, flags AS (SELECT *, total_step % 2 = 0 AS finish, total_step % 3 > 0 AS followed, following_step % 2 = 0 AS visible FROM results),
reasons AS (SELECT episode_id, list_filter([CASE status WHEN 'Lost' THEN 'lost_main_human' WHEN 'Collision' THEN 'human_collision' END, CASE WHEN NOT finish THEN 'episode_incomplete' END,
  CASE WHEN collision >= 1 - 1e-6 AND status <> 'Collision' THEN 'human_collision' END, CASE WHEN NOT followed THEN 'following_not_achieved' END, CASE WHEN NOT visible THEN 'target_not_visible_at_end' END,
  CASE WHEN rate < 0.5 THEN 'low_following_rate' END], lambda x: x IS NOT NULL) AS found FROM flags),
named AS (SELECT episode_id, CASE WHEN len(found) = 0 THEN ['rollout_rejected_unknown'] ELSE found END AS found FROM reasons)
"""


def _reasons(spark, sf_dir):
    r = _results(spark, sf_dir)
    found = evaluate.failure_reasons(F.col("status"), F.col("total_step"), F.col("total_step") % 2 == 0, F.col("collision"), F.col("total_step") % 3 > 0, F.col("following_step") % 2 == 0, F.col("rate"))
    return r.select("episode_id", found.alias("found"))


@query(REASONS_SQL + "SELECT episode_id, (i - 1)::INT AS place, found[i] AS reason FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM named)")
def failure_reasons(spark, sf_dir):
    return _reasons(spark, sf_dir).select("episode_id", F.posexplode("found").alias("place", "reason"))


@query(REASONS_SQL + "SELECT reason, count(*) AS n FROM (SELECT unnest(found) AS reason FROM named) GROUP BY reason")
def reason_counts(spark, sf_dir):
    return _reasons(spark, sf_dir).select(F.explode("found").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(FRAMES_SQL + """, k AS (SELECT *, CASE WHEN vx >= 0.02 THEN dis_to_human END AS d FROM frames)
SELECT episode_id, min(d) AS min_distance, arg_max(d, frame_index) FILTER (d IS NOT NULL) AS last_distance, round(max(vx), 6) AS max_correction FROM k GROUP BY episode_id""")
def failure_distances(spark, sf_dir):
    f = frames(spark, sf_dir).withColumn("dis_to_human", F.when(F.col("vx") >= 0.02, F.col("dis_to_human")).otherwise(float("nan"))).withColumn("correction", F.col("vx"))
    return evaluate.failure_distances(f).withColumn("max_correction", F.round("max_correction", R))


@query(FRAMES_SQL + """SELECT episode_id, frame_index, dis_to_human, human_following FROM frames
QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY frame_index DESC) <= 20""")
def failure_tail(spark, sf_dir):
    t = evaluate.tail(frames(spark, sf_dir), 20, ["dis_to_human", "human_following"])
    return t.select("episode_id", F.explode("recent_steps").alias("s")).select("episode_id", "s.*")


@query(FRAMES_SQL + STUCK_SQL + """, turns AS (SELECT *, sum(human_following::INT) OVER (PARTITION BY episode_id ORDER BY frame_index) AS turn, (NOT human_following AND dis_to_human > 2) AS away FROM frames),
lost AS (SELECT episode_id, frame_index, away, human_collision, sum(away::INT) OVER (PARTITION BY episode_id, turn ORDER BY frame_index) AS n FROM turns),
ends AS (SELECT l.*, CASE WHEN away AND n > 2 THEN 'Lost' WHEN run >= 4 THEN 'HumanStuck' WHEN human_collision THEN 'Collision' END AS cause FROM lost l JOIN runs USING (episode_id, frame_index)),
first AS (SELECT episode_id, min(frame_index) FILTER (cause IS NOT NULL) AS end_step, arg_min(cause, frame_index) FILTER (cause IS NOT NULL) AS cause, count(*) AS n FROM ends GROUP BY episode_id)
SELECT episode_id, end_step, cause, CASE WHEN cause IS NULL THEN n WHEN cause = 'Lost' THEN end_step ELSE end_step + 1 END AS logged_steps FROM first""")
def early_termination(spark, sf_dir):
    return evaluate.early_end(_steps(spark, sf_dir), far=2.0, lost_after=2, stuck_after=4, still=1.0)


EARLY_SQL = ORACLES["early_termination"].rsplit("SELECT episode_id, end_step", 1)[0]


@query(EARLY_SQL + "SELECT episode_id, end_step, cause FROM first WHERE cause IS NOT NULL")
def streamed_rules(spark, sf_dir):
    """The same rules over a stream of steps in three runs, each from the state of the last: the steps at which episodes end, and why."""
    from pathloom.streaming import episodes as streams

    steps = _steps(spark, sf_dir).select("episode_id", "frame_index", "human_following", "dis_to_human", "human_x", "human_z", "human_collision")
    slices = [steps.where(F.least(F.floor(F.col("frame_index") / 25), F.lit(2)) == i) for i in range(3)]
    out = streams.streamed_in_runs(spark, slices, lambda s: streams.follow_episodes(s, far=2.0, lost_after=2, stuck_after=4, still=1.0))
    return out.where("cause is not null").select("episode_id", F.col("frame_index").alias("end_step"), "cause")


@query(FRAMES_SQL + """SELECT episode_id, array_to_string(list_transform(CASE WHEN n >= 75 THEN k[1:75] ELSE k || list_transform(range(75 - n), lambda _: k[n]) END, lambda x: x::VARCHAR), ',') AS padded,
  array_to_string(list_transform(k[1:4], lambda x: x::VARCHAR), ',') AS cut, 3::INT AS n_empty FROM (SELECT episode_id, list(dis_to_human::BIGINT ORDER BY frame_index) AS k, count(*) AS n FROM frames GROUP BY episode_id)""")
def padded_lists(spark, sf_dir):
    """An episode's values made 75 long by repeating the last or by cutting, 4 long, and an empty list of lists made 3 long."""
    listed = frames(spark, sf_dir).groupBy("episode_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame_index", F.col("dis_to_human").cast("long").alias("k")))), lambda x: x["k"]).alias("k"))
    text_of = lambda c: F.array_join(c.cast("array<string>"), ",")
    none = F.array().cast("array<array<double>>")
    return listed.select("episode_id", text_of(sequence.pad_to_length(F.col("k"), 75)).alias("padded"), text_of(sequence.pad_to_length(F.col("k"), 4)).alias("cut"), F.size(sequence.pad_to_length(none, 3, F.array().cast("array<double>"))).alias("n_empty"))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, i::INT AS camera_index, name AS camera_name FROM frames, (VALUES (0, 'rear'), (1, 'front')) AS c(i, name)")
def chosen_cameras(spark, sf_dir):
    """Frames with the cameras of a list that names some twice, in its order; unknown ones and none are refused."""
    for bad in ([], ["front", "top"]):
        try:
            worklist.normalized_cameras(bad, CAMERAS)
        except ValueError:
            continue
        raise AssertionError(f"{bad} was taken")
    chosen = worklist.normalized_cameras(["rear", "front", "rear", "front"], CAMERAS)
    return worklist.with_cameras(frames(spark, sf_dir).select("episode_id", "frame_index"), chosen).select("episode_id", "frame_index", "camera_index", "camera_name")


@query("""WITH n AS (SELECT count(*) AS n FROM events), c AS (SELECT 'sound' AS "case", 'ok' AS verdict UNION ALL SELECT 'column', 'table lacks value' UNION ALL SELECT 'null', 'table holds nulls in event_id, value' UNION ALL SELECT 'unique', 'table repeats keys of user_id') SELECT * FROM c, n""")
def required_columns(spark, sf_dir):
    """What is said of a table that is sound, lacks a column, holds a null, or repeats a key."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    first = e.agg(F.min("event_id")).first()[0]
    need = ["event_id", "value"]
    cases = {
        "sound": lambda: worklist.require_columns(e, need, "table"), "column": lambda: worklist.require_columns(e.drop("value"), need, "table"),
        "null": lambda: worklist.require_columns(e.withColumn("value", F.when(F.col("event_id") != first, F.col("value"))), need, "table"), "unique": lambda: worklist.assert_unique(e, ["user_id"], "table"),
    }
    told = []
    for name, check in cases.items():
        try:
            check()
            told.append((name, "ok"))
        except ValueError as error:
            told.append((name, str(error)))
    return spark.createDataFrame(told, "case string, verdict string").crossJoin(F.broadcast(e.agg(F.count("*").alias("n"))))  # four rows and one


@query("""WITH a AS (SELECT count(*) AS n_events, count(DISTINCT user_id) AS n_users, max(event_id) AS last FROM events WHERE event_id % 10 > 0), b AS (SELECT count(*) AS n_events, count(DISTINCT user_id) AS n_users FROM events)
SELECT * FROM (SELECT 'n_events' AS key, a.n_events::VARCHAR AS saved, b.n_events::VARCHAR AS expected FROM a, b UNION ALL SELECT 'n_users', a.n_users::VARCHAR, b.n_users::VARCHAR FROM a, b UNION ALL SELECT 'camera', NULL, 'front') WHERE saved IS DISTINCT FROM expected""")
def resume_config(spark, sf_dir):
    """Settings of a build as they were saved, and those that a second run expects: what differs or was not saved."""
    import json

    from pathloom.sources import sinks

    e = table(spark, sf_dir, "events")
    of = lambda df: dict(zip(("n_events", "n_users"), df.agg(F.count("*"), F.count_distinct("user_id")).first(), strict=True))
    path = f"{shared_folder(spark)}/settings-{uuid.uuid4().hex}.json"
    sinks.write_json(spark, path, of(e.where("event_id % 10 > 0")) | {"fps": 10})
    try:
        differing = sinks.config_differences(json.loads(sinks.read_small(spark, path)), of(e) | {"fps": 10, "camera": "front"})
    finally:
        sinks.remove(spark, path)
    shown = [(k, *(None if x is None else str(x) for x in both)) for k, both in differing.items()]
    return spark.createDataFrame(shown, "key string, saved string, expected string")


@query(FRAMES_SQL + "SELECT episode_id, frame_index, round(vx, 6) AS motion__vx, round(vy, 6) AS motion__turn__vy, round(wz, 6) AS motion__turn__wz, round(dis_to_human, 6) AS dis FROM frames")
def flat_records(spark, sf_dir):
    """Records of nested structs, read from JSON text, as columns named by their paths."""
    whole = frames(spark, sf_dir).select("episode_id", "frame_index", F.struct("vx", F.struct("vy", "wz").alias("turn")).alias("motion"), F.col("dis_to_human").alias("dis"))
    written = whole.select(F.to_json(F.struct(*whole.columns)).alias("t"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.schema)
    read = written.select(F.from_json("t", kinds).alias("r")).select("r.*")
    flat = read.select(*text.flat_fields(read, "__"))
    return flat.select("episode_id", "frame_index", *(F.round(c, R).alias(c) for c in flat.columns[2:]))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), s AS (SELECT vec_id, v[1] AS a, v[2] AS b, CASE WHEN vec_id % 3 = 0 THEN 2 * v[1] WHEN vec_id % 7 = 1 THEN 0 ELSE v[3] END AS c, CASE WHEN vec_id % 3 = 0 THEN 2 * v[2] WHEN vec_id % 7 = 1 THEN 0 ELSE v[4] END AS d, v[5] AS e, v[6] AS f FROM e),
t AS (SELECT *, a * d - b * c AS det, a * a + b * b + c * c + d * d AS norm FROM s)
SELECT vec_id, round(CASE WHEN abs(det) > 1e-12 THEN (e * d - b * f) / det WHEN norm > 0 THEN (a * e + c * f) / norm ELSE 0 END, 4) + 0.0 AS x, round(CASE WHEN abs(det) > 1e-12 THEN (a * f - e * c) / det WHEN norm > 0 THEN (b * e + d * f) / norm ELSE 0 END, 4) + 0.0 AS y FROM t""")
def plane_solve(spark, sf_dir):
    """Two equations in two unknowns from each vector; every third system is singular and has its least-norm solution."""
    v = F.col("embedding").cast("array<double>")
    a, b, c, d, e, f = (v[i] for i in range(6))
    third, flat = F.col("vec_id") % 3 == 0, F.col("vec_id") % 7 == 1
    c, d = (F.when(third, 2 * x).when(flat, 0.0).otherwise(y) for x, y in ((a, c), (b, d)))
    x, y = geo.solve2(a, b, c, d, e, f)
    return table(spark, sf_dir, "embeddings").select("vec_id", (F.round(x, 4) + 0.0).alias("x"), (F.round(y, 4) + 0.0).alias("y"))


@query(FRAMES_SQL + "SELECT episode_id, sum((vy >= 0.9)::INT)::BIGINT AS n_following, round(avg((vy >= 0.9)::INT), 6) AS rate FROM frames GROUP BY episode_id")
def following_aggregate(spark, sf_dir):
    held = F.count_if(F.col("vy") >= 0.9)
    return frames(spark, sf_dir).groupBy("episode_id").agg(held.alias("n_following"), F.round(held / F.count("*"), R).alias("rate"))


# ---- history


@query(FRAMES_SQL + "SELECT episode_id, frame_index, least(frame_index, 240) AS n_blocks, 64 + 4 * least(frame_index, 240) AS total_tokens FROM frames")
def history_counts(spark, sf_dir):
    return context.counts(frames(spark, sf_dir), BUDGET).select("episode_id", "frame_index", "n_blocks", "total_tokens")


@query(FRAMES_SQL + """, cams AS (SELECT unnest(range(2)) AS i, unnest(['front', 'rear']) AS camera)
SELECT a.episode_id, a.frame_index, (b.frame_index - greatest(a.frame_index - 6, 0))::INT AS step, camera, printf('%s/%06d/%s', b.episode_id, b.frame_index, camera) AS ref,
  ((b.frame_index - greatest(a.frame_index - 6, 0)) * 2 + i + 1)::INT AS token_count_after
FROM frames a JOIN frames b ON a.episode_id = b.episode_id AND b.frame_index BETWEEN a.frame_index - 6 AND a.frame_index - 1, cams""")
def history_refs_long(spark, sf_dir):
    n = context.blocks_marked(190, 2)
    return context.references(frames(spark, sf_dir), n, ["front", "rear"]).select("episode_id", "frame_index", "step", "camera", "ref", "token_count_after")


def _index(spark, sf_dir):
    f = frames(spark, sf_dir).select("source_episode_id", "episode_id", "frame_index")
    return context.offsets(context.counts(f, BUDGET), ["source_episode_id"])


@query(FRAMES_SQL + """SELECT episode_id, frame_index, least(frame_index, 240) AS n_blocks,
  coalesce(sum(least(frame_index, 240)) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM frames""")
def context_offsets(spark, sf_dir):
    return _index(spark, sf_dir).select("episode_id", "frame_index", "n_blocks", "offset")


@query(FRAMES_SQL + """, good AS (SELECT source_episode_id AS k, episode_id, frame_index, least(frame_index, 240) AS n, coalesce(sum(least(frame_index, 240)) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM frames),
bad AS (SELECT episode_id, frame_index, CASE WHEN k % 9 = 0 AND frame_index = 11 THEN 999 ELSE n END AS n, pos + (k % 5 = 0 AND frame_index = 3)::INT AS pos, 64 + 4 * n + (frame_index % 7 = 5)::INT AS tokens FROM good),
ends AS (SELECT episode_id, min(pos) AS start, max(pos + n) AS stop FROM bad GROUP BY episode_id),
loose AS (SELECT start FROM ends WHERE start > 0 EXCEPT ALL SELECT stop FROM ends),
gaps AS (SELECT *, lag(pos + n) OVER (PARTITION BY episode_id ORDER BY frame_index) <> pos AS gap FROM bad)
SELECT coalesce(sum(gap::INT), 0)::BIGINT AS gaps, sum((n > 240)::INT)::BIGINT AS too_long, sum((tokens <> 64 + 4 * n)::INT)::BIGINT AS wrong_tokens, sum(n)::BIGINT AS total_blocks, (SELECT count(*) FROM loose) AS loose_episodes FROM gaps""")
def context_validate(spark, sf_dir):
    """Violations in an index with planted ones of each kind."""
    k, i = F.col("source_episode_id"), F.col("frame_index")
    bad = _index(spark, sf_dir).withColumns({
        "offset": F.col("offset") + ((k % 5 == 0) & (i == 3)).cast("int"), "total_tokens": F.col("total_tokens") + (i % 7 == 5).cast("int"), "n_blocks": F.when((k % 9 == 0) & (i == 11), 999).otherwise(F.col("n_blocks")),
    })
    return context.violations(bad, ["source_episode_id"], BUDGET)


@query(FRAMES_SQL + """SELECT (SELECT count(*) FROM episodes) AS n_episodes, count(*) AS n_frames, sum((frame_index > 0)::INT)::BIGINT AS n_refs,
  sum(least(frame_index, 240))::BIGINT AS n_blocks, (sum(least(frame_index, 240)) * 21)::BIGINT AS n_bytes FROM frames""")
def index_estimate(spark, sf_dir):
    return context.estimate(frames(spark, sf_dir), context.blocks_plain(BUDGET))


DEDUP_SQL = FRAMES_SQL + """, past AS (SELECT a.episode_id, a.frame_index, a.front_dhash, b.frame_index AS older, b.front_dhash AS h,
  row_number() OVER (PARTITION BY a.episode_id, a.frame_index ORDER BY b.frame_index DESC) AS r FROM frames a JOIN frames b ON a.episode_id = b.episode_id AND b.frame_index < a.frame_index),
bits AS (SELECT x.h AS a, y.h AS b, (bit_count(xor(('0x' || substr(x.h, 1, 8))::BIGINT, ('0x' || substr(y.h, 1, 8))::BIGINT)) + bit_count(xor(('0x' || substr(x.h, 9, 8))::BIGINT, ('0x' || substr(y.h, 9, 8))::BIGINT)))::INT AS d
  FROM (SELECT DISTINCT front_dhash AS h FROM frames) x, (SELECT DISTINCT front_dhash AS h FROM frames) y),
scan AS (SELECT episode_id, frame_index, r, older, h AS kept_hash, 1 AS n, true AS kept, 64 AS d FROM past WHERE r = 1
  UNION ALL SELECT p.episode_id, p.frame_index, p.r, p.older, CASE WHEN bits.d > 32 AND n < 4 THEN p.h ELSE kept_hash END, n + (bits.d > 32 AND n < 4)::INT, bits.d > 32 AND n < 4, bits.d
  FROM scan s JOIN past p ON p.episode_id = s.episode_id AND p.frame_index = s.frame_index AND p.r = s.r + 1 JOIN bits ON bits.a = p.h AND bits.b = s.kept_hash)
"""


@query(DEDUP_SQL + "SELECT episode_id, frame_index, older AS kept_frame, d AS distance FROM scan WHERE kept")
def dedup_history(spark, sf_dir):
    """Greedy selection through all history of each anchor."""
    return context.deduplicated_history(frames(spark, sf_dir), 4, threshold=32).select("episode_id", "frame_index", "kept_frame", "distance")


def _rates_sql(target: int) -> str:
    """Decay rates by anchor, for a budget that holds ``target`` frames, by halving."""
    return f""", span AS (SELECT a, least(a, {target})::DOUBLE AS target FROM (SELECT DISTINCT frame_index AS a FROM frames WHERE frame_index > 0)),
halve AS (SELECT a, target, 0 AS n, 1e-12::DOUBLE AS low, 1e5::DOUBLE AS high FROM span WHERE target < a AND target > a * 0.1::DOUBLE
  UNION ALL SELECT a, target, n + 1, CASE WHEN e > target THEN k ELSE low END, CASE WHEN e > target THEN high ELSE k END
  FROM (SELECT *, a * (0.9::DOUBLE * (1 - exp(-k)) / k + 0.1::DOUBLE) AS e FROM (SELECT *, (low + high) / 2 AS k FROM halve WHERE n < 90))),
rates AS (SELECT s.a, CASE WHEN target <= s.a * 0.1::DOUBLE THEN 1e6::DOUBLE ELSE coalesce(h.k, 0) END AS rate FROM span s LEFT JOIN (SELECT a, (low + high) / 2 AS k FROM halve WHERE n = 90) h USING (a))"""


@query(FRAMES_SQL + _rates_sql(25) + f"""
SELECT episode_id, frame_index, round(rate, {R}) AS rate, round(exp(-rate / a) * 0.9::DOUBLE + 0.1::DOUBLE, {R}) AS newest, round(exp(-rate) * 0.9::DOUBLE + 0.1::DOUBLE, {R}) AS oldest
FROM frames JOIN rates ON a = frame_index""")
def bats_scores(spark, sf_dir):
    """Keep probability of the newest and the oldest history frame of each anchor."""
    f = frames(spark, sf_dir).select("episode_id", "frame_index")
    longest = f.agg(F.max("frame_index")).first()[0] or 0
    rates = context.decay_rates(spark, longest, 190)  # one row per step of the longest rollout
    j = f.join(F.broadcast(rates), F.col("frame_index") == F.col("anchor")).where("frame_index > 0")
    p = lambda at: F.round(context.keep_probability(at, F.col("anchor"), F.col("rate")), R)
    return j.select("episode_id", "frame_index", F.round("rate", R).alias("rate"), p(F.col("anchor") - 1).alias("newest"), p(F.lit(0)).alias("oldest"))


def _scored_sql(target: int) -> str:
    return FRAMES_SQL + _rates_sql(target) + """, scored AS (SELECT f.episode_id, f.frame_index, b.frame_index AS ref_frame, exp(rate * (b.frame_index - f.frame_index) / greatest(1, f.frame_index)) * 0.9::DOUBLE + 0.1::DOUBLE AS score
  FROM frames f JOIN rates ON a = f.frame_index JOIN frames b ON b.episode_id = f.episode_id AND b.frame_index < f.frame_index),
ranked AS (SELECT *, row_number() OVER (PARTITION BY episode_id, frame_index ORDER BY round(score, 9) DESC, ref_frame DESC) AS r FROM scored)"""


@query(_scored_sql(25) + f""" SELECT episode_id, frame_index, ref_frame, (row_number() OVER (PARTITION BY episode_id, frame_index ORDER BY ref_frame) - 1)::INT AS step, round(score, {R}) AS score, CASE WHEN r = 1 THEN 64 ELSE 0 END AS distance
FROM ranked WHERE r <= 25""")
def bats_selection(spark, sf_dir):
    """The history frames with the highest keep probability, and their scores and distances."""
    chosen = context.bats_selection(frames(spark, sf_dir), 190)
    return chosen.select("episode_id", "frame_index", "ref_frame", "step", F.round("score", R).alias("score"), "distance")


@query(DEDUP_SQL.replace("WITH RECURSIVE", "WITH RECURSIVE", 1).rstrip() + _rates_sql(4) + f"""
SELECT episode_id, frame_index, older AS ref_frame, round(exp(rate * (older - frame_index) / greatest(1, frame_index)) * 0.9::DOUBLE + 0.1::DOUBLE, {R}) AS score, scan.d AS distance FROM scan JOIN rates ON rates.a = frame_index WHERE kept""")
def bats_selection_dedup(spark, sf_dir):
    """The same with frames skipped whose pictures are near the last kept one."""
    chosen = context.bats_selection(frames(spark, sf_dir), 85, dedup=True, threshold=32)
    return chosen.select("episode_id", "frame_index", "ref_frame", F.round("score", R).alias("score"), "distance")


@query(FRAMES_SQL + """, past AS (SELECT a.episode_id, a.frame_index, b.frame_index AS ref_frame, b.timestamp_s AS timestamp, row_number() OVER (PARTITION BY a.episode_id, a.frame_index ORDER BY b.frame_index) - 1 AS step
  FROM frames a JOIN frames b ON a.episode_id = b.episode_id AND b.frame_index BETWEEN a.frame_index - 5 AND a.frame_index - 1), cams AS (SELECT unnest(range(2)) AS i, unnest(['front', 'rear']) AS camera)
SELECT episode_id, frame_index, step::INT AS step, (step * 2 + i)::INT AS block, camera, printf('%s/%06d/%s', episode_id, ref_frame, camera) AS ref, round(timestamp, 6) AS timestamp, true AS mask, 1.0::DOUBLE AS score, CASE WHEN step = 0 THEN 64 ELSE 0 END AS distance FROM past, cams""")
def history_scores(spark, sf_dir):
    """Rows of a sliding history for two cameras, with times, masks, scores and distances."""
    rows = context.context_rows(context.history_scores(frames(spark, sf_dir), 5), ["front", "rear"])
    return rows.select("episode_id", "frame_index", "step", "block", "camera", "ref", F.round("timestamp", R).alias("timestamp"), "mask", "score", "distance")


@query(FRAMES_SQL + """, uses AS (SELECT a.idx, b.frame_index, printf('%s/%06d/front', b.episode_id, b.frame_index) AS ref FROM frames a JOIN frames b ON a.episode_id = b.episode_id AND b.frame_index BETWEEN a.frame_index - 3 AND a.frame_index - 1),
firsts AS (SELECT ref, row_number() OVER (ORDER BY min(struct_pack(i := idx, f := frame_index))) - 1 AS ref_id FROM uses GROUP BY ref) SELECT idx, uses.ref, ref_id FROM uses JOIN firsts USING (ref)""")
def ref_lookup(spark, sf_dir):
    """Ids of references by first use, looked up for every use."""
    f = frames(spark, sf_dir, with_index=True)
    uses = context.references(f, 3, ["front"]).join(f.select("episode_id", "frame_index", "idx"), ["episode_id", "frame_index"]).select("idx", "ref_frame", "ref")
    return worklist.looked_up(uses, worklist.first_use_ids(uses, "ref", ["idx", "ref_frame"]), ["ref"], "ref_id").select("idx", "ref", "ref_id")


@query(FRAMES_SQL + """SELECT episode_id, frame_index, (bit_count(xor(('0x' || substr(front_dhash, 1, 8))::BIGINT, ('0x' || substr(last, 1, 8))::BIGINT)) + bit_count(xor(('0x' || substr(front_dhash, 9, 8))::BIGINT, ('0x' || substr(last, 9, 8))::BIGINT)))::INT AS distance
FROM (SELECT *, lag(front_dhash) OVER (PARTITION BY episode_id ORDER BY frame_index) AS last FROM frames) WHERE last IS NOT NULL""")
def hash_lookup(spark, sf_dir):
    """Picture hashes of a frame and the one before it, looked up by episode, frame and camera."""
    f = frames(spark, sf_dir)
    table_ = f.select("episode_id", "frame_index", F.lit("front").alias("camera"), "front_dhash")
    asked = f.where("frame_index > 0").select("episode_id", "frame_index", F.lit("front").alias("camera"))
    now = worklist.looked_up(asked, table_, ["episode_id", "frame_index", "camera"], "front_dhash", "now")
    both = worklist.looked_up(now.withColumn("frame_index", F.col("frame_index") - 1), table_, ["episode_id", "frame_index", "camera"], "front_dhash", "last")
    return both.select("episode_id", (F.col("frame_index") + 1).alias("frame_index"), context.hamming(F.col("now"), F.col("last")).cast("int").alias("distance"))


# ---- trajectories


def _rounded_poses(rows):
    return rows.select("episode_id", "frame_index", "step", *(F.round(c, R).alias(c) for c in ("x", "y", "yaw")))


def _walk_sql(sign: str, dt: str, steps: int) -> str:
    return FRAMES_SQL + f""", walk AS (SELECT episode_id, frame_index AS s, 0 AS k, 0::DOUBLE AS x, 0::DOUBLE AS y, 0::DOUBLE AS yaw FROM frames
  UNION ALL SELECT w.episode_id, s, k + 1, x + (cos(yaw) * f.vx - sin(yaw) * ({sign}f.vy)) * {dt}, y + (sin(yaw) * f.vx + cos(yaw) * ({sign}f.vy)) * {dt}, yaw + ({sign}f.wz) * {dt}
  FROM walk w JOIN frames f ON f.episode_id = w.episode_id AND f.frame_index = w.s + w.k WHERE k < {steps})"""


def _r(c: str) -> str:
    """Rounded; a zero keeps no sign, as in Spark."""
    return f"round({c}, {R}) + 0.0 AS {c.split('.')[-1]}"


@query(_walk_sql("-", "0.1::DOUBLE", 8) + f""", n AS (SELECT episode_id, s, max(k) AS n FROM walk GROUP BY ALL)
SELECT w.episode_id, w.s AS frame_index, t.step::INT AS step, {_r('x')}, {_r('y')}, {_r('yaw')} FROM n, (SELECT unnest(range(8)) AS step) t JOIN walk w ON w.episode_id = n.episode_id AND w.s = n.s AND w.k = least(t.step + 1, n.n)""")
def action_chunk_long(spark, sf_dir):
    return _rounded_poses(sequence.action_chunk_rows(frames(spark, sf_dir), HORIZON, 0.1))


@query(_walk_sql("", "1::DOUBLE", 8) + f"""
SELECT f.episode_id, f.frame_index, t.step::INT AS step, round(coalesce(x, 0), {R}) + 0.0 AS x, round(coalesce(y, 0), {R}) + 0.0 AS y, round(coalesce(yaw, 0), {R}) + 0.0 AS yaw
FROM frames f CROSS JOIN (SELECT unnest(range(9)) AS step) t LEFT JOIN walk w ON w.episode_id = f.episode_id AND w.s = f.frame_index AND w.k = t.step""")
def future_trajectory_long(spark, sf_dir):
    return _rounded_poses(sequence.future_trajectory_rows(frames(spark, sf_dir), HORIZON))


@query(_walk_sql("", "0.1::DOUBLE", 5) + f"SELECT episode_id, s AS frame_index, k AS step, {_r('x')}, {_r('y')}, {_r('yaw')} FROM walk")
def indicator_curve_long(spark, sf_dir):
    return _rounded_poses(sequence.future_trajectory_rows(frames(spark, sf_dir), 5, 0.1, beyond=False))


@query(FRAMES_SQL + """SELECT a.episode_id, a.frame_index, count(b.frame_index) AS n_future, round(sum(b.vx), 6) AS sum_vx
FROM frames a JOIN frames b ON a.episode_id = b.episode_id AND b.frame_index BETWEEN a.frame_index AND a.frame_index + 7 GROUP BY ALL""")
def future_actions(spark, sf_dir):
    got = frames(spark, sf_dir).select("episode_id", "frame_index", sequence.following("vx", HORIZON).alias("a"))
    return got.select("episode_id", "frame_index", F.size("a").cast("long").alias("n_future"), F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), R).alias("sum_vx"))


@query(FRAMES_SQL + """, v AS (SELECT unnest([0, 1, 2]) AS dim, unnest([vx, -vy, -wz]) AS x FROM frames), x AS (SELECT dim, x::FLOAT::DOUBLE AS x FROM v)
SELECT dim, round(avg(x), 6) AS mean, round(greatest(stddev_pop(x), 1e-6), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, round(quantile_cont(x, 0.01), 6) AS q01, round(quantile_cont(x, 0.99), 6) AS q99 FROM x GROUP BY dim""")
def action_stats(spark, sf_dir):
    s = stats.array_statistics(frames(spark, sf_dir), F.array("vx", -F.col("vy"), -F.col("wz")))
    return s.select("dim", *(F.round(c, R).alias(c) for c in s.columns[1:]))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, robot_x AS x, -robot_z AS y, robot_y AS z, -robot_yaw AS yaw FROM frames")
def state_projection(spark, sf_dir):
    return frames(spark, sf_dir).select("episode_id", "frame_index", F.col("robot_x").alias("x"), (-F.col("robot_z")).alias("y"), F.col("robot_y").alias("z"), (-F.col("robot_yaw")).alias("yaw"))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, frame_index = max(frame_index) OVER (PARTITION BY episode_id) AS done FROM frames")
def done_flags(spark, sf_dir):
    return frames(spark, sf_dir).select("episode_id", "frame_index", sequence.is_last().alias("done"))


@query(FRAMES_SQL + "SELECT episode_id, frame_index, idx FROM frames")
def global_index(spark, sf_dir):
    return frames(spark, sf_dir, with_index=True).select("episode_id", "frame_index", "idx")


# ---- worklists


def _ranked(spark, sf_dir):
    """Frames with their index and the chunk and file of their episode, whose number is its place among users."""
    f = frames(spark, sf_dir, with_index=True)
    chunk, file = worklist.chunk_files(F.col("source_episode_id"), 20, 3)
    return f.select("episode_id", "source_episode_id", "frame_index", "idx", chunk.alias("chunk_index"), file.alias("file_index"))


RANKED_SQL = FRAMES_SQL + ", ranked AS (SELECT episode_id, source_episode_id, frame_index, idx, (source_episode_id // 20) // 3 AS chunk_index, (source_episode_id // 20) % 3 AS file_index FROM frames)"


@query(RANKED_SQL + """SELECT episode_id, frame_index, chunk_index, file_index,
  row_number() OVER (PARTITION BY chunk_index, file_index ORDER BY idx) - 1 AS video_frame_index, round((row_number() OVER (PARTITION BY chunk_index, file_index ORDER BY idx) - 1) / 10.0::DOUBLE, 6) AS from_s FROM ranked""")
def video_frame_index(spark, sf_dir):
    """Running frame number in a shard's video: a frame's global index less that of the shard's first one."""
    r = _ranked(spark, sf_dir)
    first = r.groupBy("chunk_index", "file_index").agg(F.min("idx").alias("first"))
    at = F.col("idx") - F.col("first")
    return r.join(first, ["chunk_index", "file_index"]).select("episode_id", "frame_index", "chunk_index", "file_index", at.alias("video_frame_index"), F.round(at / 10.0, R).alias("from_s"))


@query(FRAMES_SQL + "SELECT idx AS ref_id, idx // 1000 AS shard, idx % 1000 AS row_index, (idx // 1000) % 4 AS owner FROM frames")
def shard_assignment(spark, sf_dir):
    return worklist.shard_map(frames(spark, sf_dir, with_index=True).withColumnRenamed("idx", "ref_id"), 1000, 4)


def _inputs(spark, sf_dir):
    r = _ranked(spark, sf_dir)
    last = r.groupBy("episode_id").agg(F.max("frame_index").alias("last"))
    ref = F.format_string("%s/%06d/front", "episode_id", "frame_index")
    refs = r.join(last, "episode_id").where("frame_index < last").select((F.col("idx") - F.col("source_episode_id")).alias("ref_id"), ref.alias("ref"), "episode_id", "frame_index", F.lit("front").alias("camera_name"))
    videos = r.select(F.col("idx").alias("data_index"), F.lit("front_image").alias("video_key"), F.col("frame_index").alias("video_frame_index"), "chunk_index", "file_index")
    return refs, r.select("episode_id", "frame_index", F.col("idx").alias("data_index")), videos


WORK_SQL = RANKED_SQL + """, work AS (SELECT idx - source_episode_id AS ref_id, printf('%s/%06d/front', episode_id, frame_index) AS ref, episode_id, frame_index, 'front' AS camera_name, idx AS data_index, 'front_image' AS video_key,
  frame_index AS video_frame_index, chunk_index, file_index, printf('videos/front_image/chunk-%03d/part-%03d.mp4', chunk_index, file_index) AS video_path
  FROM ranked QUALIFY frame_index < max(frame_index) OVER (PARTITION BY episode_id))"""


@query(WORK_SQL + "SELECT * FROM work")
def worklist_join(spark, sf_dir):
    return worklist.assemble(*_inputs(spark, sf_dir))


@query(WORK_SQL + """, refs AS (SELECT ref_id, episode_id, frame_index, CASE WHEN ref_id % 50 = 7 THEN 'left' ELSE camera_name END AS camera_name FROM work WHERE ref_id % 71 <> 17),
records AS (SELECT episode_id, frame_index, idx FROM ranked WHERE idx % 97 <> 3 UNION ALL SELECT episode_id, frame_index, idx FROM ranked WHERE idx % 89 = 5 AND idx % 97 <> 3),
videos AS (SELECT idx FROM ranked WHERE idx % 83 <> 11 UNION ALL SELECT idx FROM ranked WHERE idx % 79 = 13 AND idx % 83 <> 11),
j AS (SELECT ref_id, camera_name, nf, nv FROM refs LEFT JOIN (SELECT episode_id, frame_index, count(*) AS nf, min(idx) AS idx FROM records GROUP BY ALL) USING (episode_id, frame_index) LEFT JOIN (SELECT idx, count(*) AS nv FROM videos GROUP BY idx) USING (idx))
SELECT sum((nf IS NULL)::INT)::BIGINT AS without_frame, sum((nf IS NOT NULL AND nv IS NULL)::INT)::BIGINT AS without_video, sum(coalesce(nf > 1, false)::INT)::BIGINT AS repeated_frames, sum(coalesce(nv > 1, false)::INT)::BIGINT AS repeated_videos,
  sum((camera_name <> 'front')::INT)::BIGINT AS other_cameras, max(ref_id) - min(ref_id) + 1 - count(DISTINCT ref_id) AS id_gaps FROM j""")
def worklist_audit(spark, sf_dir):
    """The audit of inputs with planted faults of each kind."""
    refs, records, videos = _inputs(spark, sf_dir)
    refs = refs.where("ref_id % 71 <> 17").withColumn("camera_name", F.when(F.col("ref_id") % 50 == 7, "left").otherwise(F.col("camera_name")))
    records, videos = records.where("data_index % 97 <> 3"), videos.where("data_index % 83 <> 11")
    return worklist.audit(refs, records.unionByName(records.where("data_index % 89 = 5")), videos.unionByName(videos.where("data_index % 79 = 13")))


@query(WORK_SQL + "SELECT video_path, min(video_frame_index) AS first_frame, max(video_frame_index) AS last_frame FROM work GROUP BY video_path")
def video_bounds(spark, sf_dir):
    return worklist.video_bounds(worklist.assemble(*_inputs(spark, sf_dir)))


@query(WORK_SQL + """, firsts AS (SELECT video_path, min(ref_id) AS ref_id FROM work GROUP BY video_path), placed AS (SELECT *, row_number() OVER (ORDER BY ref_id) - 1 AS p, count(*) OVER () AS n FROM firsts)
SELECT video_path, ref_id FROM placed WHERE n <= 5 OR p IN (SELECT floor(i * (n - 1)::DOUBLE / 4 + 1e-9) FROM (SELECT unnest(range(5)) AS i), (SELECT count(*) AS n FROM firsts))""")
def pilot_sample(spark, sf_dir):
    return worklist.pilot(worklist.assemble(*_inputs(spark, sf_dir)), 5)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return worklist.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(FRAMES_SQL + "SELECT episode_id, frame_index, i::INT AS camera_index, camera AS camera_name FROM frames, (SELECT unnest(range(4)) AS i, unnest(['front', 'left', 'right', 'rear']) AS camera)")
def camera_cross(spark, sf_dir):
    return worklist.with_cameras(frames(spark, sf_dir).select("episode_id", "frame_index"), CAMERAS)


@query(WORK_SQL + "SELECT ref_id, episode_id FROM work WHERE frame_index % 3 <> 0")
def resume_pending(spark, sf_dir):
    work = worklist.assemble(*_inputs(spark, sf_dir)).select("ref_id", "episode_id", "frame_index")
    return worklist.pending(work, work.where("frame_index % 3 = 0"), ["ref_id"]).select("ref_id", "episode_id")
