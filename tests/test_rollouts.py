"""Rollout operators on golden values and small cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pathloom.functions import actions, geo, pixels, text
from pathloom.operators import context, datasets, evaluate, guard, logic, measures, prefix, sequence, stats, worklist


def steps(spark, lengths, **columns):
    rows = [(f"e{e}", e, f) for e, n in enumerate(lengths) for f in range(n)]
    df = spark.createDataFrame(rows, "episode_id string, number long, frame_index long")
    return df.withColumns(columns) if columns else df


def by_step(df, *names):
    return [tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.orderBy("episode_id", "frame_index").collect()]


def test_summary_of_eight_episodes(spark):
    pairs = [(384, 383), (329, 305), (107, 107), (177, 177), (244, 242), (191, 191), (203, 203), (178, 178)]
    df = spark.createDataFrame([(t, f, True, 0.0) for t, f in pairs], "total_step long, following_step long, success boolean, collision double")
    df = df.withColumn("rate", evaluate.following_rate(F.col("following_step"), F.col("total_step")))
    s = evaluate.summary(df).first()
    assert (s.n, s.success_rate, s.collision_rate, s.mean_total_step, s.collision_episodes) == (8, 1.0, 0.0, 226.625, 0)
    assert s.tracking_rate == s.mean_following_rate == pytest.approx(1786 / 1813, abs=1e-12)
    assert tuple(evaluate.summary(df.limit(0)).first()) == (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0)


def test_history_counts_tokens_and_offsets(spark):
    counted = context.counts(steps(spark, [5, 2]), 72)
    assert by_step(counted, "n_blocks") == [0, 1, 2, 2, 2, 0, 1]
    assert by_step(counted, "total_tokens") == [64, 68, 72, 72, 72, 64, 68]
    index = context.offsets(counted, ["number"])
    assert by_step(index, "offset") == [0, 0, 1, 3, 5, 7, 7]
    assert tuple(context.violations(index, ["number"], 72).first()) == (0, 0, 0, 8, 0)
    broken = index.withColumn("offset", F.col("offset") + (F.col("frame_index") == 3).cast("int")).withColumn("total_tokens", F.lit(64))
    bad = context.violations(broken, ["number"], 72).first()
    assert bad.gaps == 2 and bad.wrong_tokens == 5
    assert tuple(context.estimate(steps(spark, [5, 2]), 2).first()) == (2, 7, 5, 8, 168)
    assert context.blocks_plain(1024) == 240 and context.blocks_marked(1024) == 191 and context.blocks_plain(10) == 0


def test_references_are_chronological(spark):
    refs = context.references(steps(spark, [6]), 3, ["front"]).where("frame_index = 5").orderBy("step").collect()
    assert [r.ref_frame for r in refs] == [2, 3, 4] and refs[0].ref == "e0/000002/front" and [r.token_count_after for r in refs] == [1, 2, 3]


def test_decay_rate_meets_its_target():
    for h, budget in ((100, 200), (50, 150), (400, 1024)):
        k, target = context.decay_rate(h, budget), (budget - 65) / 5
        if 0 < k < 1e6:
            assert h * (0.9 * (1 - math.exp(-k)) / k + 0.1) == pytest.approx(target, rel=1e-9)
    assert context.decay_rate(0, 100) == 0.0 and context.decay_rate(10, 1024) == 0.0 and context.decay_rate(1000, 70) == 1e6


def test_greedy_dedup_compares_with_the_last_kept(spark):
    rng = random.Random(3)
    hashes = [rng.choice(["0" * 16, "0" * 15 + "f", "f" * 16, "00000000ffffffff"]) for _ in range(12)]
    df = spark.createDataFrame([("e", i, h) for i, h in enumerate(hashes)], "episode_id string, frame_index long, front_dhash string")
    got = {i: [] for i in range(12)}
    for r in context.deduplicated_history(df, 3, threshold=10).orderBy("frame_index", "step").collect():
        assert r.step == len(got[r.frame_index])
        got[r.frame_index].append((r.kept_frame, r.distance))
    for anchor in range(12):
        kept = []
        for j in range(anchor - 1, -1, -1):
            d = 64 if not kept else (int(hashes[j], 16) ^ int(hashes[kept[-1][0]], 16)).bit_count()
            if len(kept) < 3 and (not kept or d > 10):
                kept.append((j, d))
        assert got[anchor] == kept[::-1]


def walk(velocities, dt, sign):
    x = y = yaw = 0.0
    out = []
    for vx, vy, wz in velocities:
        x += (math.cos(yaw) * vx - math.sin(yaw) * sign * vy) * dt
        y += (math.sin(yaw) * vx + math.cos(yaw) * sign * vy) * dt
        yaw += sign * wz * dt
        out.append((x, y, yaw))
    return out


def poses_of(rows):
    out = {}
    for r in rows.orderBy("frame_index", "step").collect():
        out.setdefault(r.frame_index, []).extend((r.x, r.y, r.yaw))
    return out


def test_future_poses_and_their_ends(spark):
    rng = random.Random(4)
    v = [tuple(rng.uniform(-1, 1) for _ in range(3)) for _ in range(12)]
    bad = {7: (None, 1.0, 1.0), 9: (float("nan"), 0.0, 0.0)}
    df = spark.createDataFrame([("e", i, *bad.get(i, x)) for i, x in enumerate(v)], "episode_id string, frame_index long, vx double, vy double, wz double")
    chunk = {r.frame_index: [tuple(p) for p in r.c] for r in df.select("frame_index", sequence.action_chunk(4, 0.1).alias("c")).collect()}
    for s in range(12):
        valid = []
        for j in range(s, min(s + 4, 12)):
            if j in bad:
                break
            valid.append(v[j])
        poses = walk(valid, 0.1, -1) or [(0.0, 0.0, 0.0)]
        want = poses + [poses[-1]] * (4 - len(poses))
        assert [x for p in chunk[s] for x in p] == pytest.approx([x for p in want for x in p], abs=1e-12)
    assert poses_of(sequence.action_chunk_rows(df, 4, 0.1)) == {s: pytest.approx([x for p in chunk[s] for x in p], abs=1e-9) for s in range(12)}
    good = spark.createDataFrame([("e", i, *x) for i, x in enumerate(v)], "episode_id string, frame_index long, vx double, vy double, wz double")
    rows = good.select("frame_index", sequence.future_trajectory(4).alias("t"), sequence.indicator_curve(4, 0.1).alias("i"), sequence.history("frame_index", 2).alias("h")).collect()
    for r in rows:
        poses = walk(v[r.frame_index : r.frame_index + 4], 1.0, 1)
        want = [(0.0, 0.0, 0.0), *poses] + [(0.0, 0.0, 0.0)] * (4 - len(poses))
        assert [x for p in r.t for x in p] == pytest.approx([x for p in want for x in p], abs=1e-9)
        assert len(r.i) == 1 + min(5, 12 - r.frame_index)
        assert r.h == list(range(max(0, r.frame_index - 2), r.frame_index))
    assert poses_of(sequence.future_trajectory_rows(good, 4)) == {r.frame_index: pytest.approx([x for p in r.t for x in p], abs=1e-9) for r in rows}
    assert poses_of(sequence.future_trajectory_rows(good, 5, 0.1, beyond=False)) == {r.frame_index: pytest.approx([x for p in r.i for x in p], abs=1e-9) for r in rows}
    broken = poses_of(sequence.future_trajectory_rows(df, 4))
    assert broken[5][:9] == pytest.approx([x for p in [(0.0, 0.0, 0.0), *walk(v[5:7], 1.0, 1)] for x in p], abs=1e-9) and broken[5][9:] == [None] * 6
    assert sequence.action_chunk_rows(df.limit(0)).count() == 0


def test_early_end_rules(spark):
    def run(rows):
        df = spark.createDataFrame([("e", i, *r) for i, r in enumerate(rows)], "episode_id string, frame_index long, human_following boolean, dis_to_human double, human_x double, human_z double, human_collision boolean")
        return tuple(evaluate.early_end(df, lost_after=3, stuck_after=4).first())[1:]

    moving = lambda i: (float(i), 0.0, False)
    assert run([(True, 1.0, *moving(i)) for i in range(10)]) == (None, None, 10)
    # a near step that does not follow neither counts nor resets
    assert run([(False, 3.0 if i == 2 else 5.0, *moving(i)) for i in range(10)]) == (4, "Lost", 4)
    assert run([(i == 2, 5.0, *moving(i)) for i in range(10)]) == (6, "Lost", 6)
    assert run([(True, 1.0, 0.0, 0.0, False) for _ in range(10)]) == (4, "HumanStuck", 5)
    assert run([(True, 1.0, float(i), 0.0, i == 3) for i in range(10)]) == (3, "Collision", 4)


def test_reasons_and_acceptance(spark):
    rows = [("Normal", 10, True, 0.0, True, True, 0.9), ("Lost", 0, False, 0.0, False, False, 0.1), ("Collision", 5, True, 1.0, True, True, 0.9), ("Odd", 5, True, 1.0, True, None, 0.9)]
    df = spark.createDataFrame(rows, "s string, n long, f boolean, c double, w boolean, v boolean, r double")
    got = [r[0] for r in df.select(evaluate.failure_reasons(*map(F.col, "s n f c w v r".split()))).collect()]
    assert got[0] == ["rollout_rejected_unknown"]
    assert got[1] == ["lost_main_human", "empty_trajectory", "episode_incomplete", "following_not_achieved", "target_not_visible_at_end", "low_following_rate"]
    assert got[2] == ["human_collision"] and got[3] == ["status_odd", "human_collision", "target_not_visible_at_end"]


def test_folds(spark):
    df = steps(spark, [6], f=F.element_at(F.array(*map(F.lit, [1.0, 1.2, 3.0, 2.0, 2.4, 4.0])), (F.col("frame_index") + 1).cast("int")))
    assert by_step(sequence.accumulated_force(df, "f", 1.0), "accum") == pytest.approx([0, 0, 2.0, 2.0, 2.0, 4.0])
    ema = by_step(sequence.ema_velocity(df.withColumn("z", F.lit(0.0)), "f", "z", dt=1.0), "vx")
    want, v = [0.0], None
    for a, b in zip([1.0, 1.2, 3.0, 2.0, 2.4], [1.2, 3.0, 2.0, 2.4, 4.0], strict=True):
        v = b - a if v is None else 0.65 * v + 0.35 * (b - a)
        want.append(v)
    assert ema == pytest.approx(want)
    assert by_step(sequence.slew_limited(df, "f", 1.0, dt=0.3), "limited") == pytest.approx([0.3, 0.6, 0.9, 1.0, 1.0, 1.0])
    padded = spark.range(1).select(sequence.pad_to_length(F.array(F.lit(1), F.lit(2)), 4), sequence.pad_to_length(F.array(F.lit(1), F.lit(2)), 1), sequence.pad_to_length(F.array().cast("array<int>"), 3), sequence.pad_to_length(F.array().cast("array<array<int>>"), 2, F.array().cast("array<int>")), sequence.pad_to_length(F.array(F.lit(1)), -1)).first()
    assert tuple(padded) == ([1, 2, 2, 2], [1], [None] * 3, [[], []], [])


def work_tables(spark):
    refs = spark.createDataFrame([(0, "episode/000000/front", "episode", 0, "front"), (1, "episode/000001/front", "episode", 1, "front")], "ref_id long, ref string, episode_id string, frame_index long, camera_name string")
    frames = spark.createDataFrame([("episode", 0, 10), ("episode", 1, 11)], "episode_id string, frame_index long, data_index long")
    videos = spark.createDataFrame([(10, "front_image", 4, 2, 7), (11, "front_image", 5, 2, 7)], "data_index long, video_key string, video_frame_index long, chunk_index long, file_index long")
    return refs, frames, videos


def test_worklist_joins_one_to_one(spark):
    refs, frames, videos = work_tables(spark)
    rows = worklist.checked(refs, frames, videos).orderBy("ref_id").collect()
    assert [r.ref_id for r in rows] == [0, 1] and rows[0].data_index == 10 and rows[0].video_path == "videos/front_image/chunk-002/part-007.mp4"
    assert list(rows[0].asDict()) == worklist.COLUMNS
    for bad in ((refs, frames, videos.limit(1)), (refs, frames.union(frames.limit(1)), videos), (refs.withColumn("camera_name", F.lit("left")), frames, videos), (refs.withColumn("ref_id", F.col("ref_id") * 2), frames, videos)):
        with pytest.raises(ValueError, match="one to one"):
            worklist.checked(*bad)
    with pytest.raises(ValueError, match="lacks"):
        worklist.require_columns(refs, ["nope"], "refs")
    with pytest.raises(ValueError, match="repeats"):
        worklist.assert_unique(refs.union(refs), ["ref_id"], "refs")
    with pytest.raises(ValueError, match="cameras"):
        worklist.normalized_cameras(["up"], ["front"])
    assert worklist.normalized_cameras(["left", "front", "left"], ["front", "left"]) == ["left", "front"]


def test_pooling_grids(spark):
    cells = spark.range(144).select(F.lit(1).alias("k"), F.col("id").alias("cell"), F.col("id").cast("double").alias("x"))
    assert [r.x for r in stats.pooled(cells, ["k"], 12, 2).orderBy("bin").collect()] == [32.5, 38.5, 104.5, 110.5]
    odd = spark.range(9).select(F.lit(1).alias("k"), F.col("id").alias("cell"), F.col("id").cast("double").alias("x"))
    assert [r.x for r in stats.pooled(odd, ["k"], 3, 2).orderBy("bin").collect()] == [2.0, 3.0, 5.0, 6.0]  # overlapping bins


def test_running_before_is_global(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("n"))
    got = prefix.running_before(df, ["id"], F.col("n"), "before").orderBy("id").collect()
    total = 0
    for r in got:
        assert r.before == total
        total += r.n


def test_geometry(spark):
    q = geo.from_yaw(F.lit(0.5))
    turned = geo.rotate(q, F.lit(1.0), F.lit(2.0), F.lit(3.0))
    row = spark.range(1).select(*turned, geo.yaw_of(q), geo.angle_between_quaternions(q, geo.from_yaw(F.lit(-0.2))), geo.wrap_angle(F.lit(4.0)), *geo.solve2(*map(F.lit, (2.0, 0.0, 0.0, 4.0, 2.0, 8.0))), *geo.solve2(*map(F.lit, (1.0, 0.0, 0.0, 0.0, 3.0, 0.0)))).first()
    assert row[:3] == pytest.approx((math.cos(0.5) + 3 * math.sin(0.5), 2.0, 3 * math.cos(0.5) - math.sin(0.5)))
    assert row[3:] == pytest.approx((0.5, 0.7, 4.0 - 2 * math.pi, 1.0, 2.0, 3.0, 0.0))
    points = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(z).alias("z")) for x, z in ((0.0, 0.0), (2.0, 0.0), (2.0, 2.0))))
    n = spark.range(1).select(geo.nearest_on_path(points, F.lit(1.0), F.lit(0.5), F.lit(2.0)).alias("n")).first().n
    assert tuple(n) == pytest.approx((0, 0.5, 3.0, 2.0, 1.0))


def test_guard_retreats_in_an_emergency(spark):
    rows = [(0.0, 0.0, 0.5, 0.0, 0.0, 0.0, 1.0, 0.3, 2.0), (0.0, 0.0, 5.0, 0.0, 0.0, 0.0, 1.0, 0.3, 2.0), (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 2.0)]
    df = spark.createDataFrame(rows, "rx double, rz double, hx double, hz double, hvx double, hvz double, vx double, vz double, wz double")
    near, far, same = guard.guarded(df).collect()
    assert near.emergency and near.safe_vx == pytest.approx(-5.0) and near.safe_vz == pytest.approx(0.2) and near.safe_wz == 0.5
    assert not far.active and (far.safe_vx, far.safe_wz, far.correction) == (1.0, 2.0, 0.0)
    assert (same.safe_vx, same.safe_vz, same.safe_wz) == (0.0, 0.0, 0.0)


def test_text_functions(spark):
    row = spark.range(1).select(text.tokens(F.lit("Where's the  red-car, left?")).alias("t"), *text.parse_ref(F.lit("a/b/000007/front")), *text.call_parts(F.lit("at( x, y )")), text.scene_name(F.lit("d/s.basis.glb")).alias("s"), text.scene_name(F.lit("d/s.basis.glb"), True).alias("s1")).first()
    assert row.t == ["where", "'", "s", "the", "red-car", "left"] and (row.episode_id, row.frame_index, row.camera) == ("a/b", 7, "front")
    assert (row.name, row.args, row.s, row.s1) == ("at", ["x", "y"], "s.basis", "s")
    values = spark.createDataFrame([("false",), ("0",), ("2",), ('"false"',), (None,), ("",)], "v string")
    assert [r[0] for r in values.select(text.truthy(F.col("v"))).collect()] == [False, False, True, True, False, False]
    names = spark.createDataFrame([("10",), ("9",), ("b",), ("a2",), ("a10",)], "n string")
    assert [r.n for r in names.orderBy(*text.natural_key(F.col("n"))).collect()] == ["9", "10", "a10", "a2", "b"]
    assert [r.n for r in names.orderBy(text.natural_split_key(F.col("n"))).collect()] == ["9", "10", "a2", "a10", "b"]
    words = spark.createDataFrame([(0, ["b", "a", "b"]), (1, ["a", "c", "b"])], "p long, w array<string>")
    vocabulary = text.vocabulary(words, "w", "p", least=2)
    assert {r.word: r.id for r in vocabulary.collect()} == {"<pad>": 0, "<s>": 1, "</s>": 2, "<unk>": 3, "b": 4, "a": 5}
    assert [r.id for r in text.word_ids(words, "w", "p", vocabulary).orderBy("p", "i").collect()] == [4, 5, 4, 5, 3, 4]


def test_logic(spark):
    closure = logic.type_closure(spark.createDataFrame([("cat", "animal"), ("animal", "thing")], "sub string, super string"))
    assert {tuple(r) for r in closure.collect()} == {("cat", "cat"), ("animal", "animal"), ("thing", "thing"), ("cat", "animal"), ("animal", "thing"), ("cat", "thing")}
    entities = spark.createDataFrame([("tom", "cat"), ("rex", "animal"), ("box", "thing")], "name string, type string")
    assert {tuple(r) for r in logic.assignments(entities, closure, ["cat", "thing"]).collect()} == {("tom", "rex"), ("tom", "box")}
    assert logic.assignments(entities, closure, ["thing", "thing"], ordered=False).count() == 3
    row = spark.range(1).select(F.lit(True).alias("a"), F.lit(False).alias("b")).select(*(logic.formula((op, "a", "b")) for op in ("and", "nand", "or", "nor"))).first()
    assert tuple(row) == (False, True, True, False)


def test_splits_drop_the_remainder(spark):
    df = spark.range(23).select(F.col("id"), (F.col("id") % 4).alias("scene"))
    got = datasets.splits(df, "id", 5, "s", collate="scene").collect()
    assert len(got) == 20 and sorted(r.split for r in got) == sorted(list(range(5)) * 4)
    assert got and {tuple(r) for r in got} == {tuple(r) for r in datasets.splits(df, "id", 5, "s", collate="scene").collect()}
    with pytest.raises(ValueError, match="evenly"):
        datasets.balanced_scene(F.lit(1), 10, 3)


def test_commands_keep_their_limits(spark):
    limits = actions.ActionLimits(2.0, 0.5, 3.0, allow_back=False)
    df = spark.createDataFrame([(0.5, -2.0, 0.1), (-0.5, 0.4, -1.0)], "f double, l double, t double")
    out = df.select(*actions.physical(F.col("f"), F.col("l"), F.col("t"), limits)).collect()
    assert [tuple(round(x, 9) for x in r) for r in out] == [(1.0, -0.5, 0.3), (0.0, 0.2, -3.0)]
    back = df.select(*actions.normalized(F.lit(1.0), F.lit(-0.25), F.lit(9.0), limits)).first()
    assert tuple(back) == (0.5, -0.5, 1.0)
    fit = df.select(*actions.within_axes(F.lit(4.0), F.lit(0.5), limits)).first()
    assert tuple(fit) == (2.0, 0.25)


def test_difference_hash_of_a_picture(spark):
    falling = [9 - c for _ in range(8) for c in range(9)]
    df = spark.createDataFrame([(falling,), ([0] * 72,), ([5] + [1] * 71,), ([1, 2],), (None,)], "p array<int>")
    got = [r[0] for r in df.select(pixels.difference_hash(F.col("p"))).collect()]
    assert got == ["f" * 16, "0" * 16, "8" + "0" * 15, None, None]


def test_measures_need_what_stands_before_them(spark):
    chain = measures.Measures().add("a", lambda: F.col("id") + 1).add("b", lambda: F.col("a") * 2, ("a",))
    assert chain.apply(spark.range(1)).first().b == 2
    with pytest.raises(ValueError):
        chain.add("a", lambda: F.lit(1))
    with pytest.raises(ValueError):
        measures.Measures().add("b", lambda: F.col("a"), ("a",))


def test_smoothing_limits_and_order_of_visits(spark):
    df = steps(spark, [4], x=F.col("frame_index").cast("double"), timestamp_s=F.col("frame_index") / 10.0)
    assert by_step(sequence.smoothed(df, "x", 0.5), "smoothed") == [0.0, 0.5, 1.25, 2.125]
    gaps = df.withColumn("x", F.when(F.col("frame_index") != 1, F.col("x")))
    assert by_step(sequence.smoothed(gaps, "x", 0.5), "smoothed") == [0.0, 0.0, 1.0, 2.0]
    assert sequence.within_limits(df, 3).count() == 3 and sequence.within_limits(df, None, 0.15).count() == 2
    eps = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(6)], "k long, s string")
    visits = datasets.iteration_order(eps, "k", "s", None, 2).orderBy("turn", "s", "place").collect()
    assert [r.k for r in visits] == [0, 2, 1, 3, 4, 5]
    made = datasets.generated_episodes(eps.select("s").distinct(), "s", 5, "z").collect()
    assert len(made) == 10 and all(0 <= r.start_x < 10 for r in made) and datasets.generated_episodes(eps, "s", 0, "z").count() == 0


def test_poses_points_and_nested_fields(spark):
    one = spark.range(1)
    a = (F.lit(0.0), F.lit(0.0)), (F.lit(2.0), F.lit(0.0)), (F.lit(0.0), F.lit(2.0))
    assert tuple(one.select(*geo.triangle_point(*a, F.lit(0.75), F.lit(0.75))).first()) == (0.5, 0.5)
    assert one.select(geo.metres_per_pixel((F.lit(0.0), F.lit(0.0)), (F.lit(8.0), F.lit(4.0)), 2)).first()[0] == 2.0
    turn, at = geo.relative_pose(geo.from_yaw(F.lit(0.3)), *(F.lit(1.0),) * 3, geo.from_yaw(F.lit(0.3)), *(F.lit(1.0),) * 3)
    assert tuple(one.select(turn["w"], *at).first()) == pytest.approx((1.0, 0.0, 0.0, 0.0))
    nested = one.select(F.struct(F.lit(1).alias("b"), F.struct(F.lit(2).alias("d")).alias("c")).alias("a"), "id")
    flat = nested.select(*text.flat_fields(nested))
    assert flat.columns == ["a.b", "a.c.d", "id"] and tuple(flat.first()) == (1, 2, 0)
    ids = spark.createDataFrame([([0, 2, 1],), ([],)], "i array<int>")
    assert [r[0] for r in ids.select(text.sentence(F.col("i"), F.array(F.lit("p"), F.lit("x"), F.lit("y")))).collect()] == ["y x ?", "?"]


def test_approach_reward_skips_what_was_not_measured(spark):
    rows = [("e", 0, 4.0, 0.5), ("e", 1, 2.0, 0.9), ("e", 2, 5.0, 0.1), ("e", 3, 1.5, 0.4), ("e", 4, -1.0, 0.2), ("e", 5, 1.0, None), ("e", 6, 1.0, 0.1)]
    df = spark.createDataFrame(rows, "episode_id string, frame_index long, d double, a double")
    got = by_step(df.withColumn("r", sequence.approach_reward("d", "a", 3.0)), "r")
    # 0: nothing before; 3: the angle of step 1 counts; 5: distance -1 was no measure, and there is no angle
    assert got == pytest.approx([0.0, 2.0, -3.0, 3.5 + 0.5, 2.5 + 0.2, 0.0, 0.1])


def test_turns_between_vectors(spark):
    pairs = [((1.0, 0.0, 0.0), (0.0, 3.0, 0.0)), ((1.0, 2.0, -0.5), (-0.3, 0.2, 0.9)), ((0.0, 2.0, 0.0), (0.0, -1.0, 0.0)), ((1.0, 1.0, 1.0), (-2.0, -2.0, -2.0)), ((0.4, 0.0, 0.0), (0.4, 0.0, 0.0))]
    df = spark.createDataFrame([(*a, *b) for a, b in pairs], "a0 double, a1 double, a2 double, b0 double, b1 double, b2 double")
    a, b = (tuple(F.col(f"{n}{i}") for i in range(3)) for n in "ab")
    turned = geo.rotate(geo.between_vectors(a, b), *a)
    for r, (u, v) in zip(df.select(*turned).collect(), pairs, strict=True):
        scale = math.dist(u, (0, 0, 0)) / math.dist(v, (0, 0, 0))
        assert tuple(r) == pytest.approx([x * scale for x in v], abs=1e-9)
    none = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0, 0.0, 0.0)], df.schema)
    assert none.select(geo.between_vectors(a, b)).first()[0] is None


def test_receptacle_sets_decide_in_order(spark):
    rows = [("top", "table_1"), ("top", "chair_1"), ("drawer", "table_1"), ("floor", None), ("top_floor", None), (None, "table_1")]
    df = spark.createDataFrame(rows, "name string, parent string")
    sets = [datasets.ReceptacleSet(objects=("table",), names=("top",), not_names=("drawer",)), datasets.ReceptacleSet(names=("floor", "drawer"), not_objects=("table",))]
    got = [r[0] for r in df.select(datasets.receptacle_matches(F.col("name"), F.col("parent"), sets)).collect()]
    assert got == [True, False, False, False, True, False]
    up = spark.createDataFrame([(0.0, 1.0, 0.0), (1.0, 1.0, 0.0), (0.0, 0.0, 0.0), (0.0, -1.0, 0.0)], "x double, y double, z double")
    assert [r[0] for r in up.select(datasets.upright(F.col("x"), F.col("y"), F.col("z"))).collect()] == [True, False, False, False]


def test_long_folds_and_many_episodes(spark):
    n = 3 * sequence.RUN + 7
    df = steps(spark, [n, 1, n, sequence.RUN], x=(F.col("frame_index") % 5).cast("double"))
    got = sequence.smoothed(df, "x", 0.5).orderBy("episode_id", "frame_index").collect()
    assert len(got) == 2 * n + 1 + sequence.RUN
    last = {}
    for r in got:
        x = float(r.frame_index % 5)
        last[r.episode_id] = x if r.frame_index == 0 else 0.5 * last[r.episode_id] + 0.5 * x
        assert r.smoothed == pytest.approx(last[r.episode_id])


def test_history_without_a_far_frame_goes_back_through_all(spark):
    df = spark.createDataFrame([(e, i, "f" * 16 if i == 0 else "0" * 16) for e in ("a", "b") for i in range(700)], "episode_id string, frame_index long, front_dhash string").repartition(3)
    got = context.deduplicated_history(df, 5).groupBy("episode_id").agg(F.count("*").alias("n"), F.sum((F.col("kept_frame") == 0).cast("int")).alias("oldest"), F.max("distance").alias("d")).collect()
    assert {(r.episode_id, r.n, r.oldest, r.d) for r in got} == {(e, 699 + 698, 699, 64) for e in ("a", "b")}
    assert context.deduplicated_history(df.limit(0), 5).count() == 0


def test_lookups_tell_what_is_missing(spark):
    table = spark.createDataFrame([("a", 1), ("b", None)], "ref string, ref_id long")
    uses = spark.createDataFrame([("a",), ("b",), ("a",)], "ref string")
    assert [r.ref_id for r in worklist.looked_up(uses, table, ["ref"], "ref_id").orderBy("ref").collect()] == [1, 1, None]
    with pytest.raises(Exception, match="no ref_id for c"):
        worklist.looked_up(uses.unionByName(spark.createDataFrame([("c",)], "ref string")), table, ["ref"], "ref_id").collect()


def test_types_in_a_cycle(spark):
    closure = logic.type_closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "sub string, super string"))
    assert {tuple(r) for r in closure.collect()} == {(x, y) for x in "abcd" for y in "abc"} | {("d", "d")}


def test_statistics_of_few_and_absent_values(spark):
    df = spark.createDataFrame([([1.0, None],), ([4.0, 2.0],), ([2.0, 2.0],), (None,)], "v array<double>")
    got = {r.dim: r for r in stats.array_statistics(df, F.col("v")).collect()}
    assert (got[0].min, got[0].max, got[0].mean) == (1.0, 4.0, pytest.approx(7 / 3)) and got[0].q01 == pytest.approx(1.02) and got[0].q99 == pytest.approx(3.96)
    assert (got[1].q01, got[1].q99, got[1].std) == (2.0, 2.0, 1e-6)
    assert stats.array_statistics(df.limit(0), F.col("v")).count() == 0


def test_encoders_are_held_to_their_shape(spark):
    import numpy as np

    from pathloom.functions import encode

    df = spark.createDataFrame([(i, [i, i + 1]) for i in range(5)] + [(9, None)], "k long, p array<int>")
    good = encode.encoded(df, "k", "p", lambda: lambda x: np.array(x, float).reshape(len(x), 2, 1), 2, 1, batch=2)
    assert sorted(tuple(r) for r in good.collect()) == sorted((i, t, [float(i + t)]) for i in range(5) for t in range(2))
    for bad in (lambda: lambda x: np.zeros((len(x), 1, 1)), lambda: lambda x: np.full((len(x), 2, 1), np.nan)):
        with pytest.raises(Exception, match="encoder gave"):
            encode.encoded(df, "k", "p", bad, 2, 1).collect()


def test_edges_small_angles_and_equally_near_segments(spark):
    one = spark.range(1)
    inside = lambda x, y: geo.in_triangle(F.lit(x), F.lit(y), (0.0, 0.0), (1.0, 0.0), (0.0, 1.0))
    assert tuple(one.select(inside(0.9, 0.1), inside(0.9, 0.11), inside(0.0, 1.0), inside(-0.1, 0.5)).first()) == (True, False, True, False)
    angle = lambda x, y: geo.angle_between(F.lit(x), F.lit(y), F.lit(1.0), F.lit(0.0))
    assert tuple(one.select(angle(1.0, 1e-9), angle(-1.0, 0.0), angle(0.0, 0.0)).first()) == (1e-9, 3.141592653589793, 0.0)
    # the point is nearest to a corner, and by roots of sums of squares the second segment's is nearer in the last digit
    x, z = (1.9, 2.86, 2.16), (0.0872, 0.9728, 0.7806000000000001)
    path = F.array(*(F.struct(F.lit(a).alias("x"), F.lit(b).alias("z")) for a, b in zip(x, z, strict=True)))
    t = ((3 - x[0]) * (x[1] - x[0]) + (1 - z[0]) * (z[1] - z[0])) / ((x[1] - x[0]) ** 2 + (z[1] - z[0]) ** 2)
    end = (x[0] + min(t, 1.0) * (x[1] - x[0]), z[0] + min(t, 1.0) * (z[1] - z[0]))
    first, second = (((3 - a) * (3 - a) + (1 - b) * (1 - b)) ** 0.5 for a, b in (end, (x[1], z[1])))
    assert one.select(geo.nearest_on_path(path, F.lit(3.0), F.lit(1.0), F.lit(2.0))["segment"]).first()[0] == (0 if first <= second else 1)
