"""Encoded episodes, sampled episodes, measures merged from stretches, halving search, and datasets with shared goals."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from pathloom.functions import geo
from pathloom.operators import folds, pool, sampling
from pathloom.sources import readers

EPISODE = "k long, objects array<struct<name:string,transform:array<double>>>, holders map<string,string>, states map<string,map<int,double>>, markers array<struct<name:string,type:string,offset:array<double>,link:string,object:string>>"


def _episodes(n):
    rng = random.Random(n)
    name = lambda: f"n{int(rng.paretovariate(0.6)) % 40}"  # noqa: E731  a third of all uses are one name
    out = []
    for k in range(n):
        objects = [(name(), [float(k), float(i)]) for i in range(rng.randint(0, 4))]
        holders = {name(): name() for _ in range(rng.randint(0, 3))}
        states = {name(): {i: float(i) for i in range(rng.randint(0, 2))} for _ in range(rng.randint(0, 3))}
        markers = [(name(), name(), [1.0, k / 2], name(), name()) for _ in range(rng.randint(0, 2))]
        out.append((k * 3 - 5, objects, holders, states, markers))
    return out


def _uses(e):
    _, objects, holders, states, markers = e
    return [o[0] for o in objects] + [x for p in holders.items() for x in p] + list(states) + [x for m in markers for x in (m[0], m[1], m[3], m[4])]


def test_pool_of_episodes(spark):
    rows = _episodes(120)
    # entries become maps in Spark, as a map that comes from Python has lost its order
    entries = [(k, o, list(h.items()), list(s.items()), m) for k, o, h, s, m in rows]
    listed = EPISODE.replace("holders map<string,string>", "holders array<struct<key:string,value:string>>").replace("states map<string,map<int,double>>", "states array<struct<key:string,value:map<int,double>>>")
    df = spark.createDataFrame(entries, listed).withColumns({c: F.map_from_entries(c) for c in ("holders", "states")}).repartition(5)
    coded = pool.encode(df, "k")
    ids = {}
    for e in rows:
        for x in _uses(e):
            ids.setdefault(x, len(ids))
    assert {r.name: r.id for r in coded.names.collect()} == ids
    flat = [t for e in rows for _, t in e[1]]
    assert [(r["at"], r.transform) for r in coded.pool.orderBy("at").collect()] == list(enumerate(flat))
    at = 0
    for r, e in zip(coded.episodes.orderBy("k").collect(), rows, strict=True):
        assert r.k == e[0] and [(o["name"], o["at"]) for o in r.objects] == [(ids[o[0]], at + i) for i, o in enumerate(e[1])]
        assert {h.key: h.value for h in r.holders} == {ids[a]: ids[b] for a, b in e[2].items()} and r.states == {ids[a]: v for a, v in e[3].items()}
        at += len(e[1])
    back = sorted(pool.decode(coded, "k").collect())
    assert [(r.k, [tuple(o) for o in r.objects], r.holders, r.states, [tuple(m) for m in r.markers]) for r in back] == rows


def test_pool_of_nulls_and_missing_entries(spark):
    df = spark.createDataFrame([(1, None, None, None, None), (2, [("a", None)], {}, {}, [])], EPISODE)
    coded = pool.encode(df, "k")
    assert [tuple(r) for r in pool.decode(coded, "k").orderBy("k").collect()] == [(1, [], {}, {}, []), (2, [("a", None)], {}, {}, [])]
    for lacking in (pool.Encoded(coded.episodes, coded.names.limit(0), coded.pool), pool.Encoded(coded.episodes, coded.names, coded.pool.limit(0))):
        with pytest.raises(Exception, match="not in the"):
            pool.decode(lacking, "k").collect()
    assert pool.decode(pool.encode(df.limit(0), "k"), "k").count() == 0


def test_sampled_episodes(spark):
    scenes = spark.createDataFrame([("a", 20.0, 1), ("b", 20.0, 4), ("tiny", 0.5, 1)], "scene string, side double, floors int")
    made = lambda **o: sorted(map(tuple, sampling.sampled_episodes(scenes, 8, "s", near=2.0, far=25.0, **o).collect()))
    got = made(most_targets=200)
    assert got == made(most_targets=200)  # whatever the partitions
    assert [r[:2] for r in got if r[0] != "tiny"] == [(s, i) for s in "ab" for i in range(8)] and not [r for r in got if r[0] == "tiny"]
    assert all(1 <= r[3] <= 10 and 2 <= r[9] <= 25 for r in got)
    once = made(retries=1, most_targets=200)
    assert all(r[3] == 1 for r in once) and once != got
    assert len(made(most_targets=2)) < 16


@pytest.mark.parametrize("partitions", [1, 7])
def test_stretches_merge_in_order(spark, partitions):
    """One key has most of the rows; its stretches lie in several tasks."""
    rng = random.Random(4)
    rows = [("hot", i, rng.choice([-3.0, -1.0, 2.0, 4.0])) for i in range(2000)] + [(f"k{j}", i, float(rng.randint(-2, 3))) for j in range(5) for i in range(rng.randint(1, 9))]
    rng.shuffle(rows)
    want = {}
    for k, _, s in sorted(rows):
        want[k] = min(9.0, max(-1.0, want.get(k, 2.0) + s))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "k string, i int, s double")
        got = {r.k: r.meter for r in folds.measured(df, ["k"], ["i"], ["s"], folds.Patience(lambda r: r["s"], -1.0, 9.0, 2.0), "meter").collect()}
        assert folds.measured(df.limit(0), ["k"], ["i"], ["s"], folds.Patience(lambda r: r["s"]), "meter").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == want
    with pytest.raises(ValueError):
        folds.measured(df, [], ["i"], ["s"], folds.Patience(lambda r: r["s"]), "meter")


def test_a_measure_of_ones_own(spark):
    """Pairs of neighbours that are equal: its state needs both ends of a stretch."""

    class Repeats:
        def reset(self):
            return None

        def update(self, state, row):
            return self.merge(state, [row["v"], row["v"], 0])

        def merge(self, left, right):
            return right if left is None else left if right is None else [left[0], right[1], left[2] + right[2] + (left[1] == right[0])]

        def result(self, state):
            return None if state is None else float(state[2])

    values = [random.Random(8).randint(0, 2) for _ in range(500)]
    df = spark.createDataFrame([(None, i, v) for i, v in enumerate(values)], "k long, i long, v int").repartition(6)
    assert [tuple(r) for r in folds.measured(df, ["k"], ["i"], ["v"], Repeats(), "n").collect()] == [(None, float(sum(a == b for a, b in zip(values, values[1:]))))]


def test_halving(spark):
    def plain(v, x):
        left, right = 0, len(v) - 1
        while left <= right:
            mid = (left + right) // 2
            if v[mid] == x:
                return mid
            left, right = (mid + 1, right) if v[mid] < x else (left, mid - 1)
        return min(left, len(v) - 1) if v else None

    rng = random.Random(1)
    rows = [(sorted(float(rng.randint(0, 9)) for _ in range(n)), rng.randint(-1, 20) / 2) for n in [*range(20), 100] for _ in range(12)]
    got = spark.createDataFrame(rows, "v array<double>, x double").select("v", "x", geo.search_place(F.col("v"), F.col("x")).alias("p")).collect()
    assert all(r.p == plain(r.v, r.x) for r in got)


def test_goal_datasets(spark, tmp_path):
    ids = {"chair": 0, "bed": 1}
    goals = lambda *xs: [{"object_category": "chair", "position": [x, 0, 0], "radius": 1} for x in xs]
    ep = lambda cat, own=None: {"scene_id": "data/scene_datasets/m/s.glb", "object_category": cat, "goals": own}

    def put(name, **body):
        with gzip.open(f"{tmp_path}/{name}.json.gz", "wt") as f:
            json.dump({"category_to_task_category_id": ids, "category_to_mp3d_category_id": ids} | body, f)
        return f"{tmp_path}/{name}.json.gz"

    pooled = put("pooled", goals_by_category={"s.glb_chair": goals(1, 2), "s.glb_bed": []}, episodes=[ep("chair"), ep("bed"), ep("chair")])
    got = readers.goal_dataset(spark, pooled, "/scenes").orderBy("episode_id").collect()
    assert [(r.episode_id, r.scene_id, len(r.goals)) for r in got] == [("0", "/scenes/m/s.glb", 2), ("1", "/scenes/m/s.glb", 0), ("2", "/scenes/m/s.glb", 2)]
    inside = put("inside", episodes=[ep(None, goals(5)), ep(None, goals(6, 7))])
    assert [[g.position[0] for g in r.goals] for r in readers.goal_dataset(spark, inside).orderBy("episode_id").collect()] == [[5.0], [5.0]]
    lacking = put("lacking", goals_by_category={"s.glb_chair": goals(1)}, episodes=[ep("chair"), ep("bed")])
    with pytest.raises(Exception, match="no goals for s.glb_bed"):
        readers.goal_dataset(spark, lacking).collect()
    assert [r.goals is None for r in readers.goal_dataset(spark, lacking, strict=False).orderBy("episode_id").collect()] == [False, True]
    with pytest.raises(Exception, match="categories differ"):
        readers.goal_dataset(spark, put("differ", category_to_mp3d_category_id={"chair": 0}, episodes=[ep("chair", goals(1))])).collect()
    assert readers.goal_dataset(spark, put("none", episodes=[])).count() == 0


def test_goals_are_looked_up_by_rows(spark, tmp_path):
    goals = [{"position": [float(i)]} for i in range(300)]
    ids = {"chair": 0}
    episodes = [{"scene_id": "data/scene_datasets/a.glb", "object_category": "chair", "start_position": [float(i)]} for i in range(400)]
    with gzip.open(f"{tmp_path}/a.json.gz", "wt") as f:
        json.dump({"category_to_task_category_id": ids, "category_to_mp3d_category_id": ids, "goals_by_category": {"a.glb_chair": goals}, "episodes": episodes}, f)
    got = readers.goal_dataset(spark, f"{tmp_path}/a.json.gz")
    assert got.select(F.count("*"), F.sum(F.size("goals")), F.sum(F.col("start_position")[0])).first()[:] == (400, 400 * 300, 399 * 200.0)
    # a pool's goals meet its episodes in a join of rows that is not broadcast, never as one array of all episodes' goals
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "arrays_zip" not in plan


def test_a_small_dictionary_is_no_shuffle_by_name(spark):
    """Few names have most of the slots; orders that are numbers and those that are not give the same numbers of names."""
    df = spark.createDataFrame(_episodes(9), EPISODE)
    coded, other = pool.encode(df, "k"), pool.encode(df.withColumn("k", F.format_string("%020d", F.col("k") + 10**6)), "k")
    assert sorted(map(tuple, coded.names.collect())) == sorted(map(tuple, other.names.collect()))
    looked = pool._numbered(df, "k", F.transform("objects", lambda x: x["name"]), coded.names, "name", "id")
    assert "BroadcastHashJoin" in looked._jdf.queryExecution().executedPlan().toString()
