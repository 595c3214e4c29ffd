"""Readers, writers and streams over small files."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from pathloom.sources import readers, schemas, sinks, versions
from pathloom.streaming import episodes


def put(path, value, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt") as f:
        f.write(value if isinstance(value, str) else json.dumps(value))


def test_discovery_and_results(spark, tmp_path):
    root = f"{tmp_path}/rollouts"
    for scene, name, cameras in (("s1", "10", 4), ("s1", "9", 4), ("s2", "3", 3)):
        put(f"{root}/{scene}/{name}_info.json", [{"frame_index": 0, "robot_pos": [0, 0, 0]}, {"frame_index": 1}])
        put(f"{root}/{scene}/{name}.json", {"success": True, "status": "Normal", "episode_id": name, "total_step": 2, "following_step": 1})
        for c in readers.CAMERAS[:cameras]:
            put(f"{root}/{scene}/{name}_{c}.mp4", "video")
    put(f"{root}/s1/summary.json", {"success": True})
    put(f"{root}/s1/broken.json", "{not json")
    with pytest.raises(FileNotFoundError, match="rear.mp4"):
        readers.discover(spark, root)
    found = {(r.scene, r.episode): (r.accepted, r.missing) for r in readers.discover(spark, root, skip_invalid=True).collect()}
    assert found == {("s1", "10"): (True, []), ("s1", "9"): (True, []), ("s2", "3"): (False, ["rear.mp4"])}
    assert [r.episode for r in readers.discover(spark, root, skip_invalid=True, limit=1).where("accepted").collect()] == ["9"]
    assert sorted(r.episode_id for r in readers.evaluation_results(spark, root).collect()) == ["10", "3", "9"]
    assert readers.step_logs(spark, f"{root}/s1/9_info.json").count() == 2


def test_episode_dataset_is_unzipped_and_filtered(spark, tmp_path):
    episodes_ = [{"episode_id": str(i), "scene_id": f"x/scene_datasets/mp3d/s{i % 2}.basis.glb", "start_position": [0.0, 1.0, 2.0]} for i in range(6)]
    put(f"{tmp_path}/d.json.gz", {"episodes": episodes_, "instruction_vocab": {"word_list": ["a", "b"]}}, gzip.open)
    rows = readers.episode_dataset(spark, f"{tmp_path}/d.json.gz", scenes=["s1.basis"], scenes_dir="/new").collect()
    assert {r.episode_id for r in rows} == {"1", "3", "5"} and rows[0].scene_id == "/new/mp3d/s1.basis.glb"
    assert [tuple(r) for r in readers.vocabulary_of(spark, f"{tmp_path}/d.json.gz").collect()] == [(0, "a"), (1, "b")]
    log = spark.createDataFrame([(0, "# failed split-id list: 1 2"), (1, "x"), (2, "# failed split-id list: 7, 9")], "number long, value string")
    assert readers.failed_splits(log, [0]) == [7, 9] and readers.failed_splits(log.limit(0), [0]) == [0]


def test_media_faults(spark):
    eps = spark.createDataFrame([("a", 0, 10), ("b", 1, 10), ("c", 2, 10), ("d", 3, 10)], "episode_id string, order long, n_steps long")
    rows = [(e, c, 9 if e == "b" and c == "left" else 10, 64 if e == "c" else 32, 32, 10.0) for e in "abc" for c in readers.CAMERAS]
    media = spark.createDataFrame(rows, "episode_id string, camera string, frames long, width int, height int, fps double")
    assert {r.episode_id: r.reason for r in readers.media_faults(eps, media, 10.0).collect()} == {"a": None, "b": "frame_count", "c": "other_size", "d": "missing_camera"}


def test_frame_record_faults(spark):
    rows = [(0, "a", 0, "f1"), (0, "b", 1, "f1"), (1, "a", 1, "f2")]
    df = spark.createDataFrame(rows, "episode_index long, episode_id string, index long, file string")
    assert {r.fault: r.n for r in readers.frame_record_faults(df).collect()} == {"episode_in_files": 1, "ids_of_number": 1, "repeated_index": 1}


def test_publish_backs_up_and_rolls_back(spark, tmp_path):
    target = f"{tmp_path}/index"
    build = lambda n: lambda stage: spark.range(n).write.parquet(stage)
    assert sinks.publish(spark, target, build(3)) is None
    with pytest.raises(FileExistsError):
        sinks.publish(spark, target, build(4))
    backup = sinks.publish(spark, target, build(5), replace=True)
    assert spark.read.parquet(target).count() == 5 and spark.read.parquet(backup).count() == 3

    def refuse(stage):
        raise ValueError("unsound")

    with pytest.raises(ValueError, match="unsound"):
        sinks.publish(spark, target, build(6), validate=refuse, replace=True)
    assert spark.read.parquet(target).count() == 5 and not [x for x in os.listdir(tmp_path) if "stage" in x]
    sinks.merge_parquet(spark, [target, backup], f"{tmp_path}/merged")
    assert spark.read.parquet(f"{tmp_path}/merged").count() == 8


def test_shards_resume(spark, tmp_path):
    work = spark.range(5).select(F.col("id").alias("ref_id"))
    out, spec = f"{tmp_path}/shards", {"model": "m", "size": 2}
    assert sinks.write_shards(work, out, spec, shard_size=2) == 3
    assert sinks.write_shards(work, out, spec, shard_size=2) == 0
    assert sinks.write_shards(spark.range(8).select(F.col("id").alias("ref_id")), out, spec, shard_size=2) == 2
    assert sorted(r.ref_id for r in spark.read.parquet(f"{out}/data").collect()) == list(range(8))
    with pytest.raises(ValueError, match="other settings"):
        sinks.write_shards(work, out, {"model": "n"}, shard_size=2)
    assert sinks.canonical_json({"b": 1, "a": "é"}) == '{"a":"\\u00e9","b":1}'
    assert sinks.config_differences({"a": 1}, {"a": 1, "b": 2}) == {"b": (None, 2)}


def test_half_floats(spark):
    df = spark.createDataFrame([(1, [1.0, -2.5]), (2, None)], "k long, v array<double>")
    rows = {r.k: r.packed for r in sinks.half_floats(df, "k", "v").collect()}
    assert bytes(rows[1]) == b"\x00\x3c\x00\xc1" and rows[2] is None


def test_streamed_rules_match_the_batch(spark, tmp_path):
    from pathloom.operators import evaluate

    rows = [(e, i, i % 4 == 0, 5.0, float(i if e == "a" else i // 6), 0.0, e == "c" and i == 5) for e in "abc" for i in range(12)]
    schema = "episode_id string, frame_index long, human_following boolean, dis_to_human double, human_x double, human_z double, human_collision boolean"
    df = spark.createDataFrame(rows, schema)
    for n, part in enumerate((df.where("frame_index < 6"), df.where("frame_index >= 6"))):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    limits = {"far": 4.0, "lost_after": 2, "stuck_after": 3}
    batch = {r.episode_id: (r.end_step, r.cause) for r in evaluate.early_end(df, still=1e-4, **limits).collect()}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    q = episodes.follow_episodes(source, **limits).writeStream.foreachBatch(episodes.append_once(out)).option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    streamed = {r.episode_id: (r.frame_index, r.cause) for r in spark.read.parquet(out).where("cause IS NOT NULL").collect()}
    assert streamed == {k: v for k, v in batch.items() if v[1]}


def test_schemas_read_what_they_name():
    assert "`success_visible_detector` boolean" in schemas.EPISODE_RESULT and schemas.STEP_LOG.count("`") == 64


def test_json_and_flat_arrays(spark, tmp_path):
    import hashlib
    import io

    import numpy as np

    path = f"{tmp_path}/report.json"
    for value in ({"b": 1, "a": [1.5, "é"]}, {"b": 2}):
        assert sinks.write_json(spark, path, value) == hashlib.sha256(open(path, "rb").read()).hexdigest()
        assert json.load(open(path)) == value
    assert [x for x in os.listdir(tmp_path) if "stage" in x] == []
    df = spark.range(25).select("id", (F.col("id") * 3).alias("offset"), (F.col("id") / 2).alias("score")).repartition(4)
    pieces = sinks.flat_arrays(df, "id", ["offset", "score"], ["<i8", "<f4"], rows=10)
    for name, dtype, want in (("offset", "<i8", np.arange(25) * 3), ("score", "<f4", np.arange(25) / 2)):
        own = pieces.where(F.col("column") == name).orderBy("first").collect()
        assert [(r["first"], r["n"]) for r in own] == [(0, 10), (10, 10), (20, 5)]
        data = sinks.npy_header(dtype, 25) + b"".join(bytes(r["data"]) for r in own)
        assert (np.load(io.BytesIO(data)) == want).all()
    assert sinks.flat_arrays(df.limit(0), "id", ["offset"], ["<i8"]).count() == 0
    with pytest.raises(Exception, match="repeats or skips"):
        sinks.flat_arrays(df.where("id <> 3"), "id", ["offset"], ["<i8"]).collect()


def test_json_takes_the_place_of_an_older_one(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    for value in ({"x": 1}, {"x": 2}):
        digest = sinks.write_json(spark, path, value)
        assert json.load(open(path)) == value and sinks.file_digests(spark, f"{tmp_path}/a").where("path LIKE '%b.json'").first().sha256 == digest
    assert [x for x in os.listdir(f"{tmp_path}/a") if not x.startswith(".")] == ["b.json"]


@pytest.mark.parametrize("text", ["[]", " [ ] ", '{"frame_index": 1}'])
def test_logs_must_list_steps(spark, tmp_path, text):
    put(f"{tmp_path}/a_info.json", [{"frame_index": 0}])
    assert readers.step_logs(spark, f"{tmp_path}/*_info.json", checked=True).count() == 1
    put(f"{tmp_path}/b_info.json", text)
    with pytest.raises(ValueError, match="b_info.json"):
        readers.step_logs(spark, f"{tmp_path}/*_info.json", checked=True)


def test_lines_keep_their_order(spark, tmp_path):
    for part in range(2):
        put(f"{tmp_path}/{part}.jsonl", "".join(f"{part}-{i}\n" for i in range(200)))
    for _ in range(2):
        sinks.concat_lines(spark, [f"{tmp_path}/1.jsonl", f"{tmp_path}/0.jsonl"], f"{tmp_path}/out")
    parts = sorted(x for x in os.listdir(f"{tmp_path}/out") if x.startswith("part-"))
    assert "".join(open(f"{tmp_path}/out/{x}").read() for x in parts).split() == [f"{p}-{i}" for p in (1, 0) for i in range(200)]


def test_lines_of_files_of_any_size_keep_their_bytes(spark, tmp_path):
    """Small files come before large ones, which Spark packs first, and pieces of a file stay in order."""
    sizes = [1, 3000, 2, 500, 1]
    for part, n in enumerate(sizes):
        put(f"{tmp_path}/{part}.jsonl", "".join(f"{part}-{i}\t\r é{'x' * (i % 50)}\n" for i in range(n)))
    paths = [f"{tmp_path}/{i}.jsonl" for i in (0, 1, 4, 3, 2)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        for _ in range(2):
            sinks.concat_lines(spark, paths, f"{tmp_path}/out")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    parts = sorted(x for x in os.listdir(f"{tmp_path}/out") if x.startswith("part-"))
    assert b"".join(open(f"{tmp_path}/out/{x}", "rb").read() for x in parts) == b"".join(open(p, "rb").read() for p in paths)
    assert sorted(os.listdir(tmp_path)) == [*(f"{i}.jsonl" for i in range(5)), "out"]


def test_versions(spark, tmp_path):
    target, df = f"{tmp_path}/t", spark.range(10)
    with pytest.raises(FileNotFoundError):
        versions.current(spark, target)
    first = versions.publish(spark, target, df.where("id < 3").write.parquet)
    assert versions.read(spark, target).count() == 3

    def broken(stage):
        df.write.parquet(stage)
        raise OSError("broke off")

    for build, check in ((broken, None), (df.write.parquet, broken)):
        with pytest.raises(Exception):  # noqa: B017  the second fails as the stage is there
            versions.publish(spark, target, build, check)
        assert versions.current(spark, target) == first and sorted(os.listdir(target)) == ["pointers", "versions"]
    second = versions.publish(spark, target, df.write.parquet)
    assert os.path.isdir(first) and versions.current(spark, target) == second
    # a pointer that is being written is passed over, and its number is not taken again
    open(f"{target}/pointers/000000000003", "w").close()
    assert versions.current(spark, target) == second
    third = versions.publish(spark, target, df.where("id < 7").write.parquet)
    assert versions.current(spark, target) == third and [n for n, _ in versions.pointers(spark, target)] == [4, 2]
    assert not os.path.isdir(first) and os.path.isdir(second)
    assert versions.rollback(spark, target) == second and versions.read(spark, target).count() == 10
    with pytest.raises(FileNotFoundError):
        versions.rollback(spark, target, 9)


@pytest.mark.parametrize("at_offsets", [True, False])
def test_array_files_load(spark, tmp_path, at_offsets):
    import numpy as np

    df = spark.range(1000).select("id", (F.col("id") * 7 - 3000).alias("v"), (F.col("id") / 8).alias("w")).repartition(6)
    for n, (column, dtype) in enumerate((("v", "<i8"), ("v", "<i2"), ("w", "<f4"), ("w", "<f2"))):
        path = f"{tmp_path}/d/{n}.npy"
        for _ in range(2):  # the second takes the place of the first
            assert sinks.write_array(df, "id", column, dtype, path, rows=64, at_offsets=at_offsets) == 1000
        want = np.arange(1000) * 7 - 3000 if column == "v" else np.arange(1000) / 8
        loaded = np.load(path)
        assert loaded.dtype == np.dtype(dtype) and (loaded == want.astype(dtype)).all()
        assert [r.value for r in sinks.read_array(spark, path, rows=33).orderBy("place").collect()] == loaded.tolist()
    assert sinks.write_array(df.limit(0), "id", "v", "<i8", f"{tmp_path}/d/none.npy", at_offsets=at_offsets) == 0 and len(np.load(f"{tmp_path}/d/none.npy")) == 0
    for bad in (df.where("id <> 0"), df.where("id <> 500"), df.unionByName(df.where("id = 5"))):
        with pytest.raises(Exception, match="goes from|repeats or skips"):
            sinks.write_array(bad, "id", "v", "<i8", f"{tmp_path}/d/bad.npy", rows=64, at_offsets=at_offsets)
    assert sorted(x for x in os.listdir(f"{tmp_path}/d") if not x.startswith(".")) == ["0.npy", "1.npy", "2.npy", "3.npy", "none.npy"]


def test_array_files_are_no_small_side_of_a_join(spark, tmp_path):
    for name in "ab":
        sinks.write_array(spark.range(2_000_000).withColumn("v", F.col("id")), "id", "v", "<i8", f"{tmp_path}/{name}.npy")
    a, b = (sinks.read_array(spark, f"{tmp_path}/{x}.npy").withColumnRenamed("value", x) for x in "ab")
    joined = a.join(b, "place")
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("a = place and b = place").count() == 2_000_000


def test_resume_by_manifest(spark, tmp_path):
    path, work = f"{tmp_path}/s", spark.range(10).select(F.col("id").alias("ref_id"), F.array(F.col("id").cast("double")).alias("v"))
    write = lambda df=work, **o: sinks.write_shards(df, path, {"m": 1}, shard_size=4, **o)
    file = lambda shard: next(f"{path}/data/shard={shard}/{x}" for x in os.listdir(f"{path}/data/shard={shard}") if x.endswith(".parquet"))
    assert write() == 3 and write() == 0
    changed = work.withColumn("v", F.when(F.col("ref_id") == 5, F.array(F.lit(0.5))).otherwise(F.col("v")))
    assert write(changed) == 1 and write(changed) == 0 and write() == 1  # other values of the same number of rows
    data = open(file(0), "rb").read()
    open(file(0), "wb").write(data[: len(data) // 2])
    os.remove(file(2))
    assert write() == 2 and write() == 0
    # a file of the same size whose rows are others is found by its content
    other = spark.read.parquet(f"{path}/data/shard=1").withColumn("v", F.array(F.col("v")[0] + 1))
    rows = other.collect()
    spark.createDataFrame(rows, other.schema).coalesce(1).write.parquet(f"{tmp_path}/other")
    new = next(f"{tmp_path}/other/{x}" for x in os.listdir(f"{tmp_path}/other") if x.endswith(".parquet"))
    old, raw = file(1), open(new, "rb").read()
    os.remove(f"{os.path.dirname(old)}/.{os.path.basename(old)}.crc")
    if len(raw) == os.path.getsize(old):
        open(old, "wb").write(raw)
        assert write(content=False) == 0 and write() == 1
    assert sorted(r.ref_id for r in spark.read.parquet(f"{path}/data").collect()) == list(range(10))
    with pytest.raises(ValueError, match="without a number"):
        write(work.unionByName(work.limit(1).withColumn("ref_id", F.lit(None).cast("long"))))


def test_a_scan_ends_at_its_limit(spark, tmp_path):
    for i, good in ((1, True), (2, False), (3, True), (4, False), (10, True)):
        for kind in ("_info.json", ".json", *(f"_{c}.mp4" for c in readers.CAMERAS)) if good else ("_info.json",):
            put(f"{tmp_path}/scene/{i}{kind}", "[]")
    names = lambda **o: sorted(int(r.episode) for r in readers.discover(spark, str(tmp_path), **o).collect())
    assert names(skip_invalid=True) == [1, 2, 3, 4, 10] and names(limit=1) == [1] and names(skip_invalid=True, limit=1) == [1]
    assert names(skip_invalid=True, limit=2) == [1, 2, 3] and names(skip_invalid=True, limit=9) == [1, 2, 3, 4, 10] and names(limit=0) == []
    for strict in ({}, {"limit": 2}):
        with pytest.raises(FileNotFoundError):
            readers.discover(spark, str(tmp_path), **strict)


@pytest.mark.parametrize("cuts", [(0,), (0, 1, 5, 6, 9)])
def test_limits_do_not_depend_on_batches(spark, cuts):
    """Steps at seconds of a clock; an episode that goes silent is closed by its timer, once the other key's steps have moved the clock on."""
    minute = lambda n: f"2024-01-01 {n // 60:02d}:{n % 60:02d}:00"
    rows = sorted([(1, m) for m in (0, 1, 2, 60, 100, 101)] + [(2, m) for m in (0, 5, 9, 14, 400)], key=lambda r: r[1])
    slices = [spark.createDataFrame([(k, minute(m)) for k, m in rows[a:b]], "k long, at string").select("k", F.col("at").cast("timestamp").alias("at")) for a, b in zip(cuts, (*cuts[1:], len(rows)))]
    plan = lambda s: episodes.limited_episodes(s, "k", "at", "1 minute", 4, 12 * 60, 30 * 60)
    base = 1704067200000
    got = sorted((r.k, r.number, (r.start_ms - base) // 60000, (r.end_ms - base) // 60000, r.n_steps, r.cause) for r in episodes.streamed_in_runs(spark, slices, plan).collect())
    assert got == [(1, 0, 0, 12, 3, "seconds"), (1, 1, 60, 72, 1, "seconds"), (1, 2, 100, 112, 2, "seconds"), (2, 0, 0, 12, 3, "seconds"), (2, 1, 14, 26, 1, "seconds")]
    plan = lambda s: episodes.limited_episodes(s, "k", "at", "1 minute", 2, 60 * 60, 30 * 60)
    got = sorted((r.k, (r.start_ms - base) // 60000, (r.end_ms - base) // 60000, r.n_steps, r.cause) for r in episodes.streamed_in_runs(spark, slices, plan).collect())
    assert got == [(1, 0, 1, 2, "steps"), (1, 2, 32, 1, "silent"), (1, 60, 90, 1, "silent"), (1, 100, 101, 2, "steps"), (2, 0, 5, 2, "steps"), (2, 9, 14, 2, "steps")]


def test_listing_in_tasks(spark, tmp_path):
    for name in ("a", "s1/b.json", "s1/x/c=1/d", "s2/_hidden", "s2/.also", "_no/e", "s3/_k=1/f", "s é/g h"):
        os.makedirs(os.path.dirname(f"{tmp_path}/{name}"), exist_ok=True)
        open(f"{tmp_path}/{name}", "w").write("12")
    os.makedirs(f"{tmp_path}/empty/er")
    spark_lists = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path", "length")
    got = readers.listing(spark, str(tmp_path))
    names = lambda df: sorted((r.path.split(str(tmp_path))[1], r.length) for r in df.collect())
    assert names(got) == names(spark_lists) and len(names(got)) == 5
    assert got.where(F.col("path").isNotNull() & F.regexp_extract("path", "/(s1)/", 1).eqNullSafe("")).count() == 3
    # files are rows of tasks: no file index of them is in the plan, and a scan does not open a task for every few
    assert "binaryFile" not in got._jdf.queryExecution().executedPlan().toString()


def test_shards_are_rows_of_tasks(spark, tmp_path):
    """Rows come back whole, a file that is cut is skipped or an error, and no plan has an index of the folders."""
    path = f"{tmp_path}/s"
    rows = spark.range(50).selectExpr("id AS ref_id", "cast(id as decimal(9,2)) AS price", "array(struct(id AS a, timestamp_seconds(id) AS t)) AS l", "id div 7 AS shard")
    sinks.write_chunks(rows, f"{path}/data", ("shard",))
    got = sinks.shard_rows(spark, path, rows.schema)
    assert got.select(rows.columns).exceptAll(rows).isEmpty() and got.count() == 50
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in sinks.shard_files(spark, path)._jdf.queryExecution().executedPlan().toString() and sinks.shard_files(spark, path).count() == 8
    file = f"{path}/data/shard=0/{next(x for x in os.listdir(f'{path}/data/shard=0') if x.endswith('.parquet'))}"
    data = open(file, "rb").read()
    open(file, "wb").write(data[: len(data) // 2])
    assert sinks.shard_rows(spark, path, "ref_id long, none int", skip_corrupt=True).where("none is null").count() == 43
    with pytest.raises(Exception, match="[Pp]arquet"):
        sinks.shard_rows(spark, path, "ref_id long").count()


ODD = {
    "obj": b'{"status":"a","total_step":3}', "arr": b' [{"status":"a"},{"status":"b"}]', "empty": b"", "blank": b" \n", "none": b"[]", "null": b"null", "null_in": b'[null,{"status":"c"}]', "bad": b"{not json", "number": b"12",
    "misfit": b'{"status":"a","total_step":"x","fps":3}', "misfits": b'[{"status":"a","total_step":"x"},{"status":"b","total_step":2}]', "cut": b'[{"status":"a"},{"status":"b"', "behind": b'[{"status":"a"}] more', "mixed": b'[{"status":"a"},3]',
    "nested": b'[[{"status":"a"}]]', "mark": b'\xef\xbb\xbf{"status":"a"}', "wide": '{"status":"\xe9"}'.encode("utf-16"), "bytes": b'{"status":"\xff"}', "control": b'{"status":"a\nb"}', "s \xe9%25/g h": b'{"status":"q"}', "s1/_hidden": b"{}", "_s/d/x": b"{}",
}


def test_results_are_found_and_read_by_tasks(spark, tmp_path):
    """Odd files give what Spark's reader gives, under each kind of path, and no plan has an index of the files."""
    for name, data in ODD.items():
        os.makedirs(os.path.dirname(f"{tmp_path}/{name}"), exist_ok=True)
        open(f"{tmp_path}/{name}.json", "wb").write(data)
    with gzip.open(f"{tmp_path}/z.json.gz", "wb") as f:
        f.write(b'{"status":"zipped"}')
    schema = f"{schemas.EPISODE_RESULT}, _corrupt_record string"
    told = lambda df: sorted(map(repr, df.select("file", "status", "total_step", "fps", "_corrupt_record").collect()))
    for paths in ("/*.json", "/*.gz", "/*/*.json", "/s*/g?h.json", "/[^a-m]*.json", "", "/s \xe9%25", ["/obj.json", "/obj.json", "/m*.json"], "//_s/*/*.json", "/{obj,arr}.json"):
        paths = f"{tmp_path}{paths}" if isinstance(paths, str) else [f"{tmp_path}{x}" for x in paths]
        got = readers.statuses(spark, paths)
        of_spark = spark.read.schema(schema).option("multiLine", True).json(paths).withColumn("file", F.col("_metadata.file_path"))
        assert told(got) == told(of_spark) and set(got.columns) == set(of_spark.columns)
        assert ("FileScan" in got._jdf.queryExecution().executedPlan().toString()) == ("{" in str(paths))
    assert told(readers.statuses(spark, f"{tmp_path}/*.json", lambda f: f.endswith("/arr.json"))) == told(readers.statuses(spark, f"{tmp_path}/arr.json"))
    for missing in ("/*.not", "/not.json"):
        with pytest.raises(FileNotFoundError, match="not"):
            readers.statuses(spark, f"{tmp_path}{missing}")


def test_logs_are_found_and_read_by_tasks(spark, tmp_path):
    """Steps are those of Spark's reader, what is no step is an error, and no plan has an index of the files."""
    for i in range(30):
        put(f"{tmp_path}/s{i % 3}/{i}_info.json", [{"frame_index": j, "robot_pos": [i, 0.5, j], "human_following": 1.0, "more": [{}]} for j in range(i + 1)])
    put(f"{tmp_path}/s0/30_info.json", {"frame_index": 7})
    paths = f"{tmp_path}/*/*_info.json"
    got = readers.step_logs(spark, paths)
    of_spark = spark.read.schema(schemas.STEP_LOG).option("multiLine", True).json(paths).withColumn("file", F.col("_metadata.file_path"))
    assert got.columns == of_spark.columns and got.exceptAll(of_spark).isEmpty() and got.count() == of_spark.count() == 466
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in readers.step_logs(spark, f"{tmp_path}/s[12]/*_info.json", checked=True)._jdf.queryExecution().executedPlan().toString()
    for i, text in enumerate([b"[{", b"null", b"[null]", b"3", b'[{"human_pos":["\xff"]}]', b'[{"frame_index":"x"}]']):
        os.makedirs(f"{tmp_path}/bad")
        open(f"{tmp_path}/bad/{i}_info.json", "wb").write(text)
        with pytest.raises(Exception, match="no step|FAILFAST|[Mm]alformed"):
            readers.step_logs(spark, f"{tmp_path}/bad").count()
        os.rename(f"{tmp_path}/bad", f"{tmp_path}/seen{i}")


@pytest.mark.parametrize(("clock", "closed"), [(31 * 60_000, 1), (31 * 60_000 - 1, 0)])
def test_silence_ends_with_the_watermark_at_its_deadline(spark, clock, closed):
    """Key 1's deadline is at 30 minutes; key 2 moves the watermark, a minute behind, to it or to a millisecond before. States go with the rows, not by calls."""
    at = lambda k, ms: spark.createDataFrame([(k, ms)], "k long, ms long").select("k", F.timestamp_millis("ms").alias("at"))
    base = 1704067200000
    plans = []

    def plan(s):
        plans.append(episodes.limited_episodes(s, "k", "at", "1 minute", 9, 60 * 60, 30 * 60))
        return plans[-1]

    got = episodes.streamed_in_runs(spark, [at(1, base), at(2, base + clock)], plan).collect()
    assert [(r.k, r.number, r.end_ms - base, r.n_steps, r.cause) for r in got] == [(1, 0, 30 * 60_000, 1, "silent")] * closed
    assert "TransformWithState" not in plans[0]._jdf.queryExecution().analyzed().toString()
