"""Queries over sources and sinks: files are made from the stand-in rollouts in the shared folder, read back, and removed."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.operators import context, worklist
from pathloom.operators.prefix import checkpointed, running_before, shared_folder
from pathloom.plans.registry import query
from pathloom.plans.standins import FRAMES_SQL, frames
from pathloom.sources import readers, schemas, sinks, versions

R = 6
CAMERAS = ["front", "left", "right", "rear"]


def _through(spark: SparkSession, make: Callable[[str], None], read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` finds in a new folder that ``make`` has filled; the folder is removed again."""
    root = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    try:
        make(root)
        return checkpointed(read(root))
    finally:
        if sinks.exists(spark, root):
            sinks.remove(spark, root)


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per episode: its scene, its number, its steps and those that follow."""
    f = frames(spark, sf_dir)
    return f.groupBy("scene_id", F.col("source_episode_id").alias("k")).agg(F.count("*").alias("total_step"), F.sum(F.col("human_following").cast("long")).alias("following_step"))


SOURCES_SQL = FRAMES_SQL + ", src AS (SELECT scene_id, source_episode_id AS k, count(*) AS total_step, sum(human_following::INT)::BIGINT AS following_step FROM frames GROUP BY ALL)"


def _files(rows: DataFrame, **contents: F.Column) -> DataFrame:
    """(name, content) from arrays or single structs of both, absent where null."""
    every = F.filter(F.array(*(F.struct(F.lit(0).alias("_"), c["name"].alias("name"), c["content"].alias("content")) for c in contents.values())), lambda x: x["name"].isNotNull())
    return rows.select(F.explode(every).alias("f")).select("f.name", "f.content")


def _file(name: F.Column, content: F.Column, there: F.Column) -> F.Column:
    return F.struct(F.when(there, name).alias("name"), content.cast("string").alias("content"))


def _rollout_tree(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Step logs, results and videos under scenes; some have no log, no result, or lack a camera."""
    k = F.col("k")
    stem = F.concat_ws("/", "scene_id", k.cast("string"))
    parts = {"info": _file(F.concat(stem, F.lit("_info.json")), F.lit("[]"), k % 11 != 0), "json": _file(F.concat(stem, F.lit(".json")), F.lit("{}"), k % 5 != 0)}
    parts |= {c: _file(F.concat(stem, F.lit(f"_{c}.mp4")), F.lit("v"), k % 7 != i + 1) for i, c in enumerate(CAMERAS)}
    sinks.write_named(_files(_sources(spark, sf_dir), **parts), root, "name", "content")


FOUND_SQL = SOURCES_SQL + """, found AS (SELECT scene_id AS scene, k, list_filter([CASE WHEN k % 5 = 0 THEN 'json' END, CASE WHEN k % 7 = 1 THEN 'front.mp4' END, CASE WHEN k % 7 = 2 THEN 'left.mp4' END,
  CASE WHEN k % 7 = 3 THEN 'right.mp4' END, CASE WHEN k % 7 = 4 THEN 'rear.mp4' END], lambda x: x IS NOT NULL) AS missing FROM src WHERE k % 11 <> 0)"""


@query(FOUND_SQL + " SELECT scene, k::VARCHAR AS episode, array_to_string(missing, ',') AS missing, len(missing) = 0 AS accepted FROM found")
def rollout_discovery(spark, sf_dir):
    read = lambda root: readers.discover(spark, root, skip_invalid=True).select("scene", "episode", F.array_join("missing", ",").alias("missing"), "accepted")
    return _through(spark, lambda root: _rollout_tree(spark, sf_dir, root), read)


LIMIT_SQL = FOUND_SQL + ", numbered AS (SELECT *, row_number() OVER (ORDER BY scene, k) AS place, sum((len(missing) = 0)::INT) OVER (ORDER BY scene, k) AS taken FROM found)"


@query(LIMIT_SQL + " SELECT scene, k::VARCHAR AS episode, len(missing) = 0 AS accepted FROM numbered WHERE place <= (SELECT min(place) FROM numbered WHERE taken = 7)")
def rollout_limit(spark, sf_dir):
    """A scan that ends at the seventh accepted episode in natural order: what it has looked at until then."""
    read = lambda root: readers.discover(spark, root, skip_invalid=True, limit=7).select("scene", "episode", "accepted")
    return _through(spark, lambda root: _rollout_tree(spark, sf_dir, root), read)


@query(SOURCES_SQL + " SELECT concat('seed_', k % 3, '/', scene_id) AS run, k::VARCHAR AS stem, k % 2 = 0 AS has_video FROM src WHERE k % 4 > 0")
def legacy_discovery(spark, sf_dir):
    stem = F.concat(F.lit("seed_"), F.col("k") % 3, F.lit("/"), "scene_id", F.lit("/"), "k")
    parts = {"info": _file(F.concat(stem, F.lit("_info.json")), F.lit("[]"), F.col("k") % 4 > 0), "video": _file(F.concat(stem, F.lit(".mp4")), F.lit("v"), F.col("k") % 2 == 0)}
    read = lambda root: readers.legacy_discover(spark, root).select(F.regexp_extract("run", "(seed_.*)$", 1).alias("run"), "stem", "has_video")
    return _through(spark, lambda root: sinks.write_named(_files(_sources(spark, sf_dir), **parts), root, "name", "content"), read)


@query(FRAMES_SQL + f"SELECT source_episode_id AS k, frame_index, round(dis_to_human, {R}) AS dis_to_human, round(robot_x, {R}) AS x, round(vx, {R}) AS vx, human_following::INT::DOUBLE AS following FROM frames")
def step_log_scan(spark, sf_dir):
    """Step logs as arrays of records, one file an episode, that must not be empty."""
    f = frames(spark, sf_dir)
    step = F.struct("frame_index", F.col("timestamp_s").alias("timestamp"), F.array("robot_x", "robot_y", "robot_z").alias("robot_pos"), "robot_yaw", F.array("vx", "vy", "wz").alias("base_velocity"), "dis_to_human", F.col("human_following").cast("double").alias("human_following"))
    logs = f.groupBy("scene_id", "source_episode_id").agg(F.to_json(F.array_sort(F.collect_list(step))).alias("content")).withColumn("name", F.format_string("%s/%d_info.json", "scene_id", "source_episode_id"))
    read = lambda root: readers.step_logs(spark, f"{root}/*/*_info.json", checked=True).select(
        F.regexp_extract("file", "([0-9]+)_info.json$", 1).cast("long").alias("k"), "frame_index", F.round("dis_to_human", R).alias("dis_to_human"), F.round(F.col("robot_pos")[0], R).alias("x"), F.round(F.col("base_velocity")[0], R).alias("vx"), F.col("human_following").alias("following")
    )
    return _through(spark, lambda root: sinks.write_named(logs, root, "name", "content"), read)


def _results_tree(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Result files; some are broken, some have no success field or no id, and summaries and logs stand among them."""
    k = F.col("k")
    stem = F.concat_ws("/", "scene_id", k.cast("string"))
    success = F.when(k % 4 > 0, F.when(k % 3 == 0, "true").otherwise("false"))
    body = F.to_json(F.struct(F.when(k % 8 != 3, F.concat(F.lit("e"), k)).alias("episode_id"), F.lit("Normal").alias("status"), "total_step", "following_step", success.alias("success")))
    parts = {
        "result": _file(F.concat(stem, F.lit(".json")), F.when(k % 6 == 0, "{not json").otherwise(body), F.lit(True)), "log": _file(F.concat(stem, F.lit("_info.json")), F.lit("[]"), F.lit(True)),
        "summary": _file(F.concat(F.col("scene_id"), F.lit("/summary_"), k, F.lit(".json")), body, k % 9 == 0),
    }
    sinks.write_named(_files(_sources(spark, sf_dir), **parts), root, "name", "content")


@query(SOURCES_SQL + " SELECT k, k % 6 = 0 AS broken, CASE WHEN k % 6 > 0 THEN 'Normal' END AS status, CASE WHEN k % 6 > 0 THEN total_step END AS total_step FROM src")
def status_scan(spark, sf_dir):
    def read(root):
        rows = readers.statuses(spark, f"{root}/*/*.json", lambda file: file.rlike("/[0-9]+[.]json$"))
        return rows.select(F.regexp_extract("file", "([0-9]+)[.]json$", 1).cast("long").alias("k"), F.col("_corrupt_record").isNotNull().alias("broken"), "status", "total_step")

    return _through(spark, lambda root: _results_tree(spark, sf_dir, root), read)


@query(SOURCES_SQL + " SELECT scene_id AS scene_dir, CASE WHEN k % 8 <> 3 THEN concat('e', k) ELSE k::VARCHAR END AS episode_id, total_step, following_step, CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END AS success FROM src WHERE k % 6 > 0 AND k % 4 > 0")
def evaluation_scan(spark, sf_dir):
    read = lambda root: readers.evaluation_results(spark, root).select("scene_dir", "episode_id", "total_step", "following_step", "success")
    return _through(spark, lambda root: _results_tree(spark, sf_dir, root), read)


RECORDS_SQL = FRAMES_SQL + """, records AS (SELECT source_episode_id AS episode_index, CASE WHEN source_episode_id % 10 = 4 AND frame_index = 1 THEN 'other' ELSE episode_id END AS episode_id, frame_index, idx - (frame_index = 2 AND source_episode_id % 13 = 1)::INT AS index,
  (source_episode_id + (source_episode_id % 6 = 5 AND frame_index = 0)::INT) % 3 AS part FROM frames)"""


def _record_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Frame records in three files, with repeated indexes, parted episodes and mixed ids among them."""
    f, k, i = frames(spark, sf_dir, with_index=True), F.col("source_episode_id"), F.col("frame_index")
    records = f.select(
        k.alias("episode_index"), F.when((k % 10 == 4) & (i == 1), "other").otherwise(F.col("episode_id")).alias("episode_id"), "frame_index", (F.col("idx") - ((i == 2) & (k % 13 == 1)).cast("long")).alias("index"),
        ((k + ((k % 6 == 5) & (i == 0)).cast("long")) % 3).alias("part"),
    )
    records = checkpointed(records)  # one task writes a file, so it must not be the one that sorts and joins the frames
    for part in range(3):
        sinks.write_single(records.where(F.col("part") == part).drop("part"), f"{root}/{part}/chunk_{part}_frame_records.parquet")


@query(RECORDS_SQL + " SELECT episode_index, episode_id, frame_index, index, concat('chunk_', part, '_frame_records.parquet') AS file FROM records")
def frame_record_scan(spark, sf_dir):
    read = lambda root: readers.frame_records(spark, root).withColumn("file", F.substring_index("file", "/", -1))
    return _through(spark, lambda root: _record_files(spark, sf_dir, root), read)


@query(RECORDS_SQL + """ SELECT * FROM (SELECT 'episode_in_files' AS fault, count(*) AS n FROM (SELECT 1 FROM records GROUP BY episode_id HAVING count(DISTINCT part) > 1)
  UNION ALL SELECT 'ids_of_number', count(*) FROM (SELECT 1 FROM records GROUP BY episode_index HAVING count(DISTINCT episode_id) > 1)
  UNION ALL SELECT 'repeated_index', count(*) FROM (SELECT 1 FROM records GROUP BY index HAVING count(*) > 1)) WHERE n > 0""")
def frame_record_faults(spark, sf_dir):
    return _through(spark, lambda root: _record_files(spark, sf_dir, root), lambda root: readers.frame_record_faults(readers.frame_records(spark, root)))


@query(FRAMES_SQL + "SELECT idx AS data_index, 'front_image' AS video_key, frame_index AS video_frame_index, source_episode_id // 3 AS chunk_index, source_episode_id % 3 AS file_index FROM frames WHERE idx % 5 <> 2")
def front_video_scan(spark, sf_dir):
    """Available rows of the front camera in a video index of all cameras."""
    k = F.col("source_episode_id")
    index = worklist.with_cameras(frames(spark, sf_dir, with_index=True), CAMERAS).select(
        F.col("idx").alias("index"), "camera_name", ((F.col("idx") % 5 != 2) | (F.col("camera_name") == "rear")).alias("available"), F.concat("camera_name", F.lit("_image")).alias("video_key"), F.col("frame_index").alias("video_frame_index"), F.floor(k / 3).alias("chunk_index"), (k % 3).alias("file_index"),
    )
    return _through(spark, lambda root: index.write.parquet(f"{root}/videos"), lambda root: readers.front_videos(spark, f"{root}/videos"))


def _entries(spark: SparkSession, folder: str) -> F.Column:
    """The names in a folder, but for those of Spark's marks."""
    fs, p = sinks.file_system(spark, folder)
    return F.lit(",".join(sorted(f.getPath().getName() for f in fs.listStatus(p) if not f.getPath().getName().startswith(("_", ".")))))


@query(SOURCES_SQL + " SELECT k, scene_id, total_step, 'a,b,out' AS entries FROM src")
def merged_parquet(spark, sf_dir):
    """Two tables whose columns stand in another order, merged by name into one that replaces an old one, twice; nothing else is left."""

    def make(root):
        s = _sources(spark, sf_dir)
        s.where("k % 2 = 0").select("k", "scene_id", "total_step").write.parquet(f"{root}/a")
        s.where("k % 2 = 1").select("total_step", "k", "scene_id").write.parquet(f"{root}/b")
        spark.range(3).write.parquet(f"{root}/out")
        for _ in range(2):
            sinks.merge_parquet(spark, [f"{root}/a", f"{root}/b"], f"{root}/out")

    return _through(spark, make, lambda root: spark.read.parquet(f"{root}/out").select("k", "scene_id", "total_step", _entries(spark, root).alias("entries")))


@query(SOURCES_SQL + """ SELECT row_number() OVER (ORDER BY CASE WHEN k = (SELECT min(k) FROM src) THEN 0 WHEN k % 3 > 0 THEN 1 ELSE 2 END, k) - 1 AS place, concat('{"k":', k, ',"n":', total_step, '}') AS value, '0,1,2,out' AS entries FROM src""")
def concatenated_lines(spark, sf_dir):
    """Files of one, many and some lines, in this order, each line at its place in the result."""

    def make(root):
        s = _sources(spark, sf_dir).select(F.to_json(F.struct("k", F.col("total_step").alias("n"))).alias("value"), "k")
        least = s.agg(F.min("k")).first()[0]
        part = F.when(F.col("k") == least, 0).when(F.col("k") % 3 > 0, 1).otherwise(2)
        for i in range(3):
            sinks.write_single(s.where(part == i).orderBy("k").select("value"), f"{root}/{i}", "text")
        for _ in range(2):
            sinks.concat_lines(spark, [f"{root}/{i}" for i in range(3)], f"{root}/out")

    def read(root):
        lines = sinks.ordered_lines(spark, [f"{root}/out"])
        return running_before(lines, ["file", "start", "at"], F.lit(1), "place").select("place", "value", _entries(spark, root).alias("entries"))

    return _through(spark, make, read)


@query(FRAMES_SQL + "SELECT (source_episode_id // 20) // 3 AS chunk_index, (source_episode_id // 20) % 3 AS file_index, count(*) AS n_rows, 1::BIGINT AS n_files FROM frames WHERE source_episode_id % 40 <> 7 OR frame_index > 0 GROUP BY ALL")
def chunk_sink(spark, sf_dir):
    """Parquet by chunk and file, one file each; a second write replaces only the chunks that it has."""
    chunk, file = worklist.chunk_files(F.col("source_episode_id"), 20, 3)

    def make(root):
        f = frames(spark, sf_dir).select("source_episode_id", "frame_index", chunk.alias("chunk_index"), file.alias("file_index"))
        sinks.write_chunks(f, f"{root}/data")
        again = f.where("source_episode_id % 40 = 7").select("chunk_index", "file_index").distinct()
        sinks.write_chunks(f.join(again, ["chunk_index", "file_index"]).where("source_episode_id % 40 <> 7 OR frame_index > 0"), f"{root}/data")

    read = lambda root: spark.read.parquet(f"{root}/data").groupBy(F.col("chunk_index").cast("long").alias("chunk_index"), F.col("file_index").cast("long").alias("file_index")).agg(F.count("*").alias("n_rows"), F.count_distinct(F.col("_metadata.file_path")).alias("n_files"))
    return _through(spark, make, read)


@query(SOURCES_SQL + " SELECT k::VARCHAR AS episode_id, concat('/new/', scene_id, '.basis.glb') AS scene_id, total_step::DOUBLE AS x FROM src WHERE scene_id IN ('scene1', 'scene4')")
def episode_dataset_scan(spark, sf_dir):
    """Zipped datasets of episodes, filtered by scene and moved under another folder."""

    def make(root):
        s = _sources(spark, sf_dir)
        episode = F.struct(F.col("k").cast("string").alias("episode_id"), F.concat(F.lit("data/scene_datasets/"), "scene_id", F.lit(".basis.glb")).alias("scene_id"), F.array(F.col("total_step").cast("double")).alias("start_position"))
        files = s.groupBy("scene_id").agg(F.to_json(F.struct(F.collect_list(episode).alias("episodes"))).alias("content")).withColumn("name", F.concat("scene_id", F.lit(".json.gz")))
        sinks.write_named(files, root, "name", "content", compression="gzip")

    read = lambda root: readers.episode_dataset(spark, f"{root}/*.json.gz", scenes=["scene1.basis", "scene4.basis"], scenes_dir="/new").select("episode_id", "scene_id", F.col("start_position")[0].alias("x"))
    return _through(spark, make, read)


@query("""WITH s AS (SELECT s_nationkey AS n, count(*) AS n_goals, min(s_acctbal) AS least FROM supplier GROUP BY ALL),
e AS (SELECT c_nationkey AS n, c_mktsegment AS seg, c_custkey AS c, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS place FROM customer)
SELECT concat('/new/', n, '.glb') AS scene_id, place::VARCHAR AS episode_id, concat(n, '.glb_', seg) AS goals_key, seg AS object_category, round(c::DOUBLE, 6) AS x,
  CASE WHEN n % 2 = 0 THEN coalesce(n_goals, 0) ELSE 1 END::INT AS n_goals, round(CASE WHEN n % 2 = 0 THEN least ELSE min(c) OVER (PARTITION BY n, seg)::DOUBLE END, 6) AS goal_x FROM e LEFT JOIN s USING (n)""")
def goal_dataset_scan(spark, sf_dir):
    """Zipped datasets, one a scene: half of them with a pool of goals by category, half with goals in the episodes, of which the first's count."""
    c, s = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("customer", "supplier"))
    goal = lambda x: F.struct(F.array(x.cast("double")).alias("position"), F.lit(1.0).alias("radius"))
    pools = s.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.array_sort(F.collect_list(goal(F.col("s_acctbal")))).alias("pool"))
    scene, pooled = F.concat("c_nationkey", F.lit(".glb")), F.col("c_nationkey") % 2 == 0
    own = F.array(F.struct(F.col("c_mktsegment").alias("object_category"), F.array(F.col("c_custkey").cast("double")).alias("position")))
    episode = F.struct("c_custkey", F.concat(F.lit("data/scene_datasets/"), scene).alias("scene_id"), F.when(pooled, F.col("c_mktsegment")).alias("object_category"), F.array(F.col("c_custkey").cast("double")).alias("start_position"), F.when(~pooled, own).alias("goals"))
    each = c.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(episode)).alias("episodes"), F.collect_set("c_mktsegment").alias("segments")).join(pools, "c_nationkey", "left")
    none = F.array().cast(dict(pools.dtypes)["pool"])
    shared = F.when(pooled, F.map_from_entries(F.transform("segments", lambda x: F.struct(F.concat(scene, F.lit("_"), x), F.coalesce("pool", none)))))
    ids = F.map_from_entries(F.transform("segments", lambda x, i: F.struct(x, i)))
    files = each.select(F.concat("c_nationkey", F.lit(".json.gz")).alias("name"), F.to_json(F.struct(ids.alias("category_to_task_category_id"), ids.alias("category_to_mp3d_category_id"), shared.alias("goals_by_category"), "episodes")).alias("content"))
    first = F.when(F.size("goals") > 0, F.get("goals", 0)["position"][0])
    read = lambda root: readers.goal_dataset(spark, f"{root}/*.json.gz", "/new").select("scene_id", "episode_id", "goals_key", "object_category", F.round(F.col("start_position")[0], R).alias("x"), F.size("goals").alias("n_goals"), F.round(first, R).alias("goal_x"))
    return _through(spark, lambda root: sinks.write_named(files, root, "name", "content", compression="gzip"), read)


@query("SELECT concat(lang, '/', source) AS word, row_number() OVER (ORDER BY lang, source) - 1 AS id FROM (SELECT DISTINCT lang, source FROM documents)")
def vocabulary_scan(spark, sf_dir):
    """The word list of a dataset, here of the documents' languages and sources, with its ids."""
    kinds = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source").distinct()
    words = kinds.agg(F.transform(F.array_sort(F.collect_list(F.struct("lang", "source"))), lambda w: F.concat(w["lang"], F.lit("/"), w["source"])).alias("word_list")).select(F.struct("word_list").alias("instruction_vocab"))
    read = lambda root: readers.vocabulary_of(spark, f"{root}/d.json.gz").select(F.col("id").cast("long").alias("id"), "word")
    return _through(spark, lambda root: sinks.write_single(words, f"{root}/d.json.gz", "json", compression="gzip"), read)


@query("SELECT n_name AS name, n_regionkey::DOUBLE AS beta, n_nationkey AS semantic_id FROM nation")
def humanoid_scan(spark, sf_dir):
    people = spark.read.parquet(f"{sf_dir}/nation.parquet").agg(F.to_json(F.collect_list(F.struct(F.col("n_name").alias("name"), F.array(F.col("n_regionkey").cast("double")).alias("betas"), F.lit("neutral").alias("gender"), F.col("n_nationkey").cast("long").alias("semantic_id")))).alias("content"))
    make = lambda root: sinks.write_named(people.select(F.lit("humanoids.json").alias("name"), "content"), root, "name", "content")
    return _through(spark, make, lambda root: readers.humanoids(spark, f"{root}/humanoids.json").select("name", F.col("betas")[0].alias("beta"), "semantic_id"))


@query(SOURCES_SQL + ", fails AS (SELECT k FROM src WHERE k % 6 = 1) SELECT k FROM fails WHERE k % 2 = (SELECT max(k) % 2 FROM fails)")
def retry_list(spark, sf_dir):
    """The split ids of the last list in a log, which has earlier ones and other lines."""

    def make(root):
        fails = _sources(spark, sf_dir).where("k % 6 = 1")
        newest = fails.agg(F.max("k")).first()[0]
        for place, part in enumerate((1 - newest % 2, newest % 2)):
            line = fails.where(F.col("k") % 2 == part).agg(F.concat(F.lit("# failed split-id list: "), F.array_join(F.transform(F.array_sort(F.collect_list("k")), lambda x: x.cast("string")), ", ")).alias("value"))
            sinks.write_single(line.unionByName(spark.createDataFrame([("# done",)], "value string")), f"{root}/{place}.log", "text")

    def read(root):
        lines = None
        for place in range(2):  # the log's parts in the order they were written
            part = spark.read.text(f"{root}/{place}.log").select((F.monotonically_increasing_id() + place * (1 << 40)).alias("number"), "value")
            lines = part if lines is None else lines.unionByName(part)
        return readers.failed_split_rows(lines)

    return _through(spark, make, read)


@query(FRAMES_SQL + "SELECT idx // 700 AS shard, count(*) AS n_rows, max(idx) AS last, CASE WHEN count(*) FILTER (idx < 2000) = count(*) THEN 1 ELSE 2 END AS run FROM frames GROUP BY ALL")
def shard_resume(spark, sf_dir):
    """Shards written for the first 2,000 references, and then for all: what was complete is not written again."""
    f = frames(spark, sf_dir, with_index=True).select(F.col("idx").alias("ref_id"))
    first = checkpointed(f.where("ref_id < 2000"))

    def make(root):
        sinks.write_shards(first, f"{root}/s", {"size": 700}, shard_size=700)
        sinks.write_shards(f, f"{root}/s", {"size": 700}, shard_size=700)

    def read(root):
        rows = sinks.shard_rows(spark, f"{root}/s", "ref_id long").groupBy("shard").agg(F.count("*").alias("n_rows"), F.max("ref_id").alias("last"))
        return rows.join(sinks.shard_records(spark, f"{root}/s").select("shard", "run"), "shard")

    return _through(spark, make, read)


@query(FRAMES_SQL + """, s AS (SELECT idx // 700 AS shard, count(*) AS n_rows, sum(idx + CASE WHEN idx // 700 = 4 AND idx % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS total FROM frames GROUP BY ALL)
SELECT shard, n_rows, total, CASE WHEN shard IN (0, 1, 2, 3, 4) THEN 2 ELSE 1 END AS run, CASE shard WHEN 0 THEN 'damaged' WHEN 1 THEN 'damaged' WHEN 2 THEN 'damaged' WHEN 3 THEN 'unrecorded' WHEN 4 THEN 'outdated' ELSE 'complete' END AS state FROM s""")
def manifest_resume(spark, sf_dir):
    """Shards that were cut short, removed, altered, left without a record, or are of older rows are written again, no others."""
    f = frames(spark, sf_dir, with_index=True).select(F.col("idx").alias("ref_id"), F.col("idx").alias("value"))
    work = checkpointed(f)
    newer = work.withColumn("value", F.col("value") + F.when((F.floor(F.col("ref_id") / 700) == 4) & (F.col("ref_id") % 2 == 0), 1).otherwise(0))
    states = []

    def make(root):
        path = f"{root}/s"
        sinks.write_shards(work, path, {"size": 700}, shard_size=700)
        fs, _ = sinks.file_system(spark, path)
        for shard in (0, 1):  # one is cut to half its bytes, one removed
            file = sinks.files_in_order(spark, [f"{path}/data/shard={shard}"])[0]
            data = sinks.read_small(spark, file)
            sinks.remove(spark, file)
            if not shard:
                sinks.write_bytes(spark, file, data[: len(data) // 2])
        other = spark.read.parquet(f"{path}/data/shard=2").withColumns({"value": F.col("value") + 1, "shard": F.lit(2)})
        sinks.write_chunks(checkpointed(other), f"{path}/data", ("shard",))
        sinks.forget_records(spark, path, F.col("shard") == 3)
        states.append(checkpointed(sinks.manifest_states(newer.withColumn("shard", F.floor(F.col("ref_id") / 700)), path).select("shard", "state")))
        sinks.write_shards(newer, path, {"size": 700}, shard_size=700)
        if sinks.write_shards(newer, path, {"size": 700}, shard_size=700):
            raise AssertionError("a complete shard was written again")

    def read(root):
        rows = sinks.shard_rows(spark, f"{root}/s", "ref_id long, value long").groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"))
        runs = sinks.shard_records(spark, f"{root}/s").select("shard", F.when(F.col("shard") == 3, 2).otherwise(F.col("run")).alias("run"))
        return rows.join(runs, "shard").join(states[0], "shard").select("shard", "n_rows", "total", "run", "state")

    return _through(spark, make, read)


MAIN = ["data", "episodes", "checkpoint", *CAMERAS]
ARTIFACTS = ["video_index", "frame_records", "frame_metadata", "tasks"]


@query(SOURCES_SQL + """, each AS (SELECT k AS shard, total_step AS n FROM src)
SELECT shard, CASE WHEN shard % 10 = 0 THEN 'missing' WHEN shard % 10 IN (1, 2, 3, 4, 5, 6) THEN 'incomplete' ELSE 'complete' END AS state FROM each""")
def shard_completeness(spark, sf_dir):
    """Shards that lack all, an artifact, its bytes, or have another count in the record, the rows or a video."""
    s = _sources(spark, sf_dir).select(F.col("k").alias("shard"), F.col("total_step").alias("n_rows"))
    case = F.col("shard") % 10
    files = s.select("shard", F.explode(F.array(*map(F.lit, [*MAIN, *ARTIFACTS]))).alias("kind")).where(~((case == 0) & F.col("kind").isin(MAIN)) & ~((case == 1) & (F.col("kind") == "tasks")) & ~((case == 2) & (F.col("kind") == "rear")))
    content = F.when((case == 3) & (F.col("kind") == "data"), "").otherwise("something")
    files = files.select(F.format_string("%d/%s", "shard", "kind").alias("name"), content.alias("content"))
    checkpoints = s.select("shard", (case != 4).alias("complete"), (F.col("n_rows") + (case == 5).cast("int")).alias("n_rows"))
    found = s.where(case != 0).select("shard", F.col("n_rows"))
    videos = s.select("shard", (F.col("n_rows") - (case == 6).cast("int")).alias("n_frames"))

    def read(root):
        listed = readers.listing(spark, root).select(F.regexp_extract("path", "([0-9]+)/[^/]+$", 1).cast("long").alias("shard"), F.substring_index("path", "/", -1).alias("kind"), F.col("length").alias("bytes"))
        return sinks.shard_completeness(s, listed, MAIN, ARTIFACTS, checkpoints, found, videos)

    return _through(spark, lambda root: sinks.write_named(files, root, "name", "content"), read)


@query(SOURCES_SQL + """, one AS (SELECT '{"episodes":' || count(*) || ',"frames":' || sum(total_step)::BIGINT || ',"name":"caf\\u00e9"}' AS body FROM src) SELECT body, sha256(body) AS sha256, sha256(body) AS read_sha256 FROM one""")
def json_publish(spark, sf_dir):
    """A canonical JSON file that takes an older one's place; its digest as written and as read."""
    n, total = _sources(spark, sf_dir).agg(F.count("*"), F.sum("total_step")).first()
    told = []

    def make(root):
        sinks.write_json(spark, f"{root}/d/stats.json", {"old": True})
        told.append(sinks.write_json(spark, f"{root}/d/stats.json", {"name": "café", "frames": total, "episodes": n}))

    read = lambda root: spark.read.text(f"{root}/d/stats.json", wholetext=True).crossJoin(sinks.file_digests(spark, f"{root}/d").where("path LIKE '%.json'")).select(F.col("value").alias("body"), F.lit(told[0]).alias("sha256"), F.col("sha256").alias("read_sha256"))  # noqa: E731  one row each
    return _through(spark, make, read)


@query(SOURCES_SQL + " SELECT 'new' AS version, k FROM src UNION ALL SELECT 'backup', k FROM src WHERE k % 2 = 0")
def staged_publish(spark, sf_dir):
    """A table that takes the place of another, which is kept as a backup; one that fails its check leaves both."""
    s, backups = _sources(spark, sf_dir).select("k"), []

    def make(root):
        sinks.publish(spark, f"{root}/index", lambda stage: s.where("k % 2 = 0").write.parquet(stage))
        backups.append(sinks.publish(spark, f"{root}/index", s.write.parquet, replace=True))

        def refuse(stage):
            raise ValueError("unsound")

        try:
            sinks.publish(spark, f"{root}/index", lambda stage: s.limit(1).write.parquet(stage), validate=refuse, replace=True)
        except ValueError:
            return
        raise AssertionError("the check was passed over")

    read = lambda root: spark.read.parquet(f"{root}/index").select(F.lit("new").alias("version"), "k").unionByName(spark.read.parquet(backups[0]).select(F.lit("backup").alias("version"), "k"))
    return _through(spark, make, read)


@query(SOURCES_SQL + """, m(moment, odd) AS (VALUES ('first', false), ('during', false), ('after', true), ('failed', true), ('resolved', false), ('rolled_back', false), ('pruned', true))
SELECT moment, count(*) AS n, sum(k)::BIGINT AS total, 2 AS kept FROM m, src WHERE k % 2 = 0 OR odd GROUP BY ALL""")
def versioned_publish(spark, sf_dir):
    """What readers find while versions are built, after a failed one, through a path resolved before, after going back, and once older ones are gone."""
    s, seen = checkpointed(_sources(spark, sf_dir).select("k")), []

    def look(moment: str, df: DataFrame) -> None:
        seen.append(checkpointed(df.agg(F.lit(moment).alias("moment"), F.count("*").alias("n"), F.sum("k").alias("total"))))

    def make(root):
        target = f"{root}/index"
        versions.publish(spark, target, s.where("k % 2 = 0").write.parquet)
        look("first", versions.read(spark, target))
        resolved = versions.current(spark, target)

        def build(stage):
            s.write.parquet(stage)
            look("during", versions.read(spark, target))

        versions.publish(spark, target, build)
        look("after", versions.read(spark, target))

        def refuse(stage):
            raise ValueError("unsound")

        try:
            versions.publish(spark, target, s.limit(1).write.parquet, validate=refuse)
        except ValueError:
            look("failed", versions.read(spark, target))
        look("resolved", spark.read.parquet(resolved))
        versions.rollback(spark, target)
        look("rolled_back", versions.read(spark, target))
        for _ in range(2):
            versions.publish(spark, target, s.write.parquet)
        look("pruned", versions.read(spark, target))

    def read(root):
        fs, p = sinks.file_system(spark, f"{root}/index/versions")
        return reduce(DataFrame.unionByName, seen).withColumn("kept", F.lit(len(fs.listStatus(p))))

    return _through(spark, make, read)


@query(FRAMES_SQL + """ SELECT idx AS place, coalesce(sum(least(frame_index, 240)) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset", least(frame_index, 240)::BIGINT AS n_blocks, round(timestamp_s, 6) AS timestamp_s FROM frames""")
def array_files(spark, sf_dir):
    """Three array files of a history index, in whole and fractional numbers, one of them put together without writing at offsets."""
    f = frames(spark, sf_dir, with_index=True)
    index = checkpointed(context.offsets(context.counts(f.select("source_episode_id", "episode_id", "frame_index", "idx", "timestamp_s"), 1024), ["source_episode_id"]))

    def make(root):
        for column, dtype, way in (("offset", "<i8", None), ("n_blocks", "<i4", False), ("timestamp_s", "<f8", True)):
            sinks.write_array(index, "idx", column, dtype, f"{root}/{column}.npy", rows=512, at_offsets=way)

    def read(root):
        a, b, c = (sinks.read_array(spark, f"{root}/{x}.npy", rows=700).withColumnRenamed("value", x) for x in ("offset", "n_blocks", "timestamp_s"))
        return a.join(b, "place").join(c, "place").select("place", "offset", "n_blocks", F.round("timestamp_s", R).alias("timestamp_s"))

    return _through(spark, make, read)


@query(FRAMES_SQL + """, o AS (SELECT idx, least(frame_index, 240) AS n_blocks, coalesce(sum(least(frame_index, 240)) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM frames),
v AS (SELECT 'offset' AS name, idx, pos AS x, 8 AS size FROM o UNION ALL SELECT 'n_blocks', idx, n_blocks, 4 FROM o)
SELECT name AS "column", (idx // 512) * 512 AS first, count(*) AS n, count(*) * max(size) AS n_bytes, arg_min(x, idx) AS first_value, arg_max(x, idx) AS last_value FROM v GROUP BY ALL""")
def array_pieces(spark, sf_dir):
    """Offsets and lengths of a flat history layout as pieces of array files, with the first and last value that their bytes hold."""
    f = frames(spark, sf_dir, with_index=True).select("source_episode_id", "episode_id", "frame_index", "idx")
    index = context.offsets(context.counts(f, 1024), ["source_episode_id"])
    pieces = sinks.flat_arrays(index, "idx", ["offset", "n_blocks"], ["<i8", "<i4"], rows=512)
    size = F.when(F.col("column") == "offset", 8).otherwise(4)
    byte = lambda at, i: F.conv(F.hex(F.substring("data", at + i, F.lit(1))), 16, 10).cast("long")
    number = lambda at: sum((F.when(F.lit(i) < size, byte(at, i) * (1 << 8 * i)).otherwise(F.lit(0)) for i in range(6)), F.lit(0).cast("long"))  # noqa: E731  below 2**48
    return pieces.select("column", "first", "n", F.octet_length("data").cast("long").alias("n_bytes"), number(F.lit(1)).alias("first_value"), number((F.col("n").cast("int") - 1) * size + 1).alias("last_value"))


@query(SOURCES_SQL + " SELECT k AS split_id, scene_id AS scene_key, CASE WHEN k % 2 = 0 THEN 'Lost' ELSE 'Collision' END AS status, total_step, 2::INT AS n_reasons, CASE WHEN k % 2 = 0 THEN 'lost_main_human' ELSE 'human_collision' END AS first_reason FROM src WHERE k % 3 > 0")
def failure_log(spark, sf_dir):
    """A log of failure events that two runs append to, read under its schema."""

    def make(root):
        s = _sources(spark, sf_dir).where("k % 3 > 0")
        cause = F.when(F.col("k") % 2 == 0, "Lost").otherwise("Collision")
        reasons = F.array(F.when(F.col("k") % 2 == 0, "lost_main_human").otherwise("human_collision"), F.lit("episode_incomplete"))
        events = s.select(F.col("k").alias("split_id"), F.col("scene_id").alias("scene_key"), F.col("k").cast("string").alias("episode_id"), cause.alias("status"), "total_step", reasons.alias("failure_reasons"))
        for part in range(2):
            events.where(F.col("split_id") % 2 == part).write.mode("append").json(f"{root}/failures")

    read = lambda root: readers.json_lines(spark, f"{root}/failures", schemas.FAILURE_EVENT).select("split_id", "scene_key", "status", "total_step", F.size("failure_reasons").alias("n_reasons"), F.col("failure_reasons")[0].alias("first_reason"))
    return _through(spark, make, read)


@query(SOURCES_SQL + """, m AS (SELECT k, CASE WHEN k % 9 = 0 THEN 'missing_camera' WHEN k % 9 = 1 THEN 'frame_count' WHEN k % 9 = 2 THEN 'no_size' WHEN k % 9 = 3 THEN 'frame_rate' END AS own, k % 9 = 4 AS wide FROM src),
first AS (SELECT arg_min(wide, k) AS wide FROM m WHERE own IS NULL)
SELECT k, coalesce(own, CASE WHEN m.wide <> first.wide THEN 'other_size' END) AS reason FROM m, first""")
def media_validation(spark, sf_dir):
    """Why an episode's videos do not fit it: planted faults of each kind."""
    s = _sources(spark, sf_dir).withColumn("case", F.col("k") % 9)
    each = s.select("k", "total_step", "case", F.explode(F.array(*map(F.lit, CAMERAS))).alias("camera")).where(~((F.col("case") == 0) & (F.col("camera") == "left")))
    rear = F.col("camera") == "rear"
    media = each.select(
        F.col("k").cast("string").alias("episode_id"), "camera", (F.col("total_step") + ((F.col("case") == 1) & rear).cast("int")).alias("frames"), F.when((F.col("case") == 2) & rear, 0).when(F.col("case") == 4, 64).otherwise(32).alias("width"), F.lit(32).alias("height"),
        F.when((F.col("case") == 3) & rear, 12.0).otherwise(10.0).alias("fps"),
    )
    eps = s.select(F.col("k").cast("string").alias("episode_id"), F.col("k").alias("order"), F.col("total_step").alias("n_steps"))
    return readers.media_faults(eps, media, 10.0).select(F.col("order").alias("k"), "reason")
