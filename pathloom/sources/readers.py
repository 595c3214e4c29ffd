"""Readers of rollout folders and datasets. Every path goes through Spark, so any store that Spark reads will do."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from fnmatch import fnmatchcase
from functools import partial
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.functions.text import natural_key
from pathloom.operators.datasets import keep_first, scene_allowed
from pathloom.operators.prefix import checkpointed
from pathloom.sources import schemas

CAMERAS = ["front", "left", "right", "rear"]
REQUIRED = ["json", *(f"{c}.mp4" for c in CAMERAS)]


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all files below ``root``, but for hidden ones; their content is not read.

    Tasks list the folders below ``root``, so neither the driver nor a plan holds the files; stores that only Spark
    knows are listed by Spark.
    """
    from pyarrow import ArrowInvalid, fs

    jvm = spark.sparkContext._jvm
    whole = jvm.org.apache.hadoop.fs.Path(root)
    store = whole.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = store.makeQualified(whole).toString()
    try:
        fs.FileSystem.from_uri(uri)
    except (ArrowInvalid, OSError):
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    if not store.exists(whole):
        raise FileNotFoundError(root)
    # one level by one task, the folders found there by all; a folder's row has no path, so that nothing is made of it before it is left out
    top = checkpointed(spark.range(0, 1, 1, 1).select(F.lit("").alias("folder")).mapInArrow(partial(_listed, root=uri, deep=False), LISTED))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    below = top.where("folder is not null").select("folder").repartition(parts, "folder").mapInArrow(partial(_listed, root=uri, deep=True), LISTED)
    found = top.where("folder is null").unionByName(below)
    return found.select(F.concat(F.lit(uri.rstrip("/") + "/"), "path").alias("path"), "length")


LISTED = "path string, length long, folder string"


def _listed(batches: Iterator[pa.RecordBatch], root: str, deep: bool) -> Iterator[pa.RecordBatch]:
    """Files in the folders named, relative to ``root``, and the folders in them: rows of their own, or looked through if ``deep``. Spark's rule of hidden names."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(root)
    base = base.rstrip("/")
    batch = lambda rows: pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("length", pa.int64()), ("folder", pa.string())]))
    rows = []
    for b in batches:
        todo = b.column(0).to_pylist()
        while todo:
            folder = todo.pop()
            for f in store.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/"))):
                path = f"{folder}/{f.base_name}" if folder else f.base_name
                if _hidden(f.base_name):
                    continue
                if f.type != fs.FileType.Directory:
                    rows.append({"path": path, "length": f.size})
                elif deep:
                    todo.append(path)
                else:
                    rows.append({"folder": path})
            if len(rows) >= 10_000:
                yield batch(rows)
                rows = []
    yield batch(rows)


def _hidden(name: str) -> bool:
    """Spark's rule of hidden names."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


MATCHED = "root string, path string, rest array<string>, file string"


def matching(spark: SparkSession, paths: str | list[str]) -> DataFrame | None:
    """(root, path, file) of the files that ``paths`` name; ``file`` as in Spark's metadata. A folder stands for the files right in it.

    ``*``, ``?`` and ``[…]`` are matched by tasks, a level at a time, so that neither the driver nor a plan holds the files.
    None for stores that only Spark knows, and for braces and escapes, which are left to it.
    """
    from pyarrow import ArrowInvalid, fs

    todo = []
    for path in [paths] if isinstance(paths, str) else paths:
        if re.search(r"[{\\]", path):
            return None
        steps = path.split("/")
        first = next((i for i, x in enumerate(steps) if re.search(r"[*?[]", x)), len(steps))
        base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(steps[:first]) + ("/" if 0 < first < len(steps) else "") or ".")
        store = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        root = store.makeQualified(base).toUri().toASCIIString()
        try:
            fs.FileSystem.from_uri(root)
        except (ArrowInvalid, OSError):
            return None
        if not store.exists(base):
            raise FileNotFoundError(path)
        todo.append((root, "", [x.replace("[^", "[!") for x in steps[first:] if x], None))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.createDataFrame(todo, MATCHED)
    for _ in range(max([1, *(len(rest) for _, _, rest, _ in todo)])):
        rows = rows.repartition(parts, "root", "path").mapInArrow(_matched, MATCHED)
    found = checkpointed(rows.select("root", "path", "file"))
    if any(rest for _, _, rest, _ in todo) and found.isEmpty():
        raise FileNotFoundError(f"no file at {paths}")
    return found


def _shown(root: str, path: str) -> str:
    """A file's address as Spark's metadata have it: quoted, but for letters of any script."""
    whole = re.sub("^([^/]*:)//(?=/)", r"\1", f"{unquote(root).rstrip('/')}/{path}" if path else unquote(root))
    return re.sub(r"[\s\x00-\x20\x7f-\x9f\"#%<>?\[\\\]^`{|}]", lambda x: quote(x[0], safe=""), whole)


def _stores() -> Callable[[str, str], tuple]:
    """The store of a root, which is opened once, and the whole path in it."""
    from pyarrow import fs

    known = {}

    def at(root: str, path: str) -> tuple:
        if root not in known:
            known[root] = fs.FileSystem.from_uri(root)
        store, base = known[root]
        return store, f"{base.rstrip('/')}/{path}" if path else base

    return at


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One level further: what matches the first of ``rest``, with the others; files that are found have none, but null."""
    from pyarrow import fs

    at, folder = _stores(), fs.FileType.Directory
    batch = lambda rows: pa.RecordBatch.from_pylist(rows, pa.schema([("root", pa.string()), ("path", pa.string()), ("rest", pa.list_(pa.string())), ("file", pa.string())]))
    below = lambda path, name: f"{path}/{name}" if path else name

    def entries(root, path):
        store, whole = at(root, path)
        return store.get_file_info(fs.FileSelector(whole))

    def inside(root, path):
        return ((below(path, f.base_name), None) for f in entries(root, path) if f.type != folder)

    def step(root, path, rest):
        if rest is None:
            yield path, None
        elif not rest:
            store, whole = at(root, path)
            yield from inside(root, path) if store.get_file_info(whole).type == folder else [(path, None)]
        else:
            for f in entries(root, path):
                if not fnmatchcase(f.base_name, rest[0]):
                    continue
                name = below(path, f.base_name)
                if f.type != folder:
                    yield from [(name, None)] if len(rest) == 1 else []
                elif len(rest) == 1:
                    yield from inside(root, name)
                else:
                    yield name, rest[1:]

    for b in batches:
        rows = []
        for root, path, rest in zip(*(c.to_pylist() for c in b.columns[:3]), strict=True):
            for name, left in step(root, path, rest):
                if left is not None or not _hidden((name or root).rsplit("/", 1)[-1]):
                    rows.append({"root": root, "path": name, "rest": left, "file": _shown(root, name)})
                if len(rows) >= 10_000:
                    yield batch(rows)
                    rows = []
        yield batch(rows)


def _contents(files: DataFrame) -> DataFrame:
    """(file, content, sound) of the files in ``matching``, which tasks open: unzipped text in the Unicode form that JSON's first bytes tell; not sound where it is none."""

    def run(batches):
        at, kinds = _stores(), pa.schema([("file", pa.string()), ("content", pa.string()), ("sound", pa.bool_())])
        for b in batches:
            rows, size = [], 0
            for root, path, file in zip(*(c.to_pylist() for c in b.columns), strict=True):
                store, whole = at(root, path)
                with store.open_input_stream(whole) as f:
                    data = f.read()
                form, sound = json.detect_encoding(data), True
                try:
                    text = data.decode(form)
                except UnicodeDecodeError:
                    text, sound = data.decode(form, "replace"), False
                rows.append({"file": file, "content": text, "sound": sound})
                size += len(data)
                if size >= 1 << 23:
                    yield pa.RecordBatch.from_pylist(rows, kinds)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, kinds)

    # few bytes name many files, so they are dealt over all tasks
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("root", "path", "file").repartition(parts, "root", "path").mapInArrow(run, "file string, content string, sound boolean")


def discover(spark: SparkSession, root: str, skip_invalid: bool = False, limit: int | None = None) -> DataFrame:
    """Episodes under ``root/scene/``: one row per step log, natural order, with what is missing beside it.

    Incomplete ones raise FileNotFoundError, or are rows with ``accepted`` false if ``skip_invalid``.
    ``limit`` counts accepted ones, and ends the scan at the last of them: later ones are neither returned nor refused.
    """
    f = listing(spark, root).select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("scene"), F.substring_index("path", "/", -1).alias("name"))
    stem = F.regexp_replace("name", r"(_info\.json|_(front|left|right|rear)\.mp4|\.json)$", "")
    kind = F.when(F.col("name").endswith("_info.json"), "info").when(F.col("name").endswith(".mp4"), F.regexp_extract("name", r"_([a-z]+\.mp4)$", 1)).when(F.col("name").endswith(".json"), "json")
    found = f.select("scene", stem.alias("episode"), kind.alias("kind")).groupBy("scene", "episode").agg(F.collect_set("kind").alias("have"))
    found = found.where(F.array_contains("have", "info"))
    found = found.select("scene", "episode", F.array_except(F.array(*map(F.lit, REQUIRED)), "have").alias("missing")).withColumn("accepted", F.size("missing") == 0)
    if limit is not None:
        # the scan ends with the last episode that is taken: what comes behind it is not looked at
        key = F.struct(F.col("scene"), *(k.alias(f"k{i}") for i, k in enumerate(natural_key(F.col("episode")))))
        found = found.withColumn("__key", key)
        taken = found.where("accepted").orderBy("__key").limit(limit).agg(F.count("*").alias("__n"), F.max("__key").alias("__last"))
        found = found.crossJoin(F.broadcast(taken)).where((F.col("__n") < limit) | (F.col("__key") <= F.col("__last"))) if limit > 0 else found.limit(0)  # one row
        found = found.drop("__key", "__n", "__last")
    if not skip_invalid and (bad := found.where("NOT accepted").first()):
        raise FileNotFoundError(f"{bad.scene}/{bad.episode} lacks {', '.join(bad.missing)}")
    return found


def legacy_discover(spark: SparkSession, root: str) -> DataFrame:
    """Step logs two levels below ``seed_*`` folders, with the plain video of the same stem if there is one."""
    f = listing(spark, root).where(F.col("path").rlike(r"/seed_[^/]*/[^/]+/[^/]+$"))
    parts = f.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("run"), F.substring_index("path", "/", -1).alias("name"))
    stems = parts.select("run", F.regexp_replace("name", r"(_info\.json|\.mp4)$", "").alias("stem"), F.col("name").endswith("_info.json").alias("info"), F.col("name").endswith(".mp4").alias("mp4"))
    return stems.groupBy("run", "stem").agg(F.max("info").alias("info"), F.max("mp4").alias("has_video")).where("info").drop("info")


def step_logs(spark: SparkSession, paths: str | list[str], checked: bool = False) -> DataFrame:
    """Step records with their file; files are arrays, and an element's own index orders it. What does not fit the schema is an error.

    ``checked``: ValueError if a file is no array or an empty one, which a conversion does not take. Tasks find and open the files.
    """
    files = matching(spark, paths)
    texts = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content")) if files is None else _contents(files)
    if checked:
        heads = texts.select("file", F.regexp_extract("content", r"^\s*(\[\s*\]|.)", 1).alias("head"))
        if bad := heads.where(~F.col("head").isin("[") | F.col("head").isNull()).first():
            raise ValueError(f"{bad.file} holds no list of steps")
    if files is None:
        rows = spark.read.schema(schemas.STEP_LOG).option("multiLine", True).option("mode", "FAILFAST").json(paths)
        return rows.withColumn("file", F.col("_metadata.file_path"))
    kind = f"array<struct<{schemas.STEP_LOG}>>"
    steps = texts.where(F.col("content").rlike(r"[^ \t\r\n]")).withColumn("steps", F.when(F.col("sound"), F.from_json("content", kind, {"mode": "FAILFAST"})))
    broken = F.col("steps").isNull() | F.exists("steps", lambda x: x.isNull())
    told = F.raise_error(F.concat("file", F.lit(" holds what is no step"))).cast(kind)
    return steps.select("file", F.explode(F.when(broken, told).otherwise(F.col("steps"))).alias("step")).select("step.*", "file")


def statuses(spark: SparkSession, paths: str | list[str], which: Callable[[Column], Column] | None = None) -> DataFrame:
    """Episode results with their file; what cannot be parsed is null all over, not an error. ``which`` tells from a file's name if it is read.

    Tasks find and open the files. A file may be an array of results; if one is broken, the file is told beside each.
    """
    schema, files = f"{schemas.EPISODE_RESULT}, _corrupt_record string", matching(spark, paths)
    if files is None:
        rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(paths).withColumn("file", F.col("_metadata.file_path"))
        return rows if which is None else rows.where(which(F.col("file")))
    texts = _contents(files if which is None else files.where(which(F.col("file")))).where(F.col("content").rlike(r"[^ \t\r\n]"))
    texts = texts.withColumn("parts", F.when(F.col("content").rlike(r"^[ \t\r\n]*\["), F.from_json("content", "array<string>")).otherwise(F.array("content")))
    whole = F.col("sound") & F.col("parts").isNotNull() & F.forall("parts", lambda x: F.coalesce(x.rlike(r"^[ \t\r\n]*\{"), F.lit(False)))
    each = texts.select("file", "content", F.transform(F.when(whole, F.col("parts")).otherwise(F.array(F.lit(None).cast("string"))), lambda x: F.from_json(x, schema)).alias("each"))
    broken = F.exists("each", lambda x: x.isNull() | x["_corrupt_record"].isNotNull())
    rows = each.select("file", F.when(broken, F.col("content")).alias("__broken"), F.explode("each").alias("r")).select("r.*", "file", "__broken")
    return rows.withColumn("_corrupt_record", F.col("__broken")).drop("__broken")


def evaluation_results(spark: SparkSession, root: str) -> DataFrame:
    """Results with a success field from all result files: no step logs, no summaries; first file of an episode."""
    name = F.substring_index("file", "/", -1)
    rows = statuses(spark, f"{root}/*/*.json", lambda _: ~name.endswith("_info.json") & ~name.startswith("summary"))
    rows = rows.where(F.col("_corrupt_record").isNull() & F.col("success").isNotNull())
    rows = rows.withColumn("scene_dir", F.regexp_extract("file", "([^/]+)/[^/]+$", 1))
    rows = rows.withColumn("episode_id", F.coalesce("episode_id", F.regexp_replace(name, r"\.json$", "")))
    return keep_first(rows, ["scene_dir", "episode_id"], ["file"])


def frame_records(spark: SparkSession, root: str) -> DataFrame:
    """All ``*_frame_records.parquet`` with their file."""
    return spark.read.option("pathGlobFilter", "*_frame_records.parquet").option("recursiveFileLookup", "true").parquet(root).withColumn("file", F.col("_metadata.file_path"))


def frame_record_faults(records: DataFrame) -> DataFrame:
    """(fault, n): episodes in several files, numbers with several ids, repeated global indexes; empty if sound."""
    spread = records.groupBy("episode_id").agg(F.count_distinct("file").alias("n")).where("n > 1").select(F.lit("episode_in_files").alias("fault"))
    mixed = records.groupBy("episode_index").agg(F.count_distinct("episode_id").alias("n")).where("n > 1").select(F.lit("ids_of_number").alias("fault"))
    twice = records.groupBy("index").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated_index").alias("fault"))
    return spread.unionByName(mixed).unionByName(twice).groupBy("fault").agg(F.count("*").alias("n"))


def front_videos(spark: SparkSession, path: str) -> DataFrame:
    """Available front-camera rows of a video index; the filter and the columns reach the scan."""
    rows = spark.read.parquet(path).where((F.col("camera_name") == "front") & F.col("available"))
    return rows.select(F.col("index").alias("data_index"), "video_key", "video_frame_index", "chunk_index", "file_index")


def episode_dataset(spark: SparkSession, paths: str | list[str], scenes: list[str] | None = None, scenes_dir: str | None = None) -> DataFrame:
    """Episodes of (gzipped) JSON datasets; scene paths can be moved under another folder."""
    rows = spark.read.schema(schemas.EPISODE_DATASET).option("multiLine", True).json(paths)
    rows = rows.select(F.explode("episodes").alias("e"), F.col("_metadata.file_path").alias("file")).select("e.*", "file")
    if scenes_dir is not None:
        rows = rows.withColumn("scene_id", F.concat(F.lit(scenes_dir.rstrip("/") + "/"), F.regexp_replace("scene_id", "^.*scene_datasets/", "")))
    return rows if scenes is None else rows.where(scene_allowed(F.col("scene_id"), scenes))


def goal_dataset(spark: SparkSession, paths: str | list[str], scenes_dir: str | None = None, strict: bool = True) -> DataFrame:
    """Episodes of (gzipped) JSON datasets that share their goals by scene and category, with the goals back in each.

    Episodes and the entries of a pool become rows before they are joined, so that no row holds the goals of more than
    one episode. A file without a pool has its goals in the episodes; the first episode of a key then gives those of all, and its goal the category. A key that the pool lacks
    is an error, or has null goals without ``strict``; so are two lists of categories that differ. ``episode_id`` is the
    place in the file, and scenes can be moved under another folder.
    """
    rows = spark.read.schema(schemas.GOAL_DATASET).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    keys = lambda *names: F.array_sort(F.map_keys(F.coalesce(*(F.col(n) for n in names))))
    same = keys("category_to_task_category_id").eqNullSafe(keys("category_to_scene_annotation_category_id", "category_to_mp3d_category_id"))
    checked = F.when(same, F.col("episodes")).otherwise(F.raise_error("the lists of categories differ").cast(rows.schema["episodes"].dataType))
    category = lambda e: F.coalesce(e["object_category"], F.get(e["goals"], 0)["object_category"])
    key = lambda e: F.concat(F.substring_index(e["scene_id"], "/", -1), F.lit("_"), category(e))
    rows = rows.withColumn("file", F.col("_metadata.file_path"))
    each = rows.select("file", F.col("goals_by_category").isNotNull().alias("__pooled"), F.posexplode(checked).alias("place", "e"))
    e = F.col("e")
    each = each.select("file", F.col("place").cast("string").alias("episode_id"), "place", "__pooled", key(e).alias("goals_key"), category(e).alias("object_category"), e["scene_id"].alias("scene_id"), e["start_position"].alias("start_position"), e["start_rotation"].alias("start_rotation"), e["info"].alias("info"), e["goals"].alias("goals"))
    pool = rows.select("file", F.posexplode("goals_by_category").alias("n", "goals_key", "goals")).groupBy("file", "goals_key").agg(F.min_by("goals", "n").alias("goals"))
    # a pool may be large, which its compressed file does not tell: it is not broadcast
    shared = each.where("__pooled").drop("goals").join(pool.hint("merge"), ["file", "goals_key"], "left")
    own = each.where("NOT __pooled")
    first = own.groupBy("file", "goals_key").agg(F.min_by("goals", "place").alias("goals"))
    out = shared.select(each.columns).unionByName(own.drop("goals").join(first.hint("merge"), ["file", "goals_key"]))
    if strict:
        missing = F.raise_error(F.concat(F.lit("no goals for "), F.coalesce("goals_key", F.lit("an episode without a category")))).cast(out.schema["goals"].dataType)
        out = out.withColumn("goals", F.coalesce("goals", missing))
    if scenes_dir is not None:
        out = out.withColumn("scene_id", F.concat(F.lit(scenes_dir.rstrip("/") + "/"), F.regexp_replace("scene_id", "^data/scene_datasets/", "")))
    return out.drop("place", "__pooled")


def vocabulary_of(spark: SparkSession, path: str, field: str = "instruction_vocab") -> DataFrame:
    rows = spark.read.schema(schemas.EPISODE_DATASET).option("multiLine", True).json(path)
    return rows.select(F.posexplode(f"{field}.word_list").alias("id", "word"))


def humanoids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HUMANOIDS).option("multiLine", True).json(path)


def json_lines(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).json(paths)


def failed_split_rows(lines: DataFrame) -> DataFrame:
    """(k): the numbers of the last ``# failed split-id list:`` line of a log (columns number, value); no rows without one."""
    last = lines.where(F.col("value").startswith("# failed split-id list:")).agg(F.max_by("value", "number").alias("value")).where("value is not null")
    listed = F.split(F.trim(F.regexp_replace(F.regexp_replace("value", "^[^:]*:", ""), "[,\\s]+", " ")), " ")
    return last.select(F.explode(F.filter(listed, lambda x: x != "").cast("array<bigint>")).alias("k"))


def failed_splits(lines: DataFrame, default: list[int]) -> list[int]:
    """The same as numbers on the driver, for a command's arguments; the default without such a line."""
    if lines.where(F.col("value").startswith("# failed split-id list:")).isEmpty():
        return default
    return [r.k for r in failed_split_rows(lines).collect()]


def media_faults(episodes: DataFrame, media: DataFrame, fps: float) -> DataFrame:
    """Why an episode's videos do not fit: (episode_id, order, reason or null), from ``media(episode_id, camera, frames, width, height, fps)``.

    All four cameras, as many frames as steps, real sizes, the expected rate within one per cent, and the sizes of the
    first fitting episode.
    """
    close = (F.col("fps") <= 0) | (F.abs(F.col("fps") - fps) <= F.greatest(F.greatest(F.abs("fps"), F.lit(fps)) * 0.01, F.lit(0.01)))
    m = media.groupBy("episode_id").agg(
        F.count_distinct("camera").alias("n_cameras"), F.min("frames").alias("least"), F.max("frames").alias("most"), F.bool_and((F.col("width") > 0) & (F.col("height") > 0)).alias("sized"),
        F.bool_and(close).alias("timed"), F.array_sort(F.collect_list(F.struct("camera", "width", "height"))).alias("shapes"),
    )
    j = episodes.join(m, "episode_id", "left")
    reason = F.when(F.coalesce("n_cameras", F.lit(0)) < len(CAMERAS), "missing_camera").when((F.col("least") != F.col("n_steps")) | (F.col("most") != F.col("n_steps")), "frame_count").when(~F.col("sized"), "no_size").when(~F.col("timed"), "frame_rate")
    j = j.withColumn("reason", reason)
    first = j.where("reason IS NULL").agg(F.min_by("shapes", "order").alias("wanted"))
    j = j.crossJoin(F.broadcast(first))  # one row
    return j.select("episode_id", "order", F.coalesce("reason", F.when(F.col("shapes") != F.col("wanted"), "other_size")).alias("reason"))


def sorted_lists(df: DataFrame, key: str, items: str) -> DataFrame:
    """Items of each key in natural order, numbered."""
    w = Window.partitionBy(key).orderBy(*natural_key(F.col(items)))
    return df.withColumn("place", F.row_number().over(w) - 1)
