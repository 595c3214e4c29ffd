"""Writers: partitioned Parquet, merges, staged publishing, resume by manifests, and array files.

File moves go through Hadoop's file system of the path, so that they work in any store that Spark writes.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pathloom.operators.prefix import checkpointed
from pathloom.sources import readers


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


file_system = _fs


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def read_small(spark: SparkSession, path: str) -> bytes:
    """The bytes of a file that is known to be small, such as a pointer or a head."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, written over an older one."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def move(spark: SparkSession, a: str, b: str) -> None:
    fs, p = _fs(spark, a)
    _, q = _fs(spark, b)
    if not fs.rename(p, q):
        raise OSError(f"cannot move {a} to {b}")


def replace(spark: SparkSession, a: str, b: str) -> None:
    """Move a file over another in one step, so that a reader finds the old or the new one."""
    jvm = spark.sparkContext._jvm
    _, p = _fs(spark, a)
    _, q = _fs(spark, b)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(q.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(p, q, options)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_chunks(df: DataFrame, path: str, columns: tuple[str, str] = ("chunk_index", "file_index")) -> None:
    """Parquet by (chunk, file); each is whole in one task, and only those written are replaced."""
    df.repartition(*columns).sortWithinPartitions(*columns).write.option("partitionOverwriteMode", "dynamic").partitionBy(*columns).mode("overwrite").parquet(path)


def write_single(df: DataFrame, path: str, kind: str = "parquet", **options: str) -> None:
    """All rows as one file of just this name, from one task: for small tables."""
    spark = df.sparkSession
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    df.coalesce(1).write.options(**options).format(kind).save(stage)
    fs, p = _fs(spark, stage)
    parts = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")]
    move(spark, parts[0].toString(), path)
    remove(spark, stage)


def merge_parquet(spark: SparkSession, paths: list[str], out: str) -> None:
    """Rows of all files by column name, in one table that takes the place of an old one, of which nothing stays.

    ``versions.publish`` with the same build is for tables that are read meanwhile.
    """
    if not paths:
        raise ValueError("nothing to merge")
    _replace_table(spark, out, lambda stage: spark.read.parquet(*paths).write.parquet(stage))


def _replace_table(spark: SparkSession, out: str, build) -> None:
    backup = publish(spark, out, build, replace=True)
    if backup:
        remove(spark, backup)


def files_in_order(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files in the order given, those of a folder by name; hidden ones are left out."""
    found = []
    for path in paths:
        fs, p = _fs(spark, path)
        inside = [f.getPath() for f in fs.listStatus(p)] if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p).getPath()]
        found += sorted(f.toUri().toString() for f in inside if not f.getName().startswith(("_", ".")))
    return found


def ordered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text lines (value) with their key: ``file`` in the order given, ``start`` of the piece of the file, ``at`` within it.

    A piece of a file is read by one task from its first line to its last, so ``at`` ascends within it, however
    Spark packs the pieces. Lines end at ``\\n`` only, so that all other bytes stay as they are.
    """
    files = files_in_order(spark, paths)
    one = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")  # noqa: E731  file:/x and file:///x are one
    numbers = spark.createDataFrame(list(enumerate(files)), "file int, name string").select("file", one(F.col("name")).alias("name"))
    read = spark.read.option("lineSep", "\n").text(files).select("value", one(F.col("_metadata.file_path")).alias("name"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    return read.join(numbers, "name").select("file", "start", "at", "value")


def concat_lines(spark: SparkSession, paths: list[str], out: str) -> None:
    """Text lines of all files in order, as a table of text whose files, by name, hold them in that order; an old one is replaced."""
    if not paths:
        raise ValueError("nothing to concatenate")
    _replace_table(spark, out, lambda stage: ordered_lines(spark, paths).orderBy("file", "start", "at").select("value").write.text(stage))


def canonical_json(value: object) -> str:
    """Sorted keys, no spaces, ASCII only: one text per value."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


def fingerprint(value: object) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def write_json(spark: SparkSession, path: str, value: object) -> str:
    """One canonical JSON file that appears as a whole; the SHA-256 of its bytes."""
    data = canonical_json(value).encode()
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    try:
        write_bytes(spark, stage, data)
        replace(spark, stage, path)
    finally:
        if exists(spark, stage):
            remove(spark, stage)
    return hashlib.sha256(data).hexdigest()


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def publish(spark: SparkSession, target: str, build, validate=None, replace: bool = False) -> str | None:
    """Build beside ``target``, validate, then move into place; an old one becomes a stamped backup, put back on error.

    Returns the backup's path. FileExistsError without ``replace``.
    """
    target = target.rstrip("/")
    if exists(spark, target) and not replace:
        raise FileExistsError(target)
    stage, backup = f"{target}.stage-{uuid.uuid4().hex}", None
    try:
        build(stage)
        if validate:
            validate(stage)
        if exists(spark, target):
            backup = f"{target}.backup-{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:6]}"
            move(spark, target, backup)
        try:
            move(spark, stage, target)
        except Exception:
            if backup:
                move(spark, backup, target)
            raise
    finally:
        if exists(spark, stage):
            remove(spark, stage)
    return backup


def config_differences(saved: dict, expected: dict) -> dict:
    """Keys whose values differ, with both values."""
    return {k: (saved.get(k), v) for k, v in expected.items() if saved.get(k) != v}


def shard_states(expected: DataFrame, found: DataFrame) -> DataFrame:
    """missing, incomplete or complete for each ``expected(shard, n_rows)`` against ``found(shard, n_rows)``."""
    f = found.select("shard", F.col("n_rows").alias("__n"))
    state = F.when(F.col("__n").isNull(), "missing").when(F.col("__n") != F.col("n_rows"), "incomplete").otherwise("complete")
    return expected.join(f, "shard", "left").withColumn("state", state).drop("__n")


def shard_completeness(expected: DataFrame, files: DataFrame, main: list[str], artifacts: list[str], checkpoints: DataFrame, found: DataFrame, videos: DataFrame) -> DataFrame:
    """(shard, state) for each ``expected(shard, n_rows)``: missing if none of the kinds ``main`` is there.

    Complete if every ``main`` and ``artifacts`` kind of ``files(shard, kind, bytes)`` is there and not empty, the record in
    ``checkpoints(shard, complete, n_rows)`` says so with the same count, ``found(shard, n_rows)`` has it in its rows, and
    ``videos(shard, n_frames)`` in each video. Else incomplete.
    """
    kinds = files.groupBy("shard").agg(F.collect_set("kind").alias("there"), F.collect_set(F.when(F.col("bytes") > 0, F.col("kind"))).alias("full"))
    c = checkpoints.groupBy("shard").agg(F.bool_and(F.coalesce("complete", F.lit(False))).alias("told"), F.max("n_rows").alias("told_rows"))
    v = videos.groupBy("shard").agg(F.min("n_frames").alias("least"), F.max("n_frames").alias("most"))
    j = expected.join(kinds, "shard", "left").join(c, "shard", "left").join(found.select("shard", F.col("n_rows").alias("found_rows")), "shard", "left").join(v, "shard", "left")
    wanted = lambda names: F.array(*map(F.lit, names))
    whole = F.size(F.array_except(wanted([*main, *artifacts]), F.coalesce("full", F.array().cast("array<string>")))) == 0
    n = F.col("n_rows")
    sound = whole & F.coalesce(F.col("told") & (F.col("told_rows") == n) & (F.col("found_rows") == n) & (F.col("least") == n) & (F.col("most") == n), F.lit(False))
    none = ~F.arrays_overlap(wanted(main), F.coalesce("there", F.array().cast("array<string>")))
    return j.select("shard", F.when(none, "missing").when(sound, "complete").otherwise("incomplete").alias("state"))


def rows_digest(df: DataFrame) -> Column:
    """An aggregate that tells sets of rows apart, in any order: their number, and two sums over hashes of all columns."""
    columns = sorted(df.columns)
    return F.concat_ws(":", F.count("*"), F.bit_xor(F.xxhash64(*columns)), F.sum(F.pmod(F.xxhash64(F.lit(1), *columns), F.lit(1 << 40))))


def _task_uri(spark: SparkSession, path: str) -> str | None:
    """The qualified ``path`` if tasks can reach its store by themselves, None for stores that only Spark knows."""
    from pyarrow import fs

    store, p = _fs(spark, path)
    uri = store.makeQualified(p).toString().rstrip("/")
    try:
        fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, OSError):
        return None
    return uri


def shard_listing(spark: SparkSession, path: str) -> DataFrame:
    """(shard, path, bytes) of the files in the shards' folders, which tasks list; contents are not read."""
    found = readers.listing(spark, f"{path}/data").where(F.col("path").endswith(".parquet"))
    return found.select(F.regexp_extract("path", "shard=([0-9]+)/", 1).cast("long").alias("shard"), "path", F.col("length").alias("bytes"))


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, bytes, n_files) of what lies in the shards' folders."""
    return shard_listing(spark, path).groupBy("shard").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n_files"))


def shard_rows(spark: SparkSession, path: str, schema: StructType | str, listed: DataFrame | None = None, skip_corrupt: bool = False) -> DataFrame:
    """Rows of the shards' files (or of those in ``listed(shard, path)``) in the columns of ``schema``, null where a file lacks one, and their ``shard``.

    Files are rows of tasks, which open them, so that many shards are no index of the driver. Of a file that cannot be read
    nothing or not all is there if ``skip_corrupt``, else that is an error.
    """
    uri = _task_uri(spark, f"{path}/data")
    columns = spark.createDataFrame([], schema).drop("shard")
    if uri is None:
        return spark.read.schema(columns.withColumn("shard", F.lit(0).cast("long")).schema).option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(f"{path}/data")
    kinds = columns.toArrow().schema

    def run(batches):
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)
        for b in batches:
            for shard, file in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    with store.open_input_file(base.rstrip("/") + file[len(uri) :]) as f:
                        whole = pq.ParquetFile(f)
                        there = set(whole.schema_arrow.names)
                        for part in whole.iter_batches(1 << 13, columns=[n for n in kinds.names if n in there]):
                            own = [part.column(k.name).cast(k.type) if k.name in there else pa.nulls(part.num_rows, k.type) for k in kinds]
                            yield pa.RecordBatch.from_arrays([pa.array([shard] * part.num_rows, pa.int64()), *own], names=["shard", *kinds.names])
                except (OSError, pa.ArrowException):
                    if not skip_corrupt:
                        raise

    # few bytes name many files, so they are dealt over all tasks
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = (shard_listing(spark, path) if listed is None else listed).select("shard", "path").repartition(parts, "path")
    return files.mapInArrow(run, StructType([StructField("shard", LongType()), *columns.schema.fields]))


def shard_records(spark: SparkSession, path: str) -> DataFrame:
    """The last record of each shard: (shard, n_rows, digest, bytes, run)."""
    schema = "shard long, n_rows long, digest string, bytes long, run int"
    if not exists(spark, f"{path}/_records"):
        return spark.createDataFrame([], schema)
    last = spark.read.schema(schema).parquet(f"{path}/_records").groupBy("shard").agg(F.max_by(F.struct("n_rows", "digest", "bytes", "run"), "run").alias("r"))
    return last.select("shard", "r.*")


def forget_records(spark: SparkSession, path: str, which: Column) -> None:
    """Drop the records of some shards, which are then written again by the next run."""
    kept = checkpointed(shard_records(spark, path).where(~which))
    _replace_table(spark, f"{path}/_records", kept.write.parquet)


def manifest_states(rows: DataFrame, path: str, content: bool = True) -> DataFrame:
    """(shard, state, n_rows, digest) for each shard of ``rows(shard, …)``, which are those that should be there.

    missing: neither record nor file. unrecorded: files that no record vouches for, as of a run that broke off. outdated: the
    record is of other rows than those expected. damaged: files lack, or have another size than the record says, or, if
    ``content``, their rows are not those of the record, which is found by reading them. Else complete.
    """
    spark, there = rows.sparkSession, exists(rows.sparkSession, f"{path}/data")
    expected = checkpointed(rows.groupBy("shard").agg(F.count("*").alias("n_rows"), rows_digest(rows).alias("digest")))
    listed = checkpointed(shard_listing(spark, path)) if there else spark.createDataFrame([], "shard long, path string, bytes long")
    files = listed.groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    records = shard_records(spark, path).select("shard", F.col("n_rows").alias("told_rows"), F.col("digest").alias("told"), F.col("bytes").alias("told_bytes"))
    j = expected.join(records, "shard", "left").join(files, "shard", "left")
    state = F.when(F.col("told").isNull(), F.when(F.col("bytes").isNull(), "missing").otherwise("unrecorded"))
    state = state.when((F.col("told") != F.col("digest")) | (F.col("told_rows") != F.col("n_rows")), "outdated")
    j = j.withColumn("state", state.when(F.coalesce("bytes", F.lit(-1)) != F.col("told_bytes"), "damaged").otherwise("complete"))
    if content and there:
        whole = listed.join(j.where("state = 'complete'").select("shard"), "shard", "left_semi")
        found = shard_rows(spark, path, rows.schema, whole, skip_corrupt=True)
        j = j.join(found.groupBy("shard").agg(rows_digest(found).alias("found")), "shard", "left")
        j = j.withColumn("state", F.when((F.col("state") == "complete") & ~F.col("digest").eqNullSafe(F.col("found")), "damaged").otherwise(F.col("state")))
    return j.select("shard", "state", "n_rows", "digest")


def write_shards(work: DataFrame, path: str, spec: dict, shard_size: int = 8192, content: bool = True) -> int:
    """Write the shards of ``work(ref_id, …)`` that are not complete by their records (``manifest_states``); the number written.

    A shard's record, its rows, their digest and its files' bytes, is written once the shard is. The build's settings
    are fingerprinted beside the shards, and another fingerprint is refused. A row without a number is a ValueError.
    """
    spark = work.sparkSession
    mark = f"{path}/_spec"
    if exists(spark, mark):
        saved = spark.read.text(mark).first()[0]
        if saved != fingerprint(spec):
            raise ValueError("the shards there were built with other settings")
    else:
        spark.createDataFrame([(fingerprint(spec),)], "value string").coalesce(1).write.text(mark)
    rows = work.withColumn("shard", F.floor(F.col("ref_id") / shard_size))
    states = checkpointed(manifest_states(rows, path, content))
    if not states.where("shard is null").isEmpty():
        raise ValueError("rows without a number are in no shard")
    todo = states.where("state <> 'complete'").drop("state")
    n = todo.count()
    if n:
        run = (shard_records(spark, path).agg(F.max("run")).first()[0] or 0) + 1
        write_chunks(rows.join(todo.select("shard"), "shard", "left_semi"), f"{path}/data", ("shard",))
        sizes = shard_files(spark, path).select("shard", "bytes")
        todo.join(sizes, "shard").select("shard", "n_rows", "digest", "bytes", F.lit(run).alias("run")).write.mode("append").parquet(f"{path}/_records")
    return n


def half_floats(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Vectors packed as little-endian 16-bit floats, which Spark has no type for: (key, packed)."""
    import numpy as np

    def run(batches):
        for b in batches:
            packed = [None if v is None else np.asarray(v, "<f2").tobytes() for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], names=[key, "packed"])

    kind = dict(df.dtypes)[key]
    return df.select(key, F.col(vector).cast("array<float>")).mapInArrow(run, f"{key} {kind}, packed binary")


def flat_arrays(df: DataFrame, order: str, values: list[str], dtypes: list[str], rows: int = 1 << 20) -> DataFrame:
    """Columns as pieces of flat arrays: (column, first, n, data), ``data`` the values' bytes in numpy's notation of ``dtypes``.

    ``order`` numbers the rows from 0 without gaps, and tells in which piece of ``rows`` rows a value is and where. The
    pieces of a column side by side, by ``first``, are the body of its array file; ``npy_header`` is its head. Values must not be null.
    """
    import numpy as np

    names = ["column", "first", "n", "data"]

    def run(pdf):
        pdf = pdf.sort_values(order)
        first = int(pdf[order].iloc[0])
        if (np.diff(pdf[order]) != 1).any():
            raise ValueError(f"{order} repeats or skips numbers from {first} on")
        made = [(v, first, len(pdf), pdf[v].to_numpy().astype(d).tobytes()) for v, d in zip(values, dtypes, strict=True)]
        return pd.DataFrame(made, columns=names)

    piece = F.floor(F.col(order) / rows).alias("__piece")
    return df.select(piece, order, *values).groupBy("__piece").applyInPandas(run, "column string, first long, n long, data binary")


def npy_header(dtype: str, n: int) -> bytes:
    """The head of a one-dimensional array file."""
    import io

    import numpy as np

    head = io.BytesIO()
    np.lib.format.write_array_header_1_0(head, {"descr": np.lib.format.dtype_to_descr(np.dtype(dtype)), "fortran_order": False, "shape": (n,)})
    return head.getvalue()


def write_array(df: DataFrame, order: str, value: str, dtype: str, path: str, rows: int = 1 << 20, at_offsets: bool | None = None) -> int:
    """One array file that ``numpy.load`` reads, from a column in the order of ``order``, which counts from 0 without gaps; its length.

    Tasks make the pieces. In a POSIX file system (``at_offsets``; found from the path's scheme) each writes its own at the
    place that its first number gives, so a repeated task writes the same bytes again; elsewhere pieces are
    files, which one task copies behind the head, one after another, through a buffer. The file appears whole, by a move.
    """
    spark = df.sparkSession
    n, low, high = df.agg(F.count("*"), F.min(order), F.max(order)).first()
    if n and (low, high) != (0, n - 1):
        raise ValueError(f"{order} goes from {low} to {high} in {n} rows")
    fs, p = _fs(spark, path)
    whole = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p)
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    base = whole.getParent().toString() + "/" + stage.rsplit("/", 1)[-1]
    head, width = npy_header(dtype, n), _width(dtype)
    pieces = flat_arrays(df, order, [value], [dtype], rows).select("first", "n", "data")
    if at_offsets is None:
        at_offsets = whole.toUri().getScheme() == "file"
    make_folder(spark, whole.getParent().toString())
    try:
        if at_offsets:
            written = _at_offsets(pieces, base, head, width, n)
        else:
            written = _one_behind_another(pieces, base, head, n)
        if written != n:
            raise ValueError(f"{written} of {n} values were written")
        replace(spark, base, path)
    finally:
        for left in (base, f"{base}-pieces"):
            if exists(spark, left):
                remove(spark, left)
    return n


def _width(dtype: str) -> int:
    import numpy as np

    return np.dtype(dtype).itemsize


def _at_offsets(pieces: DataFrame, base: str, head: bytes, width: int, n: int) -> int:
    local = base.split(":", 1)[1]

    def run(batches):
        import os

        for b in batches:
            for first, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                file = os.open(local, os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    rest, at = memoryview((head if not first else b"") + data), len(head) + first * width if first else 0
                    while rest:
                        done = os.pwrite(file, rest, at)
                        rest, at = rest[done:], at + done
                    os.fsync(file)
                finally:
                    os.close(file)
            yield pa.RecordBatch.from_arrays([b.column(1)], names=["n"])

    if not n:
        pieces = pieces.sparkSession.createDataFrame([(0, 0, b"")], "first long, n long, data binary")
    return pieces.mapInArrow(run, "n long").agg(F.sum("n")).first()[0]


def _one_behind_another(pieces: DataFrame, base: str, head: bytes, n: int) -> int:
    spark, parts = pieces.sparkSession, f"{base}-pieces"
    named = pieces.select(F.format_string("%020d", "first").alias("name"), "data")
    write_named(named, parts, "name", "data")

    def run(batches):
        from pyarrow import fs

        store, target = fs.FileSystem.from_uri(base)
        total = 0
        with store.open_output_stream(target, compression=None) as out:
            out.write(head)
            names = sorted(f.path for f in store.get_file_info(fs.FileSelector(f"{target}-pieces", allow_not_found=True)) if f.is_file and f.base_name.isdigit())
            for name in names:
                with store.open_input_stream(name, compression=None) as piece:
                    while block := piece.read(8 << 20):
                        out.write(block)
                        total += len(block)
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], names=["n"])

    total = spark.range(0, 1, 1, 1).mapInArrow(run, "n long").first()[0]
    width = pieces.agg(F.max(F.octet_length("data") / F.col("n"))).first()[0] if n else 1
    return int(total / width)


def read_array(spark: SparkSession, path: str, rows: int = 1 << 20) -> DataFrame:
    """(place, value) of a one-dimensional array file of numbers; each task reads its own stretch of the file, ``rows`` values at once at most."""
    import io

    import numpy as np

    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        head = io.BytesIO(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(fs.getFileStatus(p).getLen(), 4096))))
    finally:
        stream.close()
    np.lib.format.read_magic(head)
    shape, _, dtype = np.lib.format.read_array_header_1_0(head)
    start, uri, kind = head.tell(), p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString(), "double" if dtype.kind == "f" else "long"

    def run(batches):
        from pyarrow import fs as stores

        store, file = stores.FileSystem.from_uri(uri)
        with store.open_input_file(file) as f:
            for b in batches:
                places = b.column(0)
                for at in range(0, len(places), rows):
                    part = places.slice(at, rows)
                    f.seek(start + part[0].as_py() * dtype.itemsize)
                    own = np.frombuffer(f.read(len(part) * dtype.itemsize), dtype)
                    yield pa.RecordBatch.from_arrays([part, pa.array(own.astype("f8" if kind == "double" else "i8"))], names=["place", "value"])

    # the places are the rows themselves, so that Spark knows their number and does not take a large file for a small side of a join
    return spark.range(shape[0]).mapInArrow(run, f"place long, value {kind}")


def write_named(df: DataFrame, root: str, name: str, content: str, compression: str | None = None) -> int:
    """One file ``root/name`` per row with the column ``content`` as it is, or compressed. Their number.

    Rows are dealt over all tasks first: names and short texts are few bytes, so that Spark would leave many files to one task.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _, p = _fs(spark, root)
    base = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()

    def run(batches):
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(base)
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                whole = f"{folder}/{path}"
                store.create_dir(whole.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(whole, compression=compression) as out:
                    out.write(data or b"")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    rows = df.select(F.col(name).cast("string").alias("name"), F.col(content).cast("binary").alias("content")).repartition(parts, "name")
    return rows.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
