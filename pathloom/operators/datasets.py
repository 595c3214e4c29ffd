"""Episode tables: grouping, splitting, sampling, dictionary encoding and shared goals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pathloom.operators.prefix import checkpointed, running_before


def first_seen_order(df: DataFrame, group: str, position: str) -> DataFrame:
    """``df`` with the place of each row when groups stand together in the order of their first row (``group_start``)."""
    starts = df.groupBy(group).agg(F.min(position).alias("group_start"))
    return df.join(starts, group)


def splits(df: DataFrame, key: str, n_splits: int, seed: str, collate: str | None = None) -> DataFrame:
    """Equal runs of rows in a seeded order, grouped by ``collate`` in first-seen order; the remainder is dropped.

    The order is the MD5 of seed and key, so it is the same in any engine and process.
    Places are running numbers over range partitions of the keys, rows' contents stay where they are.
    """
    keyed = df.select(key, *([collate] if collate else []), F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary")).alias("h"))
    n = keyed.count()
    size = n // n_splits
    chosen = running_before(keyed, ["h", key], F.lit(1), "pos").where(F.col("pos") < size * n_splits)
    if collate:
        chosen = first_seen_order(checkpointed(chosen), collate, "pos").withColumnRenamed("pos", "within")
        chosen = running_before(chosen, ["group_start", "within"], F.lit(1), "pos")
    return chosen.select(key, F.floor(F.col("pos") / max(size, 1)).alias("split"))


def encode(df: DataFrame, name: str, position: str) -> DataFrame:
    """Dense ids of names by first appearance: (name, id). Positions of different names differ."""
    first = df.groupBy(name).agg(F.min(position).alias("first"))
    return running_before(first, ["first"], F.lit(1), "id").select(name, "id")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def rehydrate(episodes: DataFrame, goals: DataFrame, key: str) -> DataFrame:
    """Episodes with the goal list that they share by key."""
    return episodes.join(goals, key, "left")


def resolve(df: DataFrame, name: str, explicit: Column, catalogue: DataFrame, order: str, id_: str) -> DataFrame:
    """``df`` with ``resolved``: an explicit id, or that of the first catalogue row of the name, or null."""
    first = catalogue.groupBy(name).agg(F.min_by(id_, order).alias("__id"))
    return df.join(first, name, "left").withColumn("resolved", F.coalesce(explicit, F.col("__id"))).drop("__id")


def scene_allowed(scene: Column, names: list[str]) -> Column:
    """In the list, or the list holds the mask of all. The name is the file's without its last extension."""
    base = F.regexp_replace(F.substring_index(scene, "/", -1), r"\.[^.]*$", "")
    return F.lit(True) if "*" in names else base.isin(*names)


def has_substrings(text: Column, include: list[str], exclude: list[str]) -> Column:
    """Contains one of the first and none of the second; nothing is kept without the first."""
    inside = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w)) if words else F.lit(False)
    return inside(include) & ~inside(exclude)


def even_sample(df: DataFrame, order: str, k: int) -> DataFrame:
    """``k`` evenly spaced rows of each ``episode_id``, places rounded half to even."""
    w = Window.partitionBy("episode_id")
    placed = df.withColumn("__p", F.row_number().over(w.orderBy(order)) - 1).withColumn("__n", F.count("*").over(w))
    at = lambda i: F.bround(i * (F.col("__n") - 1).cast("double") / max(k - 1, 1)).cast("long")
    wanted = F.exists(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: at(i) == F.col("__p"))
    return placed.where((F.col("__n") <= k) | wanted).drop("__p", "__n")


def largest(df: DataFrame, keys: list[str], area: str, index: str, allowed: Column) -> DataFrame:
    """Index of the largest allowed item per key, the first on ties, -1 without one."""
    best = F.max_by(index, F.when(allowed, F.struct(area, -F.col(index))))
    return df.groupBy(*keys).agg(F.coalesce(best, F.lit(-1)).cast("long").alias("largest"))


def weighted_choice(df: DataFrame, keys: list[str], weight: str, index: str, u: Column) -> DataFrame:
    """First index whose running share of the weights reaches ``u`` (in [0, 1], one per key)."""
    w = Window.partitionBy(*keys)
    running = F.sum(weight).over(w.orderBy(index).rowsBetween(Window.unboundedPreceding, 0)) / F.sum(weight).over(w)
    return df.withColumn("__share", running).where(F.col("__share") >= u).groupBy(*keys).agg(F.min(index).alias("chosen"))


def balanced_scene(episode: Column, n_episodes: int, n_scenes: int) -> Column:
    if n_episodes % n_scenes:
        raise ValueError("episodes must divide evenly among scenes")
    return F.floor(episode / (n_episodes // n_scenes))


def same_keys(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def compatible(dy: Column, geodesic: Column, euclidean: Column, radius: Column, u: Column, near: float = 1.0, far: float = 30.0) -> Column:
    """Start and goal on one floor, a finite distance within bounds, not almost straight (by chance), on a large enough island."""
    ratio = geodesic / euclidean
    straight = (ratio < 1.1) & (u > 20 * (ratio - 0.98) * (ratio - 0.98))
    return (F.abs(dy) <= 0.5) & (F.abs(geodesic) < float("inf")) & geodesic.between(near, far) & ~straight & (radius >= 1.5)


def iteration_order(df: DataFrame, key: str, scene: str, seed: str | None = None, repeats: int | None = None) -> DataFrame:
    """In which order episodes are visited: columns ``turn`` and ``place``, to be sorted by ``turn``, scene, ``place``.

    Episodes go by key, or shuffled by the hash of seed and key, and stay with their scene. After ``repeats`` of
    one scene the next scene follows; the rest of the first waits for a later turn.
    """
    order = [F.col(key)] if seed is None else [F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string")).cast("binary")), F.col(key)]
    rank = F.row_number().over(Window.partitionBy(scene).orderBy(*order)) - 1
    out = df.withColumn("place", rank.cast("long"))
    return out.withColumn("turn", F.lit(0).cast("long") if repeats is None else F.floor(F.col("place") / repeats).cast("long"))


def visit_turns(df: DataFrame, key: str, scene: str, n_steps: str, most_steps: int, spread: float, seed: str, cycles: int = 1) -> DataFrame:
    """In which order episodes are visited if a scene is left once its episodes have taken about ``most_steps`` steps.

    Each cycle shuffles anew by the hash of seed, cycle and key. Scenes take turns in the order of their first episodes; what
    is left of a scene waits for its next turn. The limit of a turn is drawn from ``most_steps`` times 1 ± ``spread`` by
    the hash of seed, cycle, scene and turn. Columns key, scene, ``cycle``, ``turn``, ``scene_place``, ``place``: sort by
    ``cycle``, ``turn``, ``scene_place``, ``place``. A scene's rows pass through one task in order, as each turn depends on
    those before, but only a turn's number and steps are held.
    """
    each = df.select(key, scene, F.col(n_steps).cast("long").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cycles - 1).cast("long"))).alias("cycle"))
    digest = F.md5(F.concat_ws("/", F.lit(seed), F.col("cycle").cast("string"), F.col(key).cast("string")).cast("binary"))
    each = each.select("cycle", scene, key, "n", digest.alias("h"), F.col(scene).cast("string").alias("__name"))
    places = each.groupBy("cycle", scene).agg(F.min("h").alias("first"))  # one row per scene
    places = places.select("cycle", scene, (F.row_number().over(Window.partitionBy("cycle").orderBy("first", scene)) - 1).cast("long").alias("scene_place"))
    low, high = int(most_steps * (1 - spread)), int(most_steps * (1 + spread))
    kinds = {f.name: f.dataType.simpleString() for f in each.schema}

    def limit(cycle: int, name: str, turn: int) -> int:
        """A number of 32 bits from the hash, as a share of the range."""
        drawn = int(hashlib.md5(f"{seed}/{cycle}/{name}/{turn}".encode()).hexdigest()[:8], 16) / (1 << 32)
        return low + int(drawn * (high - low + 1))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, turn, steps, place, most = None, 0, 0, 0, 0
        for b in batches:
            turns, ranks = [], []
            for cycle, name, n in zip(*(b.column(c).to_pylist() for c in ("cycle", "__name", "n")), strict=True):
                if (cycle, name) != at:
                    at, turn, steps, place, most = (cycle, name), 0, 0, 0, limit(cycle, name, 0)
                if steps >= most:
                    turn, steps = turn + 1, 0
                    most = limit(cycle, name, turn)
                turns.append(turn)
                ranks.append(place)
                steps, place = steps + n, place + 1
            yield pa.RecordBatch.from_arrays([b.column(key), b.column(scene), b.column("cycle"), pa.array(turns, pa.int64()), pa.array(ranks, pa.int64())], names=[key, scene, "cycle", "turn", "place"])

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = each.repartition(parts, "cycle", scene).sortWithinPartitions("cycle", scene, "h", key)
    rows = ordered.mapInArrow(walk, f"`{key}` {kinds[key]}, `{scene}` {kinds[scene]}, cycle long, turn long, place long")
    return rows.join(places, ["cycle", scene]).select(key, scene, "cycle", "turn", "scene_place", "place")


def generated_episodes(scenes: DataFrame, scene: str, n: int, seed: str, side: float = 10.0) -> DataFrame:
    """``n`` episodes for each scene: start and goal in a square, as the hash of seed, scene and number gives them."""
    each = scenes.select(F.col(scene), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("number")) if n > 0 else scenes.select(F.col(scene), F.lit(0).alias("number")).limit(0)
    digest = each.withColumn("__h", F.md5(F.concat_ws("/", F.lit(seed), F.col(scene), F.col("number").cast("string")).cast("binary")))
    names = ("start_x", "start_z", "goal_x", "goal_z")
    part = lambda i: F.conv(F.substring("__h", 8 * i + 1, 8), 16, 10).cast("double") / float(1 << 32) * side
    return digest.select(scene, F.col("number").cast("long").alias("number"), *(part(i).alias(x) for i, x in enumerate(names)))


@dataclass(frozen=True)
class ReceptacleSet:
    """Parts of names that a receptacle, or the object that holds it, must or must not have."""

    objects: tuple[str, ...] = ("",)
    names: tuple[str, ...] = ("",)
    not_objects: tuple[str, ...] = ()
    not_names: tuple[str, ...] = ()


def receptacle_matches(name: Column, parent: Column, sets: list[ReceptacleSet]) -> Column:
    """Whether a receptacle is in the first set that decides on it.

    A set decides by excluding it, by holding it, or, for a receptacle of the scene itself (no parent), by its name alone.
    """

    def has(text: Column, parts: tuple[str, ...]) -> Column:
        return F.coalesce(reduce(or_, [F.contains(text, F.lit(p)) for p in parts], F.lit(False)), F.lit(False))

    out = F.lit(False)
    for s in reversed(sets):
        named = has(name, s.names)
        out = F.when(has(parent, s.not_objects) | has(name, s.not_names), False).when(parent.isNull(), named).when(named & has(parent, s.objects), True).otherwise(out)
    return out


def upright(ux: Column, uy: Column, uz: Column, least: float = 0.9) -> Column:
    """Whether the up direction of a receptacle is within a tilt of the vertical (cosine ``least``); false without a direction."""
    n = F.sqrt(ux * ux + uy * uy + uz * uz)
    return F.coalesce(uy / F.nullif(n, F.lit(0.0)) >= least, F.lit(False))
