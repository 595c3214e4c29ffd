"""Compact episode tables: names become numbers by their first use, matrices become places in one flat pool, and back again.

An episode has ``objects`` (array of name, transform), ``holders`` (map of name to name), ``states`` (map of name to a map of
link to value) and ``markers`` (array of name, type, offset, link, object). Its names in this order, markers' in the order
name, type, link, object, are its slots; the ids of names go by the first slot of the first episode that has them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.operators.prefix import checkpointed, if_small, running_before


@dataclass(frozen=True)
class Encoded:
    """Episodes with numbers, ``names(name, id)`` and ``pool(at, transform)``."""

    episodes: DataFrame
    names: DataFrame
    pool: DataFrame


def _slots(holders: Column, pair, states: Column, markers: Column, objects: Column, name: str) -> Column:
    flat = lambda parts, f: F.flatten(F.transform(parts, f))
    return F.concat(
        F.transform(objects, lambda o: o[name]), flat(holders, pair), states, flat(markers, lambda m: F.array(m["name"], m["type"], m["link"], m["object"])),
    )


def _places() -> tuple[Column, Column, Column]:
    """Where the slots of holders, states and markers begin, from 1."""
    holders = F.size("objects") + 1
    states = holders + 2 * F.size("holders")
    return holders, states, states + F.size("states")


def _numbered(episodes: DataFrame, order: str, slots: Column, lookup: DataFrame, by: str, to: str) -> DataFrame:
    """(order, ids): each episode's slots looked up in ``lookup(by, to)``; a name or number that is not there is an error.

    Few names have most of the slots, so a dictionary that is small, which is counted, is no shuffle by name.
    """
    each = episodes.select(order, F.posexplode(slots).alias("slot", by))
    found = each.join(if_small(lookup), by, "left").withColumn(to, F.coalesce(to, F.raise_error(F.concat(F.lit("not in the dictionary: "), F.col(by).cast("string"))).cast(dict(lookup.dtypes)[to])))
    return found.groupBy(order).agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", to))), lambda x: x[to]).alias("__ids"))


def encode(episodes: DataFrame, order: str) -> Encoded:
    """``order`` numbers the episodes; it and nulls inside an episode are refused by the joins (no null names)."""
    objects, holders, states, markers = (F.coalesce(F.col(c), F.expr(d)) for c, d in (("objects", "array()"), ("holders", "map()"), ("states", "map()"), ("markers", "array()")))
    fixed = checkpointed(episodes.select(order, *(c.cast(dict(episodes.dtypes)[n]).alias(n) for n, c in (("objects", objects), ("holders", holders), ("states", states), ("markers", markers)))))
    slots = _slots(F.map_entries("holders"), lambda e: F.array(e["key"], e["value"]), F.map_keys("states"), F.col("markers"), F.col("objects"), "name")
    used = fixed.select(order, F.posexplode(slots).alias("slot", "name")).groupBy("name")
    if dict(fixed.dtypes)[order] in ("tinyint", "smallint", "int", "bigint"):  # one number, whose least is found by hashing; that of structs needs a sort of all slots
        first, by = used.agg(F.min(F.col(order).cast("decimal(20,0)") * (1 << 31) + F.col("slot")).alias("__o")), ["__o"]
    else:
        first, by = used.agg(F.min(F.struct(order, "slot")).alias("first")).select("name", F.col("first")[order].alias("__o"), F.col("first.slot").alias("__s")), ["__o", "__s"]
    names = checkpointed(running_before(first, by, F.lit(1), "id").select("name", "id"))
    starts = running_before(fixed.select(order, F.size("objects").alias("n")), [order], F.col("n"), "__base").select(order, "__base")
    ids = _numbered(fixed, order, slots, names, "name", "id")
    j = fixed.join(starts, order).join(ids, order, "left").withColumn("__ids", F.coalesce("__ids", F.array().cast("array<bigint>")))
    h, s, m = _places()
    at = lambda i: F.get("__ids", i)
    pairs = F.transform(F.sequence(F.lit(0), F.size("holders") - 1), lambda i: F.struct(at(h - 1 + 2 * i).alias("key"), at(h + 2 * i).alias("value")))
    four = lambda x, i: F.struct(at(m - 1 + 4 * i).alias("name"), at(m + 4 * i).alias("type"), x["offset"].alias("offset"), at(m + 1 + 4 * i).alias("link"), at(m + 2 + 4 * i).alias("object"))
    out = j.select(
        order, F.transform("objects", lambda x, i: F.struct(at(i).alias("name"), (F.col("__base") + i).alias("at"))).alias("objects"),
        F.when(F.size("holders") > 0, pairs).otherwise(F.array().cast("array<struct<key:bigint,value:bigint>>")).alias("holders"),
        F.map_from_arrays(F.slice("__ids", s, F.size("states")), F.map_values("states")).alias("states"), F.transform("markers", four).alias("markers"),
    )
    pool = fixed.join(starts, order).select("__base", F.posexplode("objects").alias("i", "x")).select((F.col("__base") + F.col("i")).alias("at"), F.col("x.transform").alias("transform"))
    return Encoded(out, names, pool)


def decode(encoded: Encoded, order: str) -> DataFrame:
    """The episodes again; a number or place that the dictionary or pool lacks is an error."""
    e = encoded.episodes
    slots = _slots(F.col("holders"), lambda x: F.array(x["key"], x["value"]), F.map_keys("states"), F.col("markers"), F.col("objects"), "name")
    names = _numbered(e, order, slots, encoded.names, "id", "name")
    used = e.select(order, F.posexplode("objects").alias("i", "x")).select(order, "i", F.col("x.at").alias("at"))
    pooled = used.join(encoded.pool.withColumn("__there", F.lit(True)), "at", "left").withColumn("__there", F.coalesce("__there", F.raise_error(F.concat(F.lit("not in the pool: "), F.col("at").cast("string"))).cast("boolean"))).where("__there")
    transforms = pooled.groupBy(order).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "transform"))), lambda x: x["transform"]).alias("__t"))
    j = e.join(names, order, "left").join(transforms, order, "left")
    h, s, m = _places()
    at = lambda i: F.get("__ids", i)
    four = lambda x, i: F.struct(at(m - 1 + 4 * i).alias("name"), at(m + 4 * i).alias("type"), x["offset"].alias("offset"), at(m + 1 + 4 * i).alias("link"), at(m + 2 + 4 * i).alias("object"))
    none = F.array().cast("array<string>")
    keys = F.coalesce(F.slice("__ids", s, F.size("states")), none)
    return j.select(
        order, F.transform("objects", lambda x, i: F.struct(at(i).alias("name"), F.get("__t", i).alias("transform"))).alias("objects"),
        F.map_from_entries(F.transform("holders", lambda x, i: F.struct(at(h - 1 + 2 * i), at(h + 2 * i)))).alias("holders"),
        F.map_from_arrays(keys, F.map_values("states")).alias("states"), F.transform("markers", four).alias("markers"),
    )
