"""Licence scan: TF-IDF cosine to templates, then inheritance from the nearest directory.

A line speaks of licensing if it has a word for it or begins a template. Units
of a file are each such line, the words from its start on, over as many lines
as it takes, up to the next power of two of each template's length (a header of
any number of lines), and, for licence files by name, the whole text. Units of
a file with the same words are one. Units and templates are sparse vectors of
lower-case words. A word's document frequency is counted over all units of all
files, for the words of the templates and all others alike; texts that many
files have are weighed once, with their number of files. The unit nearest to a
template decides if its cosine reaches the threshold. A licence file decides
for its directory, the best one if there are several, and a file without a
licence of its own takes that of its nearest ancestor directory: the ancestors
of each distinct directory are joined with the licensed ones and the deepest is
kept.

Defined cases: null text and text without such lines have no units; a null path
is the root directory; equal cosines go to the smaller template name, equal
licence files to the smaller ``file_id``, which is of any type that has an
order; repeated rows are scanned once per ``file_id``, path and words, and all
get the result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.llm.common import cut, if_small

# Short notices of common licences, by their SPDX names.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. BSD License",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License. Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Creative Commons Zero public domain dedication. Licensed under CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
SPEAKS = "[Ll][Ii][Cc][Ee][Nn][CcSs][Ee]|[Cc][Oo][Pp][Yy][Rr][Ii][Gg][Hh][Tt]|[Ss][Pp][Dd][Xx]|[Pp]ermission is hereby granted|[Rr]edistribution and use"
LICENSE_FILE = "(^|/)(LICEN[CS]E|COPYING|NOTICE|UNLICENSE)([.-][A-Za-z0-9.-]*)?$"
#: So many words of a template, at a line's start or further on in it, make the line speak.
OPENING = 3
#: A word in more than one of so many units is frequent.
FREQUENT_SHARE = 1000
THRESHOLD = 0.6
#: Directories of so many levels at most, the root's included, are joined in so many parts.
TOP_LEVELS, SALT = 3, 64


def _words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("([A-Za-z0-9]+)"), F.lit(1)), lambda w: F.lower(w))


def _split(body: str) -> list[str]:
    return re.findall("[A-Za-z0-9]+", body)


def speaks(templates: dict[str, str]) -> str:
    """The pattern of lines that speak of licensing: SPEAKS, and the first words of each template."""
    either = lambda c: f"[{c.upper()}{c.lower()}]" if c.isalpha() else c
    openings = {"[^A-Za-z0-9]+".join("".join(map(either, w)) for w in _split(t)[:OPENING]) for t in templates.values()}
    return "|".join([SPEAKS, *sorted(openings - {""})])


def header_sizes(templates: dict[str, str]) -> list[int]:
    """The lengths in words of the headers that are tried."""
    return sorted({1 << (max(len(_split(t)), 1) - 1).bit_length() for t in templates.values()})


def units(files: DataFrame, templates: dict[str, str]) -> DataFrame:
    """``files(file_id, path, text)`` → ``(file_id, path, body)``, a body's words with single spaces."""
    pattern, sizes = speaks(templates), header_sizes(templates)
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.struct(_words(x).alias("w"), x.rlike(pattern).alias("s"))), lambda x: F.size(x["w"]) > 0)
    speaking = files.where(F.col("text").rlike(pattern) | F.col("path").rlike(LICENSE_FILE)).select("file_id", "path", "text", lines.alias("lines"))
    starts = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("i"), x["s"].alias("s"))), lambda x: x["s"])
    # a line has at least one word, so as many lines as words are enough
    header = lambda p: F.slice(F.flatten(F.transform(F.slice("lines", p["i"] + 1, sizes[-1]), lambda x: x["w"])), 1, sizes[-1])
    own = F.transform(starts, lambda p: F.element_at("lines", p["i"] + 1)["w"])
    headers = F.transform(starts, header)
    found = speaking.select("file_id", "path", "text", own.alias("own"), headers.alias("headers"))
    first = lambda n: F.transform("headers", lambda h: F.slice(h, 1, n))
    whole = F.when(F.col("path").rlike(LICENSE_FILE), F.array(_words(F.col("text")))).otherwise(F.array().cast("array<array<string>>"))
    found = found.select("file_id", "path", F.explode(F.concat("own", *map(first, sizes), whole)).alias("words"))
    return found.where(F.size("words") > 0).select("file_id", "path", F.array_join("words", " ").alias("body"))


def template_terms(spark, templates: dict[str, str]) -> DataFrame:
    """(template, word, tf): a bounded table, since templates are parameters."""
    if sum(map(len, templates.values())) > 1 << 20:
        raise ValueError("templates hold more than 1 MB")
    rows = spark.createDataFrame(sorted(templates.items()), "template string, body string")
    return rows.select("template", F.explode(_words(F.col("body"))).alias("word")).groupBy("template", "word").agg(F.count("*").cast("double").alias("tf"))


def cosines(bodies: DataFrame, templates: dict[str, str]) -> DataFrame:
    """Distinct ``bodies(h, body, n_files)`` with the cosine of each template that shares a word: (h, template, cosine)."""
    terms = cut(template_terms(bodies.sparkSession, templates))
    n = bodies.agg(F.sum("n_files")).first()[0] or 0
    vocabulary = terms.select("word").distinct()
    counts = cut(bodies.select("h", "n_files", F.explode(F.split("body", " ")).alias("word")).groupBy("h", "n_files", "word").agg(F.count("*").cast("double").alias("tf")))
    df = cut(counts.groupBy("word").agg(F.sum("n_files").alias("df")))
    inverse = F.log((1.0 + n) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    idf = vocabulary.join(df, "word", "left").select("word", inverse.alias("idf"))
    idf = F.broadcast(cut(idf))  # one row per word of the templates
    # rows of frequent words are not dealt by word; they are bounded, as a unit's words are
    frequent = if_small(cut(df.where(F.col("df") * FREQUENT_SHARE > n).select("word", inverse.alias("idf"))))
    rest = df.where(F.col("df") * FREQUENT_SHARE <= n).select("word", inverse.alias("idf"))
    counts = counts.select("h", "word", "tf")
    weighted = counts.join(frequent, "word").unionByName(counts.join(frequent, "word", "left_anti").join(rest, "word"))
    weighted = weighted.withColumn("w", F.col("tf") * F.col("idf"))
    wt = terms.join(idf, "word").select("template", "word", (F.col("tf") * F.col("idf")).alias("wt"))
    norms = wt.groupBy("template").agg(F.sqrt(F.sum(F.col("wt") * F.col("wt"))).alias("norm_t"))
    wt = F.broadcast(cut(wt.join(norms, "template")))
    norm_u = weighted.groupBy("h").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm_u"))
    dots = weighted.join(wt, "word").groupBy("h", "template").agg(F.sum(F.col("w") * F.col("wt")).alias("dot"), F.first("norm_t").alias("norm_t"))
    return dots.join(norm_u, "h").select("h", "template", F.round(F.col("dot") / F.col("norm_u") / F.col("norm_t"), 6).alias("cosine"))


def directory(path: Column) -> Column:
    return F.regexp_extract(F.coalesce(path, F.lit("")), "^(.*)/[^/]*$", 1)


def scan(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``files(file_id, path, text)`` → ``(file_id, path, license, origin, cosine, licensed_dir)``, one row per row.

    ``origin`` is ``file`` or ``header`` for a licence of the file's own,
    ``inherited`` for its directory's, ``none`` without one (all else null).
    """
    templates = templates or TEMPLATES
    files = files.select("file_id", F.coalesce("path", F.lit("")).alias("path"), "text")
    found = units(files, templates).select("file_id", "path", F.md5(F.col("body").cast("binary")).alias("h"), "body")
    found = cut(found.distinct())
    bodies = cut(found.groupBy("h", "body").agg(F.count("*").alias("n_files")))
    # the smaller name wins among equals: rank names downward
    names = sorted(templates, reverse=True)
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("template"))
    best = F.max_by(F.struct("template", "cosine"), F.struct("cosine", rank)).alias("b")
    scored = cosines(bodies, templates).where(F.col("cosine") >= threshold).groupBy("h").agg(best).select("h", "b.template", "b.cosine")
    own = found.select("file_id", "path", "h").join(if_small(cut(scored)), "h")
    own = cut(own.groupBy("file_id", "path").agg(best).select("file_id", "path", "b.template", "b.cosine"))
    licensed = own.where(F.col("path").rlike(LICENSE_FILE)).groupBy(directory(F.col("path")).alias("dir"))
    licensed = licensed.agg(F.min(F.struct((-F.col("cosine")).alias("c"), "file_id", "template")).alias("m"))
    licensed = licensed.select("dir", F.col("m.template").alias("dir_license"), (-F.col("m.c")).alias("dir_cosine"))
    steps = lambda d: F.split(d, "/")
    chain = F.transform(F.sequence(F.lit(0), F.size(steps("dir"))), lambda n: F.array_join(F.slice(steps("dir"), 1, n), "/"))
    dirs = files.select(directory(F.col("path")).alias("dir")).distinct()
    above = dirs.select(F.col("dir").alias("of"), F.explode(F.array_distinct(chain)).alias("dir"))
    # all directories are below the root, and a third may be below one more: the first levels are dealt in salted parts
    top = F.size(steps("dir")) <= TOP_LEVELS
    above = above.withColumn("part", F.when(top, F.pmod(F.xxhash64("of"), F.lit(SALT))).otherwise(0))
    licensed = licensed.withColumn("part", F.explode(F.when(top, F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))))
    nearest = above.join(if_small(cut(licensed)), ["dir", "part"]).groupBy("of").agg(F.max_by(F.struct("dir", "dir_license", "dir_cosine"), F.length("dir")).alias("d"))
    rows = files.select("file_id", "path", directory(F.col("path")).alias("of"))
    rows = rows.join(own.select(F.col("file_id").alias("o_id"), F.col("path").alias("o_path"), "template", "cosine"), F.expr("file_id <=> o_id AND path = o_path"), "left").join(nearest, "of", "left")
    has, inherits = F.col("template").isNotNull(), F.col("d").isNotNull()
    pick = lambda a, b: F.when(has, a).when(inherits, b)
    kind = F.when(F.col("path").rlike(LICENSE_FILE), "file").otherwise("header")
    return rows.select("file_id", "path", pick(F.col("template"), F.col("d.dir_license")).alias("license"), F.when(has, kind).when(inherits, "inherited").otherwise("none").alias("origin"), pick(F.col("cosine"), F.col("d.dir_cosine")).alias("cosine"), pick(F.col("of"), F.col("d.dir")).alias("licensed_dir"))
