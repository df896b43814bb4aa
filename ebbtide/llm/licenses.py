"""Licence scan of a tree of files, with built-in functions only.

Every line that speaks of licensing, and every window of words around a word that
does, is a sparse TF-IDF vector; its cosine to the vectors of licence templates
names the licence. Windows are as long as templates are, begin at every quarter of
their length, and run over line breaks, so a notice is found inside a long line, in
a wrapped paragraph and in a whole licence text alike. A file's own header decides;
a file without one inherits from the nearest directory above it that has a licence
file (``LICENSE``, ``LICENSE-MIT``, ``COPYING.LESSER``, ``UNLICENSE.md``, ``licence.txt``).

Defined results: NULL and empty texts have no licence of their own; a NULL path
has no directory and inherits nothing; rows that share a path share what they
inherit, their headers stay their own; equal cosines go to the first template by
name, the licence file of a directory with the highest cosine counts (by name if
equal); extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.sources.storage import stored

#: Licences and phrases that stand for them (fixed values, short quotes of public licence texts).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
#: What comes before a licence's short name in a tag (fixed value).
TAG = "SPDX-License-Identifier:"
#: Least cosine of a line or window.
SIMILAR = 0.6
#: Bytes up to which a checked table is sent to all executors.
_SMALL = 16 << 20
#: Parts of a frequent line or directory where the other side is not sent.
_SALTS = 16
_ABOUT = r"(?i)licen[cs]e|permission|permitted|redistribut|copyright"
_LICENCE_FILE = r"(?i)^(?:un)?(?:licen[cs]e|copying)(?:[-_.][a-z0-9.+-]+)?$"
#: Endings of names that are code, whatever comes before.
_CODE = r"(?i)\.(?:py|js|ts|java|scala|c|cc|cpp|h|hpp|go|rs|rb|sh|sql|html|css)$"
_WORD = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _terms(text: Column) -> Column:
    return F.explode(_words(text))


def tagged(templates) -> tuple:
    """Templates, and a tag for each licence; GNU licences also take two endings."""
    names = sorted({licence for licence, _ in templates})
    ends = lambda name: ("", "-only", "-or-later") if "GPL" in name else ("",)
    return (*templates, *((n, f"{TAG} {n}{end}") for n in names for end in ends(n)))


def _window_sizes(templates) -> list[int]:
    """Sizes 2, 3, 4, 6, 8, 12 and so on that templates need, each at most half longer than it."""
    sizes = set()
    for _, text in templates:
        n, size = len(re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text)), 2
        while size < n:
            size = size * 3 // 2 if size & (size - 1) == 0 else size * 4 // 3
        sizes.add(size)
    return sorted(sizes)


def _windows(words: Column, sizes: list[int]) -> Column:
    """array<string>: windows of words with one that speaks of licensing, of each size."""
    last = F.size(words) - 1

    def around(i: Column, size: int) -> Column:
        # Begins are multiples of a quarter, so windows of neighbouring words are the same.
        step = max(1, size // 4)
        low = F.greatest(F.ceil((i - size + 1) / step) * step, F.lit(0)).cast("int")
        high = (F.floor(i / step) * step).cast("int")
        return F.sequence(low, high, F.lit(step))

    def of_size(size: int) -> Column:
        places = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(words, i).rlike(_ABOUT))
        begins = F.array_distinct(F.flatten(F.transform(places, lambda i: around(i, size))))
        return F.transform(begins, lambda b: F.array_join(F.slice(words, b + 1, size), " "))

    none = F.array().cast("array<string>")
    return F.when(last >= 0, F.concat(*(of_size(size) for size in sizes))).otherwise(none)


def _template_terms(spark: SparkSession, templates) -> DataFrame:
    """(template, licence, term, weight): unit vectors of the templates."""
    rows = F.array(*(F.struct(*(F.lit(x) for x in (i, *t))) for i, t in enumerate(templates)))
    given = spark.range(1).select(F.inline(rows).alias("template", "licence", "text"))
    counts = given.select("template", "licence", _terms(F.col("text")).alias("term")).groupBy(
        "template", "licence", "term"
    ).agg(F.count("*").alias("n"))
    spread = counts.groupBy("term").agg(F.count("*").alias("df"))
    weighed = counts.join(spread, "term").withColumn("weight", F.col("n") * _idf(F.col("df"), len(templates)))
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    return weighed.join(norms, "template").select(
        "template", "licence", "term", "df", (F.col("weight") / F.col("norm")).alias("weight")
    )


def _idf(df: Column, count: int) -> Column:
    return F.log((1 + count) / (1 + df)) + 1


def _best(pieces: DataFrame, templates: DataFrame, count: int) -> DataFrame:
    """(piece, licence, cosine): the nearest template of each piece (piece, text), if near enough.

    Terms travel with the piece's hash, not with its text.
    """
    counts = pieces.select("piece", _terms(F.col("text")).alias("term")).groupBy("piece", "term").agg(
        F.count("*").alias("n")
    )
    spread = templates.groupBy("term").agg(F.first("df").alias("df"))
    # A term that no template has only makes the piece longer.
    weighed = counts.join(spread, "term", "left").withColumn(
        "weight", F.col("n") * _idf(F.coalesce("df", F.lit(0)), count)
    )
    norms = weighed.groupBy("piece").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    dots = (
        weighed.where("df IS NOT NULL")
        .select("piece", "term", F.col("weight").alias("own"))
        .join(templates.select("template", "licence", "term", "weight"), "term")
        .groupBy("piece", "template", "licence")
        .agg(F.sum(F.col("own") * F.col("weight")).alias("dot"))
    )
    return (
        dots.join(norms, "piece")
        .withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9))
        .where(F.col("cosine") >= SIMILAR)
        .groupBy("piece")
        .agg(F.min(F.struct((-F.col("cosine")).alias("cost"), "licence")).alias("best"))
        .select("piece", "best.licence", (-F.col("best.cost")).alias("cosine"))
    )


def _meet(rows: DataFrame, found: DataFrame, key: str, how: str) -> DataFrame:
    """Join of rows with a table of one row for each key, where a key may have a third of the rows.

    The table is sent to all executors if its bytes are few; otherwise keys are
    dealt over parts, and the table is repeated for each.
    """
    size = found.agg(F.coalesce(F.sum(32 + F.octet_length(F.col(key).cast("string"))), F.lit(0)))
    if size.first()[0] * 2 <= _SMALL:
        return rows.join(F.broadcast(found), key, how)
    salt = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(_SALTS)).cast("int"))
    return dealt.join(found.withColumn("salt", salt), [key, "salt"], how).drop("salt")


def _directory(path: Column) -> Column:
    """The directory of a path, with a closing slash; the root is empty."""
    return F.regexp_replace(path, r"[^/]*$", "")


def scan_licenses(files: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(file_id, path, licence, cosine, origin) for each row of (file_id, path, text).

    ``origin`` is ``header``, ``licence file``, ``inherited`` or NULL without a licence.
    """
    spark = files.sparkSession
    templates = tagged(templates)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    rows = files.select(
        "file_id",
        "path",
        F.coalesce(name.rlike(_LICENCE_FILE) & ~name.rlike(_CODE), F.lit(False)).alias("whole"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    about = F.col("text").rlike(_ABOUT)
    none = F.array().cast("array<string>")
    # Each step is a projection of its own, so words are taken once; a text without such words has none.
    split = rows.select(
        "file_id",
        "path",
        "whole",
        F.when(about, F.filter(F.split("text", r"\R"), lambda x: x.rlike(_ABOUT))).otherwise(none).alias("lines"),
        F.when(about, _words(F.col("text"))).otherwise(none).alias("words"),
    )
    sizes = _window_sizes(templates)
    texts = split.withColumn("windows", _windows(F.col("words"), sizes)).select(
        "file_id", "path", "whole", F.array_distinct(F.concat("lines", "windows")).alias("pieces")
    )
    found = stored(texts.withColumn("row", F.monotonically_increasing_id()), "licence-pieces-of-files")
    # Equal pieces are compared once.
    pieces = (
        found.select(F.explode("pieces").alias("text"))
        .distinct()
        .select(F.xxhash64("text").alias("piece"), "text")
        .dropDuplicates(["piece"])
    )
    vectors = stored(_template_terms(spark, templates), "licence-templates")
    known = stored(_best(pieces, vectors, len(templates)), "licence-pieces")
    own = (
        _meet(
            found.select("row", F.explode("pieces").alias("text")).select("row", F.xxhash64("text").alias("piece")),
            known,
            "piece",
            "inner",
        )
        .groupBy("row")
        .agg(F.min(F.struct((-F.col("cosine")).alias("cost"), "licence")).alias("own"))
    )
    named = stored(found.drop("pieces").join(own, "row", "left"), "licence-own")
    grants = (
        named.where(F.col("whole") & F.col("own").isNotNull())
        .groupBy(_directory(F.col("path")).alias("directory"))
        .agg(F.min("own").alias("granted"))
    )
    # Every directory of a file without a licence, once, meets those above it.
    lacking = named.where(F.col("own").isNull() & F.col("path").isNotNull())
    homes = lacking.select(_directory(F.col("path")).alias("home")).distinct()
    parts = F.split("home", "/")
    above = homes.select(
        "home",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size(parts) - 1),
                lambda i: F.when(i == 0, "").otherwise(
                    F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))
                ),
            )
        ).alias("directory"),
    )
    nearest = stored(
        above.join(grants, "directory")
        .groupBy("home")
        .agg(F.max_by("granted", F.char_length("directory")).alias("granted")),
        "licence-nearest",
    )
    homed = named.withColumn("home", F.when(F.col("own").isNull(), _directory(F.col("path"))))
    joined = _meet(homed, nearest, "home", "left")
    licence = F.coalesce("own", "granted")
    return joined.select(
        "file_id",
        "path",
        licence["licence"].alias("licence"),
        (-licence["cost"]).alias("cosine"),
        F.when(F.col("own").isNotNull(), F.when(F.col("whole"), "licence file").otherwise("header"))
        .when(F.col("granted").isNotNull(), "inherited")
        .alias("origin"),
    )
