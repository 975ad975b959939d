"""Licence scan in DataFrame operations only: TF-IDF cosine to templates, then inheritance by path.

Two kinds of parts of a file are compared by their sparse TF-IDF vectors (sublinear term
frequencies), which meet the templates' by joins on terms:

- headers: every line and every run of 2 to 6 and 8 neighbouring lines, with the notices;
- the whole file, with the licences' full texts (``license_texts``).

Document frequencies are counted over all files. By Cauchy-Schwarz a part reaches a cosine of
``least`` only if the terms that it shares with the template hold ``least`` of the template's
length. Two exact prefilters follow: the heaviest terms that are left when the lightest ones up
to that length are taken away are key terms, of which one must be there; and as many different
terms of the template must be there as its heaviest terms need to hold that length. A file
without a licence of its own takes that of the nearest directory above it that has a licence file.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Licences and notices that name them, as a line or a header of several.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT license"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0"),
]
#: Full texts by licence, a file each.
TEXTS = [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
#: A template's kind, licence and text.
TEMPLATES = [("header", *t) for t in NOTICES] + [("file", *t) for t in TEXTS]
SPLIT = "[^a-z0-9]+"
#: Numbers of neighbouring lines that are compared as one header.
RUNS = (1, 2, 3, 4, 5, 6, 8)
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"
LEAST = 0.8
_RESULT = ("own_license", "score", "license", "from_dir")


def _terms(text: str) -> dict[str, int]:
    return Counter("".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split())


def _list(terms: list[str]) -> Column:
    """A constant array; one expression, as thousands of literals would take the optimizer seconds."""
    return F.split(F.lit(" ".join(terms)), " ")


def frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of files, and of files that hold each term: as many numbers as the templates have terms."""
    found = F.array_intersect(F.split(F.lower("text"), SPLIT), _list(vocabulary))
    seen = files.where("text is not null").select(F.explode(found).alias("term")).groupBy("term").count()
    return files.count(), {r.term: r["count"] for r in seen.collect()}


def _weights(idf: dict[str, float]) -> list[dict[str, float]]:
    """Each template's unit vector."""
    out = []
    for *_, text in TEMPLATES:
        raw = {w: (1 + math.log(k)) * idf[w] for w, k in _terms(text).items()}
        length = math.sqrt(sum(x * x for x in raw.values()))
        out.append({w: x / length for w, x in raw.items()})
    return out


def _key_terms(vector: dict[str, float], least: float) -> set[str]:
    """Terms of which a part at a cosine of ``least`` has one at least."""
    light, keys = 0.0, set()
    for x, w in sorted((x, w) for w, x in vector.items()):
        light += x * x
        if light >= least * least - 1e-9:
            keys.add(w)
    return keys


def _fewest_terms(vector: dict[str, float], least: float) -> int:
    """How many different terms of the template a part at a cosine of ``least`` has at least."""
    heavy, n = 0.0, 0
    for x in sorted(vector.values(), reverse=True):
        heavy, n = heavy + x * x, n + 1
        if heavy >= least * least - 1e-9:
            break
    return n


def with_parts(files: DataFrame, vectors: list[dict[str, float]], least: float = LEAST) -> DataFrame:
    """``files`` without text, with parts: an array of (kind, part), the parts of the text that the prefilters leave.

    A text is split into words once, and each line of one with a key term too; only the words that some template has go
    on, and those of a run are its lines' together. Each step is a projection of its own, so that none is computed twice.
    """

    def of_kind(kind: str) -> list[dict[str, float]]:
        return [v for (k, *_), v in zip(TEMPLATES, vectors) if k == kind]

    def known(text: Column, templates: list[dict[str, float]]) -> Column:
        return F.array_intersect(F.split(F.lower(text), SPLIT), _list(sorted(set().union(*templates))))

    def has_key(kind: str, words: Column) -> Column:
        return F.arrays_overlap(words, _list(sorted(set().union(*(_key_terms(v, least) for v in of_kind(kind))))))

    def enough(kind: str, words: Column) -> Column:
        fewest = [_fewest_terms(v, least) for v in of_kind(kind)]
        tests = [F.size(F.array_intersect(words, _list(sorted(v)))) >= n for v, n in zip(of_kind(kind), fewest)]
        return (F.size(words) >= min(fewest)) & functools.reduce(Column.__or__, tests)

    part = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("part"))
    none = F.array().cast("array<struct<kind: string, part: string>>")
    rest = [c for c in files.columns if c != "text"]
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("x"), known(x, of_kind("header")).alias("words")))
    steps = files.select(*rest, "text", known(F.col("text"), vectors).alias("words"))
    steps = steps.withColumn("lines", F.when(has_key("header", F.col("words")), lines))
    # the numbers of lines with a key term
    hits = F.filter(F.transform("lines", lambda h, i: F.when(has_key("header", h["words"]), i)), lambda i: i.isNotNull())
    steps = steps.withColumn("hits", hits)

    def run(k: int) -> Column:
        """All runs of k lines that have a line with a key term and words enough."""
        starts = F.array_distinct(F.flatten(F.transform("hits", lambda i: F.sequence(i - (k - 1), i))))
        starts = F.filter(starts, lambda i: (i >= 0) & (i + k <= F.size("lines")))
        runs = F.transform(starts, lambda i: F.slice("lines", i + 1, k))
        held_by = F.transform(runs, lambda r: F.struct(r["x"].alias("x"), F.array_distinct(F.flatten(r["words"])).alias("words")))
        return F.transform(F.filter(held_by, lambda r: enough("header", r["words"])), lambda r: F.array_join(r["x"], "\n"))

    headers = F.transform(F.array_distinct(F.concat(*map(run, RUNS))), lambda x: part("header", x))
    whole = F.when(enough("file", F.col("words")) & has_key("file", F.col("words")), F.array(part("file", F.col("text"))))
    return steps.select(*rest, F.concat(F.coalesce(headers, none), F.coalesce(whole, none)).alias("parts"))


def scored(found: DataFrame, idf: dict[str, float], vectors: list[dict[str, float]], n: int, least: float = LEAST) -> DataFrame:
    """(row, license, score) of the rows of ``found`` (row, kind, part) with a part at a cosine of ``least`` or more.

    The best part counts; ties go to the first licence by name. Equal parts are scored once.
    """
    spark = found.sparkSession
    # 128 bits stand for a part where its terms are counted: a row per term with the whole part would spill
    found = found.withColumn("id", F.md5(F.col("part").cast("binary")))
    counts = found.groupBy("kind", "id").agg(F.first("part").alias("part")).select("kind", "id", F.explode(F.split(F.lower("part"), SPLIT)).alias("term")).where("term <> ''")
    counts = counts.groupBy("kind", "id", "term").agg((1 + F.log(F.count(F.lit(1)))).alias("tf"))
    # both tables below are the templates', so their size is fixed
    rarity = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    rows = [(i, kind, lic, w, x) for i, ((kind, lic, _), v) in enumerate(zip(TEMPLATES, vectors)) for w, x in v.items()]
    wanted = F.broadcast(spark.createDataFrame(rows, "template int, kind string, license string, term string, weight double"))
    weighed = counts.join(rarity, "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(math.log(1 + n) + 1)))
    length = weighed.groupBy("kind", "id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = weighed.join(wanted, ["kind", "term"]).groupBy("kind", "id", "template", "license").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    scores = dots.join(length, ["kind", "id"]).withColumn("score", F.round(F.col("dot") / F.col("length"), 6)).where(F.col("score") >= least)
    best = scores.groupBy("kind", "id").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
    hits = found.select("row", "kind", "id").join(best, ["kind", "id"])
    return hits.groupBy("row").agg(F.min("best").alias("best")).select("row", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score"))


def scan(files: DataFrame, least: float = LEAST) -> DataFrame:
    """Columns of ``files`` but text, with own_license, score, license and from_dir.

    ``files`` has path and text. A file named LICENSE, COPYING or NOTICE with a licence is its
    directory's licence (several: the first by score, then by name). ``license`` is the file's
    own or else that of the nearest directory upward, from_dir names it. Null text has no
    licence; a null path has no directory; files with the same path stay apart. Columns of
    ``files`` with names of the result's are kept as given_<name>. Texts are read twice, for
    the document frequencies and for the parts, and written nowhere.
    """
    vocabulary = sorted({w for *_, t in TEMPLATES for w in _terms(t)})
    n, df = frequencies(files, vocabulary)
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary}
    vectors = _weights(idf)
    files = files.withColumnsRenamed({c: f"given_{c}" for c in files.columns if c in _RESULT})
    rest = [c for c in files.columns if c not in ("path", "text")]
    one = with_parts(files.select(F.struct("path", *rest).alias("file"), "path", "text"), vectors, least)
    one = stored(one.select(F.monotonically_increasing_id().alias("row"), "file", "path", "parts"), "zstd")
    found = one.where(F.size("parts") > 0).select("row", F.explode("parts").alias("p")).select("row", "p.kind", "p.part")
    own = stored(scored(found, idf, vectors, n, least))
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), "")
    kept = one.select("row", "file", "path", folder.alias("dir")).join(own.withColumnRenamed("license", "own_license"), "row", "left")
    named = F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENCE_FILE)
    given = kept.where(named & F.col("own_license").isNotNull()).groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("minus"), "own_license")).alias("best"))
    given = given.select(F.col("dir").alias("near_dir"), F.col("best.own_license").alias("near_license"))
    # directories stand for their files: a directory with most files is one row here
    dirs = kept.select("dir").where("dir is not null").distinct()
    steps = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    above = dirs.select("dir", F.posexplode(F.concat(F.array(F.lit("")), up)).alias("depth", "near_dir"))
    near = above.join(given, "near_dir").groupBy("dir").agg(F.max(F.struct("depth", "near_dir", "near_license")).alias("near"))
    out = kept.join(near, "dir", "left")
    inherited = F.when(F.col("own_license").isNull(), F.col("near.near_dir"))
    columns = [F.col("file")[c].alias(c) for c in files.columns if c != "text"]
    return out.select(*columns, "own_license", "score", F.coalesce("own_license", F.col("near.near_license")).alias("license"), inherited.alias("from_dir"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand as files: 64 to a directory, 64 directories to one above it, below their source.
    The first of each directory is its LICENSE."""
    docs = table(spark, sf_dir, "documents")
    up, dir_ = F.expr("doc_id div 4096"), F.expr("doc_id div 64")
    top = F.concat(F.coalesce("source", F.lit("none")), F.lit("/d"), F.coalesce(up, F.lit(0)))
    path = F.when(F.col("doc_id") % 4096 == 0, F.concat(top, F.lit("/LICENSE"))).when(F.col("doc_id") % 64 == 0, F.concat(top, F.lit("/e"), dir_, F.lit("/LICENSE")))
    path = F.coalesce(path, F.concat(top, F.lit("/e"), F.coalesce(dir_, F.lit(0)), F.lit("/"), F.coalesce("doc_id", F.lit(0)), F.lit(".txt")))
    files = docs.select(F.col("doc_id").cast("long"), path.alias("path"), "text")
    return scan(files).select("doc_id", "path", "own_license", "score", "license", "from_dir")


def _oracle() -> str:
    counts = ", ".join(f"({i}, '{kind}', '{lic}', '{w}', {k})" for i, (kind, lic, t) in enumerate(TEMPLATES) for w, k in _terms(t).items())
    runs = ", ".join(f"({k})" for k in RUNS)
    return rf"""
WITH f AS (
  SELECT doc_id, text, coalesce(source, 'none') || '/d' || (doc_id // 4096) AS top,
         CASE WHEN doc_id % 4096 = 0 THEN top || '/LICENSE' WHEN doc_id % 64 = 0 THEN top || '/e' || (doc_id // 64) || '/LICENSE'
              ELSE top || '/e' || (doc_id // 64) || '/' || doc_id || '.txt' END AS path
  FROM documents),
tc AS (SELECT * FROM (VALUES {counts}) v(template, kind, license, term, n)),
n AS (SELECT count(*) AS n FROM f),
dw AS (
  SELECT term, count(*) AS df FROM (
    SELECT unnest(list_distinct(regexp_split_to_array(lower(text), '{SPLIT}'))) AS term FROM f) WHERE term IN (SELECT term FROM tc) GROUP BY term),
idf AS (SELECT term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT DISTINCT term FROM tc) LEFT JOIN dw USING (term), n),
tr AS (SELECT template, kind, license, term, (1 + ln(tc.n)) * idf AS raw FROM tc JOIN idf USING (term)),
tw AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY template)) AS weight FROM tr),
s AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM f WHERE text IS NOT NULL),
l AS (
  SELECT DISTINCT doc_id, 'header' AS kind, array_to_string(lines[i:i + k - 1], chr(10)) AS part
  FROM (SELECT doc_id, lines, k, unnest(range(1, (len(lines) - k + 2)::BIGINT)) AS i FROM s, (VALUES {runs}) r(k))
  UNION ALL SELECT doc_id, 'file', text FROM f WHERE text IS NOT NULL),
lc AS (
  SELECT kind, part, term, 1 + ln(count(*)) AS tf FROM (
    SELECT kind, part, unnest(regexp_split_to_array(lower(part), '{SPLIT}')) AS term FROM (SELECT DISTINCT kind, part FROM l)) WHERE term <> '' GROUP BY ALL),
lw AS (SELECT kind, part, lc.term, tf * coalesce(idf, ln(1 + n) + 1) AS x FROM lc LEFT JOIN idf ON lc.term = idf.term, n),
ln AS (SELECT kind, part, sqrt(sum(x * x)) AS length FROM lw GROUP BY ALL),
sc AS (
  SELECT kind, part, license, round(dot / length, 6) AS score FROM (
    SELECT kind, part, template, license, sum(x * weight) AS dot FROM lw JOIN tw USING (kind, term) GROUP BY ALL) JOIN ln USING (kind, part)),
own AS (
  SELECT doc_id, first(license ORDER BY score DESC, license) AS own_license, max(score) AS score
  FROM l JOIN sc USING (kind, part) WHERE score >= {LEAST} GROUP BY doc_id),
k AS (SELECT f.doc_id, path, regexp_replace(path, '/[^/]*$', '') AS dir, own_license, score FROM f LEFT JOIN own USING (doc_id)),
g AS (
  SELECT dir AS from_dir, first(own_license ORDER BY score DESC, own_license) AS from_license
  FROM k WHERE path LIKE '%/LICENSE' AND own_license IS NOT NULL GROUP BY dir),
a AS (
  SELECT doc_id, max_by(from_dir, length(from_dir)) AS near_dir, max_by(from_license, length(from_dir)) AS near_license
  FROM k JOIN g ON k.dir = from_dir OR starts_with(k.dir, from_dir || '/') GROUP BY doc_id)
SELECT k.doc_id, path, own_license, score, coalesce(own_license, near_license) AS license,
       CASE WHEN own_license IS NULL THEN near_dir END AS from_dir
FROM k LEFT JOIN a USING (doc_id)
"""


ORACLE = {"op3_licenses": _oracle()}
