"""License scan by MinHash bands over overlapping windows (operator 2),
DataFrame functions only.

Texts are lower-cased and read as runs of ASCII letters and digits; shingles
are five words.  A template of m shingles belongs to the size class c with
2^(c-1) < m <= 2^c; a text's windows of that class have 2 * 2^c shingles and
start every 2^c, so any run as long as the template lies in one of them.  A
window that holds at least ``containment`` of a template has a Jaccard
similarity of at least J = 0.8 / 4.2 with it, so that with bands of one
MinHash value each, ceil(log(1 - p) / log(1 - J)) bands meet with probability
p or more (p = 0.999999: 66 bands).  Retrieved pairs are verified by the exact
share of the template's shingles in the window.

A band of a window can only equal a template's when the window holds the
template's minimal shingle, so windows without any template shingle are
passed over before hashing; this loses nothing.  Templates are a stated list,
and all tables made from them are bounded by it.

Result: one row per (document, template) found, with the largest containment.
Defined cases: null, empty and shorter texts hold nothing; a null doc_id is
reported as null; rows that repeat a doc_id give one row per template with
the larger containment; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import register
from .common import documents, prepare, texts

# Notices that the licences themselves prescribe or that are in common use.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}
WORDS = 5


def _words(text: str) -> F.Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.expr(f"filter(split(lower({text}), '[^a-z0-9]+'), x -> x != '')")


def _hashes(words: str) -> F.Column:
    inner = ", ".join(f"get({words}, i + {k})" for k in range(1, WORDS))
    return F.expr(f"transform(slice({words}, 1, greatest(size({words}) - {WORDS - 1}, 0)), (x, i) -> xxhash64(x, {inner}))")


def _shingles(words: str) -> F.Column:
    inner = ", ".join(f"get({words}, i + {k})" for k in range(1, WORDS))
    return F.expr(f"array_distinct(transform(slice({words}, 1, greatest(size({words}) - {WORDS - 1}, 0)), (x, i) -> concat_ws(' ', x, {inner})))")


def _bands(hashes: str, bands: int) -> F.Column:
    """One MinHash value per band, under hash functions seeded by the band."""
    return F.expr(f"transform(sequence(0, {bands - 1}), k -> named_struct('band', k, 'value', array_min(transform({hashes}, x -> xxhash64(x, k)))))")


def license_scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    containment: float = 0.8,
    certainty: float = 0.999999,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, license, containment) for every template a document holds."""
    spark = docs.sparkSession
    prepare(spark)
    bands = math.ceil(math.log(1 - certainty) / math.log(1 - containment / (5 - containment)))
    listed = spark.createDataFrame(list((TEMPLATES if templates is None else templates).items()), "license string, text string")
    listed = listed.withColumn("words", _words("text")).withColumn("hashes", _hashes("words")).withColumn("shingles", _shingles("words"))
    short = [r["license"] for r in listed.where(F.size("shingles") == 0).select("license").collect()]  # the stated templates
    if short:
        raise ValueError(f"templates of fewer than {WORDS} words have no shingle to find: {short}")
    listed = listed.withColumn("step", F.expr("cast(pow(2, ceil(log2(size(shingles)))) as int)"))
    own = listed.select("step", "hashes").collect()  # the stated templates
    if not own:
        return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.lit("").alias("license"), F.lit(0.0).alias("containment")).where("false")
    known = lambda hs: F.array(*[F.lit(h) for h in sorted(hs)])
    steps = sorted({r["step"] for r in own})
    of_step = {s: {h for r in own if r["step"] == s for h in r["hashes"]} for s in steps}

    rows = texts(docs, id_col, text_col).select("doc_id", _words("text").alias("words"))
    rows = rows.withColumn("hashes", _hashes("words"))
    starts = []
    for s in steps:
        hits = F.filter(F.transform("hashes", lambda x, i: F.when(F.array_contains(known(of_step[s]), x), i)), lambda i: i.isNotNull())  # noqa: B023
        near = F.flatten(F.transform(hits, lambda i: F.array(F.floor(i / s).cast("int") * s, F.greatest(F.floor(i / s).cast("int") * s - s, F.lit(0)))))  # noqa: B023
        starts.append(F.transform(F.array_distinct(near), lambda a: F.struct(F.lit(s).alias("step"), a.alias("at"))))  # noqa: B023
    # outer: a filter on the arrays would be pushed down and compute them twice
    windows = rows.withColumn("w", F.explode_outer(F.concat(*starts))).where("w is not null").select(
        "doc_id",
        "w.step",
        F.expr(f"slice(words, w.at + 1, 2 * w.step + {WORDS - 1})").alias("words"),
        F.expr("slice(hashes, w.at + 1, 2 * w.step)").alias("hashes"),
    )
    # every window carries its shingles on, so nothing is joined back to the documents
    banded = windows.select("doc_id", "step", _shingles("words").alias("shingles"), F.explode_outer(_bands("hashes", bands)).alias("b"))
    banded = banded.select("doc_id", "step", "shingles", "b.band", "b.value")
    index = listed.select("license", "step", F.col("shingles").alias("wanted"), F.explode(_bands("hashes", bands)).alias("b"))
    index = index.select("license", "step", "wanted", "b.band", "b.value")
    found = banded.join(F.broadcast(index), ["step", "band", "value"])  # templates x bands rows
    share = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
    best = found.withColumn("containment", share).where(F.col("containment") >= containment)
    return best.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"))


def _oracle() -> str:
    values = ", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())
    shingle = " || ' ' || ".join(f"words[i + {k}]" for k in range(WORDS))
    return rf"""
WITH l(license, text) AS (VALUES {values}),
lw AS (SELECT license, regexp_extract_all(lower(text), '[a-z0-9]+') AS words FROM l),
ls AS (SELECT DISTINCT license, {shingle} AS s FROM (SELECT license, words, unnest(range(1, len(words) - 3)) AS i FROM lw)),
lm AS (SELECT license, count(*) AS m, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS step FROM ls GROUP BY license),
dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS words FROM documents),
ds AS (SELECT doc_id, i - 1 AS p, {shingle} AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM dw)),
hit AS (SELECT doc_id, license, m, step, p, s FROM ds JOIN ls USING (s) JOIN lm USING (license)),
win AS (SELECT doc_id, license, m, s, p // step * step - k * step AS pos FROM hit, (VALUES (0), (1)) AS v(k)),
share AS (SELECT doc_id, license, pos, count(DISTINCT s) / any_value(m) AS containment FROM win WHERE pos >= 0 GROUP BY doc_id, license, pos)
SELECT doc_id, license, max(containment) AS containment FROM share WHERE containment >= 0.8 GROUP BY doc_id, license
"""


@register("op2_license_scan", _oracle())
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
