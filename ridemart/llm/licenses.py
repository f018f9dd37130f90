"""License scans: MinHash bands of overlapping windows retrieve templates, containment verifies.

Texts and templates become shingles of five words; a template of fewer words is one shingle, and
texts get shingles of that length as well. Templates are grouped by length; for a group
of up to 2s shingles, windows of 3s shingles start every s, so that every passage as long as a
template lies within one window. A window's signature has one minimum for each of ``BANDS``
hash functions, and each is a band of its own: window and template are compared when they agree
in one. A window that holds 0.8 of a template's shingles has at least ``LEAST_JACCARD`` in
common with it, and misses all bands with a chance of (1 - LEAST_JACCARD)^BANDS, about one in
10^8. A pair is kept if the window really holds 0.8 of the template's distinct shingles.

A window that shares no shingle with any template cannot agree with one in a minimum, so texts
and windows without a shingle of any template take no part in the banding.

DataFrame functions only; texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm.common import stored

SHINGLE = 5
CONTAINED = 0.8
BANDS = 64
#: Of a template of over s and at most 2s shingles in a window of 3s: 0.8 s / (3s + 0.2 s).
LEAST_JACCARD = 0.25
#: Words of the templates scanned for at once; more are scanned for in several passes.
PASS_WORDS = 20_000

#: Notices by which works are put under a license.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "MIT-permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions",
    ),
    (
        "GPL-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "BSD-redistribution",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
]

#: Notices of fewer than five words.
SHORT_NOTICES = [("All-rights-reserved", "All rights reserved.")]

_GAP = r"[^\p{L}\p{N}]+"


def words_of(text: str | Column) -> Column:
    """Lower-cased runs of letters and digits; none for a null text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(F.coalesce(column, F.lit(""))), _GAP), "")


def shingles_of(words: str | Column, length: int = SHINGLE) -> Column:
    """Hashes of all runs of ``length`` words, in order; none for fewer words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    many = F.size(words) - length
    at = lambda h, i: F.xxhash64(*[F.get(h, i + k) for k in range(length)])
    # The hashes go into a one-element array so that the inner lambda refers to them by name.
    listed = F.transform(F.array(hashes), lambda h: F.transform(F.sequence(F.lit(0), many), lambda i: at(h, i)))
    return F.when(many >= 0, listed[0]).otherwise(F.array().cast("array<bigint>"))


def signature_of(shingles: Column, bands: int = BANDS) -> Column:
    """The least value of the shingles under each of ``bands`` hash functions."""
    seeds = F.sequence(F.lit(1), F.lit(bands))
    return F.transform(seeds, lambda seed: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, seed))))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """license, length of a shingle, parts (distinct shingles), step and signature; none without words."""
    rows = spark.createDataFrame(list(templates), "license string, text string")
    words = rows.select("license", words_of("text").alias("words")).withColumn("length", F.least(F.size("words"), F.lit(SHINGLE)))
    of_length = F.coalesce(*[F.when(F.col("length") == n, shingles_of("words", n)) for n in range(1, SHINGLE + 1)])
    parts = words.filter("length > 0").select("license", "length", F.array_distinct(of_length).alias("parts"))
    step = F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(F.size("parts"))) - 1, F.lit(0))).cast("int")
    return parts.withColumn("step", step).withColumn("signature", signature_of(F.col("parts")))


def windows(marked: DataFrame, step: int) -> DataFrame:
    """Windows of three steps that hold a hit: start (a word's number) and shingles.

    Windows start at multiples of the step, so a hit lies in three of them at most. Only these
    are cut out, and the whole text's shingles stay behind.
    """
    around = F.transform(
        "hits", lambda p: F.sequence(F.greatest(F.floor(p / step) - 2, F.lit(0)).cast("int"), F.floor(p / step).cast("int"))
    )
    cut = F.transform(
        F.array_distinct(F.flatten(around)),
        lambda i: F.struct((i * step).alias("start"), F.slice("shingles", i * step + 1, F.lit(3 * step)).alias("window")),
    )
    return marked.select("doc_id", F.inline(cut))


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = (*TEMPLATES, *SHORT_NOTICES),
    contained: float = CONTAINED,
    bands: int = BANDS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each document and template it holds: key, license, containment, start, windows.

    ``containment`` is the best of the document's windows, ``start`` the number of the word at
    which the first window of that containment begins, ``windows`` how many windows match. Null
    texts and texts without a match give no row; rows with the same key are reported
    together, those with a null key under null. Equal templates under different names are all
    reported. Other columns are not read.
    """
    spark = docs.sparkSession
    passes, words = [[]], 0
    for template in templates:
        words += len(template[1].split())
        if words > PASS_WORDS and passes[-1]:
            passes.append([])
            words = len(template[1].split())
        passes[-1].append(template)
    found = None
    for group in passes:
        matches = _scan(docs, template_table(spark, group), contained, bands, key, text)
        found = matches if found is None else found.union(matches)
    best = F.min(F.struct((-F.col("containment")).alias("less"), F.col("start").alias("start")))
    return (
        found.groupBy("doc_id", "license")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("windows"))
        .select(F.col("doc_id").alias(key), "license", (-F.col("best.less")).alias("containment"), "best.start", "windows")
    )


def _scan(docs: DataFrame, table: DataFrame, contained: float, bands: int, key: str, text: str) -> DataFrame:
    known = stored(table, "license_templates")
    summary = known.agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("parts")))).alias("parts"), F.sort_array(F.collect_set("step")).alias("steps"),
        F.sort_array(F.collect_set("length")).alias("lengths"),
    ).first()  # bounded by PASS_WORDS
    anything = F.lit(summary["parts"] or []).cast("array<bigint>")
    # A generated row holds words and shingles once; otherwise the filter below would be rewritten
    # in terms of the text and split it again for every use.
    words = docs.select(F.col(key).alias("doc_id"), F.explode(F.array(words_of(text))).alias("words"))
    # One row for each length of shingles; shingles of different lengths have different hashes.
    of_lengths = [shingles_of("words", n) for n in summary["lengths"] or [SHINGLE]]
    hashed = words.select("doc_id", F.explode(F.array(*of_lengths)).alias("shingles"))
    held = hashed.withColumn("found", F.array_intersect("shingles", anything)).filter("size(found) > 0")
    # Few texts hold a shingle of a template; written once, they serve every window length.
    candidates = stored(held, "license_candidates")
    hit = lambda x, i: F.when(F.array_contains("found", x), i)
    hits = F.filter(F.transform("shingles", hit), lambda i: i.isNotNull())
    marked = candidates.select("doc_id", "shingles", hits.alias("hits"))
    out = None
    for step in summary["steps"] or [1]:
        held = windows(marked, step).withColumn("mine", signature_of(F.col("window"), bands))
        banded = held.select("*", F.posexplode("mine").alias("band", "least"))
        bounded = F.broadcast(  # at most bands rows for each template of the pass
            known.filter(F.col("step") == step).select("license", "parts", "signature", F.posexplode("signature").alias("band", "least"))
        )
        first = F.array_position(F.zip_with("mine", "signature", lambda a, b: a == b), True) == F.col("band") + 1
        share = F.size(F.array_intersect("window", "parts")) / F.size("parts")
        matched = (
            banded.join(bounded, ["band", "least"])
            .filter(first)  # once for each pair, however many bands agree
            .select("doc_id", "license", "start", share.alias("containment"))
            .filter(F.col("containment") >= contained)
        )
        out = matched if out is None else out.union(matched)
    return out


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op10: the licenses of all documents."""
    return scan(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))


def _oracle(templates: Sequence[tuple[str, str]], length: int) -> str:
    quoted = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in templates)
    run = " || ' ' || ".join(f"w[i+{k + 1}]" for k in range(length))
    shingles = f"CASE WHEN len(w) >= {length} THEN list_transform(range(0, len(w) - {length - 1}), lambda i: {run}) ELSE [] END"
    split = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH named(license, text) AS (VALUES {quoted}),
parts AS (SELECT license, list_distinct({shingles}) AS parts FROM (SELECT license, {split} AS w FROM named)),
templates AS (
  SELECT *, (2 ** greatest(ceil(log2(len(parts))) - 1, 0))::INTEGER AS step FROM parts WHERE len(parts) > 0
),
marked AS (
  SELECT * FROM (SELECT doc_id, {shingles} AS s FROM (SELECT doc_id, {split} AS w FROM documents))
  WHERE list_has_any(s, (SELECT flatten(list(parts)) FROM templates))
),
cut AS (
  SELECT doc_id, step, start, s[start + 1 : start + 3 * step] AS part
  FROM (SELECT doc_id, s, step, unnest(range(0, len(s), step)) AS start
        FROM marked CROSS JOIN (SELECT DISTINCT step FROM templates))
),
held AS (
  SELECT doc_id, license, start, len(list_intersect(list_distinct(part), parts)) / len(parts) AS containment
  FROM cut JOIN templates USING (step)
)
SELECT doc_id, license, max(containment)::DOUBLE AS containment, arg_max(start, (containment, -start))::INTEGER AS start,
       count(*) AS windows
FROM held WHERE containment >= {CONTAINED} GROUP BY ALL
"""


ORACLE = f"SELECT * FROM ({_oracle(TEMPLATES, SHINGLE)}) UNION ALL SELECT * FROM ({_oracle(SHORT_NOTICES, 3)})"
