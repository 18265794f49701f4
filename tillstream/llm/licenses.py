"""License notices in texts: MinHash bands retrieve templates for text windows, exact shingle containment
verifies them. DataFrame functions only.

For a template of n shingles, windows of 1.5 n shingles start every n/4 shingles, so an occurrence that edits
have stretched by a quarter lies within one of them. A window that contains the least share of the
template then has a Jaccard similarity of at least 0.8 n / 1.7 n = 0.47 with it, and 32 bands of two hashes
miss it with probability (1 - 0.47^2)^32 < 0.0005. Windows that hold fewer shingles of any template of
that length than the least share asks for cannot match and are not hashed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.registry import normal_words, query, table

#: words of a shingle; short notices have few words
WORDS = 3
#: least share of a template's shingles in a window
CONTAINMENT = 0.8
BANDS = 32
#: shingles of all templates that may be sent along with every task
MOST_SHINGLES = 200_000

# The wording of public license notices.
TEMPLATES = {
    "MIT-line": "Released under the MIT License",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "LGPL-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(list((templates or TEMPLATES).items()), "license string, text string")


def held(value: Column, name: str, rows: DataFrame) -> DataFrame:
    """Adds a column that is computed once, though lambdas read it many times."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def shingled(rows: DataFrame) -> DataFrame:
    """Adds `shingles`, the hash of every run of WORDS words in order. A text without words has none."""
    rows = held(F.split(normal_words(F.col("text")), " "), "words", rows)
    runs = F.sequence(F.lit(0), F.size("words") - WORDS)
    hashes = F.transform(runs, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WORDS)]))
    none = F.array().cast("array<bigint>")
    return held(F.when(F.size("words") >= WORDS, hashes).otherwise(none), "shingles", rows).drop("words")


def band_keys(shingles: Column) -> Column:
    """Keys of BANDS bands, each of the least of two different hashes over a set of shingles."""

    def least(number: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, number)))

    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(least(b * 2), least(b * 2 + 1), b))


def license_matches(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and license found in it: doc_id, license, containment (the largest share of the
    template's distinct shingles in one window) and at_word (the first word of the first such window).

    Words are runs of letters and digits in lower case. Null and empty texts have no license; a template of
    fewer than WORDS words matches nothing. Rows that share a doc_id are taken together. Other columns are
    ignored. The templates must have MOST_SHINGLES shingles or fewer, as every task gets them all.
    """
    known = shingled(templates.select("license", "text")).select("license", F.array_distinct("shingles").alias("template"))
    known = known.where(F.size("template") > 0).select("license", "template", F.size("template").alias("n"), band_keys(F.col("template")).alias("bands"))
    found = known.collect()
    if sum(r["n"] for r in found) > MOST_SHINGLES:
        raise ValueError(f"the templates have more than {MOST_SHINGLES} shingles")
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, license string, containment double, at_word int")
    sizes: dict[int, set[int]] = {}
    for r in found:
        for h in r["template"]:
            sizes.setdefault(h, set()).add(r["n"])
    # What each window length asks for.
    kinds = []
    for n in sorted({r["n"] for r in found}):
        stride, wide = max(1, n // 4), math.ceil(1.25 * n)
        kinds.append(F.struct(F.lit(n).alias("n"), F.lit(stride).alias("stride"), F.lit(wide + stride).alias("wide"), F.lit(math.ceil(containment * n - 1e-9)).alias("need")))
    lengths = F.create_map(*[x for h, ns in sizes.items() for x in (F.lit(h), F.array(*[F.lit(n) for n in sorted(ns)]))])

    rows = shingled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "shingles")
    places = F.transform("shingles", lambda h, i: F.struct(i.alias("i"), h.alias("h")))
    rows = held(F.filter(places, lambda x: x["h"].isin(list(sizes))), "hits", rows).where(F.size("hits") > 0)
    rows = rows.select("doc_id", "shingles", held_lengths(lengths).alias("hits"))
    rows = rows.select("*", F.explode(F.array(*kinds)).alias("kind"))
    of_kind = F.transform(F.filter("hits", lambda x: F.array_contains(x["n"], F.col("kind.n"))), lambda x: x["i"])
    rows = held(of_kind, "at", rows.where(F.size("hits") >= F.col("kind.need"))).drop("hits").where(F.size("at") >= F.col("kind.need"))
    stride, wide = F.col("kind.stride"), F.col("kind.wide")

    def windows_over(i: Column) -> Column:
        last = F.floor(i / stride).cast("int")
        return F.transform(F.sequence(F.greatest(F.lit(0), last - F.ceil(wide / stride).cast("int") + 1), last), lambda k: k * stride)

    starts = F.array_distinct(F.flatten(F.transform("at", windows_over)))
    enough = F.filter(starts, lambda s: F.size(F.filter("at", lambda i: (i >= s) & (i < s + wide))) >= F.col("kind.need"))
    rows = rows.select("doc_id", F.col("kind.n").alias("n"), "shingles", F.col("kind.wide").alias("wide"), F.explode(enough).alias("start"))
    rows = held(F.array_distinct(F.slice("shingles", F.col("start") + 1, F.col("wide"))), "window", rows).drop("shingles", "wide")
    banded = rows.select("doc_id", "n", "start", "window", F.explode(band_keys(F.col("window"))).alias("band"))

    held_templates = docs.sparkSession.createDataFrame([(r["license"], r["n"], r["template"], b) for r in found for b in r["bands"]], "license string, n int, template array<bigint>, band bigint")
    met = banded.join(F.broadcast(held_templates), ["n", "band"])
    share = F.size(F.array_intersect("template", "window")) / F.col("n")
    met = met.select("doc_id", "license", "start", share.alias("containment")).where(F.col("containment") >= containment - 1e-9)
    return met.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min("start").alias("at_word"))


def held_lengths(lengths: Column) -> Column:
    """Each hit with the template lengths it belongs to."""
    return F.transform("hits", lambda x: F.struct(x["i"].alias("i"), F.element_at(lengths, x["h"]).alias("n")))


@query("op5_license_scan")
def op5_license_scan(spark, sf_dir):
    """License notices in every document."""
    return license_matches(table(spark, sf_dir, "documents"), template_table(spark))
