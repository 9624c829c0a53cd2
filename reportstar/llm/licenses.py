"""License notices in texts: MinHash bands over overlapping windows, then exact containment. DataFrames only.

A text and a template are sequences of lower-cased words, taken as shingles of ``WORDS`` words. A template of ``n``
shingles belongs to the size ``S``, the power of two with ``S / 2 < n <= S`` (``LEAST`` at least); texts are looked at in
windows of ``2 S`` shingles every ``S``, so that a notice lies in one window as a whole. Windows without any shingle of a
template contain nothing of it and are not signed. Of the others, ``BANDS`` MinHash values of one row each retrieve
the templates that share one: at containment 0.8 the likeness of window and template is above 0.17, and a
template of four shingles or more is retrieved with probability above 0.99; a whole notice of ``S`` shingles in a
full window has a likeness of a half and is missed once in 10**9. Candidates are verified by the exact
share of the template's shingles, as words, in the window.

A template of fewer words than a shingle, ``LEAST_WORDS`` at least, is contained where all its words follow each other;
``first_word`` is then the place of its first word. Shorter ones are refused.

The templates are a parameter and therefore bounded; they are broadcast. Null and empty texts, and texts of
fewer words than a template's shingle, contain nothing. Repeated rows are reported each, a notice once per row and license, with
its first best window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.llm.common import let

WORDS = 5
CONTAINMENT = 0.8
BANDS = 32
LEAST = 4
LEAST_WORDS = 3

# Public license notices: fixed values.
LONG_TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "BSD-clauses": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

# Short notices and identifiers: fixed values.
SHORT_TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "SPDX-Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX-BSD-3-Clause": "SPDX-License-Identifier: BSD-3-Clause",
    "SPDX-GPL-3.0-only": "SPDX-License-Identifier: GPL-3.0-only",
    "SPDX-MIT": "SPDX-License-Identifier: MIT",
}
TEMPLATES = LONG_TEMPLATES | SHORT_TEMPLATES


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def shingle_hashes(w: Column) -> Column:
    """Hash of every shingle of a word array; NULL below ``WORDS`` words."""
    starts = F.sequence(F.lit(1), F.size(w) - (WORDS - 1))
    return F.when(F.size(w) >= WORDS, F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(WORDS)))))


def shingle_texts(w: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(w) - (WORDS - 1))
    texts = F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, F.lit(WORDS)), " ")))
    return F.when(F.size(w) >= WORDS, texts)


def bands(h: Column) -> Column:
    """``BANDS`` MinHash values of a hash array."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform(h, lambda x: F.xxhash64(x, b))))


def template_table(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """License, size, hashes, shingles and bands of each template."""
    notices = F.array(*(F.struct(F.lit(k).alias("license"), F.lit(v).alias("notice")) for k, v in sorted(templates.items())))
    rows = docs.sparkSession.range(1).select(F.inline(notices))
    rows = rows.withColumn("w", words(F.col("notice"))).withColumn("h", shingle_hashes(F.col("w")))
    size = F.greatest(F.lit(LEAST), F.pow(F.lit(2.0), F.ceil(F.log2(F.size("h").cast("double")))).cast("int"))
    return rows.select("license", "w", size.alias("size"), "h", shingle_texts(F.col("w")).alias("shingles"), bands(F.col("h")).alias("bands"))


def hit_places(h: Column, wanted: list[int]) -> Column:
    """Positions of a hash array that hold one of the ``wanted`` hashes."""
    return F.filter(F.transform(h, lambda x, i: F.when(x.isin(wanted), i)), lambda i: i.isNotNull())


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, license, containment, first_word`` for each row and license that it contains."""
    templates = TEMPLATES if templates is None else templates
    table = template_table(docs, templates)
    known = table.select("license", "w", "size", "h", "shingles", "bands").collect()  # as many rows as templates
    if any(len(t.w) < LEAST_WORDS for t in known):
        raise ValueError(f"templates need at least {LEAST_WORDS} words")
    short = {t.license: " ".join(t.w) for t in known if t.h is None}
    known = [t for t in known if t.h is not None]
    if not short:
        return scan_shingles(docs, table, known)
    found = scan_short(docs, short)
    return scan_shingles(docs, table.filter(F.col("h").isNotNull()), known).union(found) if known else found


def scan_short(docs: DataFrame, notices: dict[str, str]) -> DataFrame:
    """``scan_licenses`` for notices given as their words with single spaces."""

    def places(text: Column) -> Column:
        def place(name: str, notice: str) -> Column:
            at = F.instr(text, f" {notice} ")
            first = (F.size(F.split(F.substring(text, F.lit(1), at), " ", -1)) - 2).cast("long")
            return F.when(at > 0, F.struct(F.lit(name).alias("license"), F.lit(1.0).alias("containment"), first.alias("first_word")))

        return F.filter(F.array(*(place(*n) for n in sorted(notices.items()))), lambda x: x.isNotNull())

    text = F.concat(F.lit(" "), F.array_join(words(F.col("text")), " "), F.lit(" "))
    return docs.select("doc_id", F.inline(let(text, places)))


def scan_shingles(docs: DataFrame, table: DataFrame, known: list) -> DataFrame:
    """``scan_licenses`` for templates of ``WORDS`` words or more; ``known`` are the rows of ``table``."""
    wanted = sorted({x for t in known for x in t.h})
    # Words, hashes and hits come from one expression beside the row number: a filter on the hits
    # can't be pushed below a projection that numbers rows, so each is computed once per text.
    found = let(words(F.col("text")), lambda w: let(shingle_hashes(w), lambda h: F.struct(w.alias("w"), h.alias("h"), hit_places(h, wanted).alias("hits"))))
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), found.alias("f"))
    hit = texts.filter(F.size("f.hits") > 0).select("doc_id", "row", "f.w", "f.h", "f.hits")
    sizes = F.array(*(F.lit(s) for s in sorted({t["size"] for t in known})))

    def windows(s: Column) -> Column:
        numbers = F.flatten(F.transform("hits", lambda p: F.array((p / s).cast("int"), (p / s).cast("int") - 1)))
        return F.transform(F.filter(F.array_distinct(numbers), lambda n: n >= 0), lambda n: F.struct(s.alias("size"), (n * s).alias("start")))

    cut = hit.withColumn("window", F.explode(F.flatten(F.transform(sizes, windows))))
    cut = cut.select(
        "doc_id", "row", F.col("window.size").alias("size"), F.col("window.start").alias("start"),
        F.slice("h", F.col("window.start") + 1, 2 * F.col("window.size")).alias("h"),
        F.slice("w", F.col("window.start") + 1, 2 * F.col("window.size") + (WORDS - 1)).alias("w"),
    )
    signed = cut.withColumn("bands", bands(F.col("h"))).drop("h")
    keyed = signed.select("doc_id", "row", "size", "start", "w", F.posexplode("bands").alias("band", "value"))
    index = table.select("license", "size", "shingles", F.posexplode("bands").alias("band", "value"))
    met = keyed.join(F.broadcast(index), ["size", "band", "value"])
    share = F.size(F.array_intersect(shingle_texts(F.col("w")), F.col("shingles"))) / F.size("shingles")
    sure = met.withColumn("containment", share).filter(F.col("containment") >= CONTAINMENT)
    best = sure.groupBy("row", "license").agg(F.any_value("doc_id").alias("doc_id"), F.max("containment").alias("containment"), F.max_by("start", F.struct("containment", -F.col("start"))).alias("first_word"))
    return best.select("doc_id", "license", "containment", F.col("first_word").cast("long").alias("first_word"))
