"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

A text's words (lower-case runs of letters and digits) give its word pairs. A window starts at each
``STEP``-th pair and has twice as many, so that windows overlap by half. The bands of a window are
the ``BANDS`` smallest hashes of its pairs, the MinHash of its set by one hash function, each a band
of its own. Templates are cut in the same way, and each band of a template's windows is an index
entry. Where a text holds a template whose pairs fit a window, some window holds them all; it has
at most ``2 * STEP`` pairs, so that with ``BANDS > 2 * STEP - t`` bands the smallest of the
template's ``t`` pairs is among them: found for certain from four pairs (five words) on with these
settings. Shorter templates are looked up by all pairs of a window. Windows of longer templates overlap some window of the text by six of eight pairs or more,
and there are several of them.

A template found by a window is verified on the words around the window: the share of the
template's word pairs that occur there, exactly counted, must reach ``CONTAINED``.

All of it is row by row in DataFrame functions: no shuffle, and no text moves. The templates are a
parameter; they are part of the plan, so they are meant to be some hundreds of short texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of

STEP = 4
BANDS = 5
CONTAINED = 0.8

# Short notices of common licenses, by SPDX name ("Proprietary" where rights are kept).
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-NC-ND-4.0": "CC BY-NC-ND 4.0",
    "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0",
    "CC-BY-ND-4.0": "CC BY-ND 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0": "CC0 1.0 Universal",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
    "Proprietary": "All rights reserved",
}

_GNU = "under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
_CC = "Creative Commons Attribution-{} 4.0 International"

# Further wordings, and passages by which license bodies are known: titles, grants and conditions.
# "BSD" is what the 2-clause and the 3-clause body have in common.
PASSAGES = [
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", _GNU.format("Affero General Public License", 3)),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    (
        "Apache-2.0",
        "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, "
        "irrevocable copyright license to reproduce, prepare Derivative Works of",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and"),
    (
        "BSD-3-Clause",
        "nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
    ),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-NC-4.0", _CC.format("NonCommercial")),
    ("CC-BY-NC-ND-4.0", _CC.format("NonCommercial-NoDerivatives")),
    ("CC-BY-NC-SA-4.0", _CC.format("NonCommercial-ShareAlike")),
    ("CC-BY-ND-4.0", _CC.format("NoDerivatives")),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", _GNU.format("General Public License", 2)),
    ("GPL-2.0", "The licenses for most software are designed to take away your freedom to share and change it"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", _GNU.format("General Public License", 3)),
    (
        "GPL-3.0",
        "The licenses for most software and other practical works are designed to take away your freedom to share "
        "and change the works",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", 2.1)),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", 3)),
    ("MIT", "under the MIT License"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
    ),
    (
        "MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software",
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Proprietary", "No part of this work may be reproduced without permission"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]

Keys = list[tuple[str, list[int], list[int]]]  # of each template: name, index entries, word pairs


def words_of(text: str | Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text_of(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _pairs(words: str) -> Column:
    """Hash of each two neighbouring words; of a single word, its own."""
    n = F.size(words)
    return (
        F.when(n < 1, F.array().cast("array<bigint>"))
        .when(n < 2, F.array(F.xxhash64(F.get(words, F.lit(0)))))
        .otherwise(
            F.zip_with(
                F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b)
            )
        )
    )


def _bands(pairs: str, blocks: str) -> Column:
    """The bands of each window."""

    def of(i: Column) -> Column:
        window = F.array_distinct(F.slice(pairs, i * STEP + 1, F.lit(2 * STEP)))
        return F.slice(F.sort_array(window), F.lit(1), F.lit(BANDS))

    return F.transform(blocks, of)


def _indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``words``, ``pairs``, ``blocks`` (window numbers) and ``bands`` of their ``text``."""
    rows = rows.withColumn("words", words_of("text"))
    rows = rows.withColumn("pairs", _pairs("words"))
    some = F.sequence(F.lit(0), F.floor((F.size("pairs") - 1) / STEP).cast("int"))
    rows = rows.withColumn("blocks", F.when(F.size("pairs") > 0, some).otherwise(F.array().cast("array<int>")))
    return rows.withColumn("bands", _bands("pairs", "blocks"))


def template_keys(spark: SparkSession, templates: list[tuple[str, str]]) -> Keys:
    """Index entries and word pairs of each template, made by the expressions that documents get."""
    rows = spark.createDataFrame(sorted(templates), "name string, text string")
    keys = F.array_distinct(F.flatten("bands")).alias("keys")
    found = _indexed(rows).select("name", keys, F.array_distinct("pairs").alias("pairs"))
    return [(r["name"], r["keys"], r["pairs"]) for r in found.collect() if r["pairs"]]


def _short(pairs: list[int]) -> bool:
    """Whether a window can hold a template without a pair of it among the window's bands."""
    return BANDS <= 2 * STEP - len(pairs)


def _literals(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _met(items: Column, entries: list[int], name: str) -> Column:
    """The index entries among ``items``."""
    none = F.array().cast("array<bigint>")
    return (F.array_intersect(items, _literals(entries)) if entries else none).alias(name)


def _verified(name: str, keys: list[int], pairs: list[int]) -> Column:
    """Matches of one template, ``at, license, share, pairs``: every window that holds enough."""

    def meets(w: Column) -> Column:
        window = F.slice("pairs", w * STEP + 1, F.lit(2 * STEP)) if _short(pairs) else F.get("bands", w)
        return F.arrays_overlap(window, _literals(pairs if _short(pairs) else keys))

    some = F.arrays_overlap(F.col("few"), _literals(pairs)) if _short(pairs) else F.arrays_overlap(F.col("keys"), _literals(keys))
    hit = F.filter("blocks", meets)
    margin = len(pairs)

    def share(w: Column) -> Column:
        start = F.greatest(w * STEP - margin, F.lit(0))
        around = F.slice("pairs", start + 1, F.lit(2 * STEP + 2 * margin))
        held = F.size(F.array_intersect(around, _literals(pairs)))
        return F.struct((held / F.lit(float(len(pairs)))).alias("share"), w.alias("at"))

    enough = F.filter(F.transform(hit, share), lambda w: w["share"] >= CONTAINED)
    matches = F.transform(
        enough,
        lambda w: F.struct(
            (w["at"] * STEP).alias("at"), F.lit(name).alias("license"), w["share"].alias("share"), F.lit(margin).alias("pairs")
        ),
    )
    return F.when(some, matches)


def _best_at_place(matches: Column, near: int) -> Column:
    """Matches without those that another license at the same place beats, one for each occurrence.

    Windows of one license within two windows or the template's length of a larger share are the same
    occurrence; of equal shares the first counts, and later ones hang on to their neighbours before.
    ``matches`` are sorted by place, and no more than ``near`` on either side can be at the same place,
    so that long texts of many notices take linear time.
    """

    def without(of: Column, rule: Callable[[Column, Column], Column]) -> Column:
        def beaten(e: Column, i: Column) -> Column:
            return F.exists(F.slice(of, F.greatest(i - near, F.lit(0)) + 1, F.lit(2 * near + 1)), lambda o: rule(e, o))

        return F.filter(of, lambda e, i: ~beaten(e, i))

    def other(e: Column, o: Column) -> Column:
        return (F.abs(o["at"] - e["at"]) <= 2 * STEP) & (o["share"] > e["share"]) & (o["license"] != e["license"])

    def same(e: Column, o: Column) -> Column:
        reach = F.greatest(o["pairs"], e["pairs"], F.lit(2 * STEP))
        first = (o["share"] > e["share"]) | ((o["share"] == e["share"]) & (o["at"] < e["at"]))
        return (o["license"] == e["license"]) & (F.abs(o["at"] - e["at"]) <= reach) & first

    # Each step reads a list that is made once.
    kept = F.transform(F.array(F.sort_array(matches)), lambda m: without(m, other))
    kept = F.transform(kept, lambda m: without(m, same))[0]
    named = ("license", "at", "share")
    return F.array_distinct(F.transform(kept, lambda e: F.struct(*(e[k].alias(k) for k in named))))


def scan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """``id, licenses, evidence`` of each row, null and repeated ids included.

    ``licenses`` are the names of the templates that the text contains, sorted; ``evidence`` has
    for each occurrence its name, the first word of its best window, and the share of word pairs held.
    Of templates found at one place, the one with the largest share counts. Null, empty and wordless
    texts have none.
    """
    texts = [*TEMPLATES.items(), *PASSAGES] if templates is None else list(templates.items())
    known = template_keys(docs.sparkSession, texts)
    rows = _indexed(docs.select(docs[id].alias("id"), text_of(docs[text]).alias("text")))
    every = sorted({k for _, keys, pairs in known if not _short(pairs) for k in keys})
    short = sorted({k for _, _, pairs in known if _short(pairs) for k in pairs})
    none = F.array().cast("array<struct<at:int,license:string,share:double,pairs:int>>")
    longest = max([2 * STEP, *(len(pairs) for _, _, pairs in known)])
    near = (longest // STEP + 1) * max(len(known), 1)
    # Most texts meet no entry of the index. Of the rest, the windows that meet one are held against
    # the templates that have one of the entries met.
    rows = rows.select("id", "pairs", "blocks", "bands", _met(F.flatten("bands"), every, "keys"), _met(F.col("pairs"), short, "few"))
    window = lambda w: F.slice("pairs", w * STEP + 1, F.lit(2 * STEP))
    hot = F.filter("blocks", lambda w: F.arrays_overlap(F.get("bands", w), F.col("keys")) | F.arrays_overlap(window(w), F.col("few")))
    met = (F.size("keys") > 0) | (F.size("few") > 0)
    none_hot = F.array().cast("array<int>")
    rows = rows.select("id", "pairs", "bands", "keys", "few", F.when(met, hot).otherwise(none_hot).alias("blocks"), met.alias("met"))
    if known:
        found = F.concat(*(F.coalesce(_verified(*x), none) for x in known))
        rows = rows.select("id", F.when(F.col("met"), found).otherwise(none).alias("matches"))
    else:
        rows = rows.select("id", none.alias("matches"))
    rows = rows.select("id", _best_at_place(F.col("matches"), near).alias("evidence"))
    names = F.array_sort(F.array_distinct(F.transform("evidence", lambda e: e["license"])))
    return rows.select(F.col("id").alias(id), names.alias("licenses"), "evidence")
