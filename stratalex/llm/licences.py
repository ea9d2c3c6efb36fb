"""Licence scan in DataFrame functions only: TF-IDF cosine of headers and licence files to templates, then inheritance.

Texts are cut into units of three kinds: sentences of lines; windows of WINDOW consecutive lines, every STRIDE lines, as
headers are wrapped; and paragraphs between blank lines, the whole text if it has no blank line; however long they are. A
unit's term weights are tf * idf with idf counted over all documents, idf = ln((1 + N) / (1 + df)) + 1. A unit names the
template of the greatest cosine that is THRESHOLD or more. Only units with a cue term are weighed: a template's cue terms
are those that remain when the most common terms, together too light to reach the threshold, are taken away, so no unit that
could match is passed over. The norm of a unit is summed only if its products could reach the threshold, were all other terms
in every document. A notice that rights are reserved counts only where no licence is named.

A document whose matched sentences or paragraphs hold half of its words, or whose file name is that of a licence file, is a
licence file: it also covers its directory. A document without a licence of its own inherits from the nearest directory above it
that has a licence file; the directories are resolved once each, by joins of their ancestor paths, and written, so that a
join with a hot directory can be split.

Defined cases: a null or empty text has no licence of its own but may inherit; a null path has no directory; ties go to
the greater cosine, then the lesser licence name; equal rows give equal rows; an empty table gives an empty result; very
long texts are scanned whole; other columns are left aside.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import ascii_lower, cut, numbered, pick, position

THRESHOLD = 0.6
#: Lines of a window, lines from one to the next; neither characters of a line nor words of a paragraph are bounded.
WINDOW, STRIDE, LINE, PARAGRAPH = 6, 3, math.inf, math.inf
#: Terms that are broadcast when their documents are counted; more are joined by a shuffle.
BROADCAST_TERMS = 1 << 18
RESERVED = "Proprietary"
# Names of licences as notices write them.
NAMES = (
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("ISC", "ISC License"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("MIT", "MIT License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
)
# Headers, and sections of licence files.
SECTIONS = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    ("Apache-2.0", "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    (RESERVED, "All rights reserved"),
)
# How notices say a name or an identifier.
FORMS = ("Licensed under the {}", "Released under the {}", "This project is licensed under the {}", "This work is licensed under the {}", "This library is licensed under the {}", "Distributed under the {}", "{}")
TEMPLATES = (
    *((licence, form.format(name)) for licence, name in NAMES for form in FORMS),
    *((licence, f"SPDX-License-Identifier: {licence}") for licence in sorted({x for x, _ in (*NAMES, *SECTIONS)} - {RESERVED})),
    *SECTIONS,
)
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
WORD = r"[^a-z0-9]+"
UNIT = r"\n|(?<=[.!?;])[\x20\t]+"
BLANK = r"\n[\x20\t\r]*\n"


def terms(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD), "")


def _plain(text: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9]+", text.lower()) if t]


def weigh(templates, idf: dict[str, float], threshold: float) -> tuple[list[tuple[int, str, dict[str, float]]], set[str]]:
    """Unit vectors of the templates, and the cue terms that any unit of enough cosine must have."""
    out, cues = [], set()
    for k, (licence, text) in enumerate(templates):
        vector: dict[str, float] = {}
        for t in _plain(text):
            vector[t] = vector.get(t, 0.0) + idf[t]
        norm = math.sqrt(sum(v * v for v in vector.values()))
        vector = {t: v / norm for t, v in vector.items()}
        out.append((k, licence, vector))
        spare = 0.0
        for t in sorted(vector, key=lambda t: (idf[t], t)):
            spare += vector[t] ** 2
            if spare >= threshold**2 * (1 - 1e-9):
                cues.add(t)
    return out, cues


def units_of(body: Column, cues: Column) -> Column:
    """Units with a cue term: array<struct<kind, said>>; kind 0: sentences, 1: paragraphs, 2: windows."""
    said = lambda kind: lambda u: F.struct(F.lit(kind).alias("kind"), u.alias("said"))
    has_cue = lambda u: F.arrays_overlap(F.split(u, WORD), cues)
    lines = F.split(body, "\n")
    starts = F.when(F.size(lines) > 1, F.sequence(F.lit(1), F.size(lines), F.lit(STRIDE))).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda k: F.array_join(F.slice(lines, k, WINDOW), "\n"))
    paragraphs = F.split(body, BLANK)
    return F.concat(*[F.transform(F.filter(u, has_cue), said(kind)) for kind, u in enumerate((F.split(body, UNIT), paragraphs, windows))])


def _same(columns: list[str]) -> Column:
    """a's and b's columns are equal, nulls among them."""
    first, *others = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns]
    for o in others:
        first = first & o
    return first


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: Column | None = None, templates=TEMPLATES, threshold: float = THRESHOLD, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """doc_id, licence, cosine, origin (header, file, inherited or none) and directory (that of the licence file)."""
    at = [position(df, doc_id), position(df, text)]
    where = F.lit(None).cast("string") if path is None else path
    docs = numbered(df.select("*", where)).select(F.col(f"c{at[0]}").alias("doc_id"), F.col(f"c{at[1]}").alias("text"), F.col(f"c{len(df.columns)}").alias("path"))
    docs = docs.select("doc_id", "path", F.xxhash64("text", "path", F.col("text").isNull()).alias("h"), ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("body"))
    vocabulary = sorted({t for _, x in templates for t in _plain(x)})

    spark = df.sparkSession
    seen = docs.select(F.explode(F.array_intersect(F.concat(terms(F.col("body")), F.array(F.lit(""))), F.array(*[F.lit(t) for t in ["", *vocabulary]]))).alias("term")).groupBy("term").count()
    df_of = {r["term"]: r["count"] for r in seen.collect()}  # one entry for each template term, and the documents
    total = df_of.pop("", 0)
    idf = {t: math.log((1 + total) / (1 + df_of.get(t, 0))) + 1 for t in vocabulary}
    vectors, cues = weigh(templates, idf, threshold)

    marks = F.array(*[F.lit(t) for t in sorted(cues)])
    unit = ["doc_id", "h", "kind", "unit"]
    each = docs.where(F.arrays_overlap(F.split("body", WORD), marks)).select("doc_id", "h", F.size(terms(F.col("body"))).alias("n"), F.posexplode(units_of(F.col("body"), marks)).alias("unit", "of"))
    units = cut(each.select("doc_id", "h", "of.kind", "unit", "n", terms(F.col("of.said")).alias("said")), "units")

    # products with the templates, and a least norm: any other term weighs 1 at least
    met = units.select(*unit, "n", F.size("said").alias("said_words"), F.filter("said", lambda t: t.isin(vocabulary)).alias("met"))
    met = met.select(*unit, "n", "said_words", (F.col("said_words") - F.size("met")).alias("others"), F.explode("met").alias("term")).groupBy(*unit, "term").agg(F.count("*").alias("tf"), *[F.first(c).alias(c) for c in ("n", "said_words", "others")])
    known = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    # dealt by unit before the templates multiply its rows, so that these need no shuffle of their own
    met = cut(met.join(known, "term").withColumn("w", F.col("tf") * F.col("idf")), "template-terms").repartition(*unit)
    weights = F.broadcast(spark.createDataFrame([(t, k, v) for k, _, vector in vectors for t, v in vector.items()], "term string, template int, share double"))
    names = F.broadcast(spark.createDataFrame([(k, licence) for k, licence, _ in vectors], "template int, licence string"))
    dots = met.join(weights, "term").groupBy(*unit, "template").agg(F.sum(F.col("w") * F.col("share")).alias("dot")).join(names, "template")
    dots = dots.groupBy(*unit).agg(F.min(F.struct((-F.round("dot", 9)).alias("less"), "licence", "dot")).alias("top"))
    norms = met.groupBy(*unit).agg(F.sum(F.col("w") * F.col("w")).alias("square"), *[F.first(c).alias(c) for c in ("n", "said_words", "others")])
    likely = norms.alias("a").join(dots.alias("b"), _same(unit)).select("a.*", "top.licence", "top.dot").where(F.col("dot") * F.col("dot") >= (1 - 1e-9) * threshold**2 * (F.col("square") + F.col("others")))
    likely = cut(likely, "likely")

    # the whole norm of those that are left, with the documents of their other terms counted
    said = units.alias("a").join(likely.where("others > 0").select(*unit).alias("b"), _same(unit), "left_semi").select(*unit, F.explode("said").alias("term")).where(~F.col("term").isin(vocabulary))
    said = cut(said.groupBy(*unit, "term").agg(F.count("*").alias("tf")), "other-terms")
    rest = said.select("term").distinct()
    rest = F.broadcast(rest) if rest.count() <= broadcast_terms else rest
    counted = docs.select(F.explode(F.array_distinct(terms(F.col("body")))).alias("term")).join(rest, "term", "left_semi").groupBy("term").agg((F.log((F.lit(total) + 1.0) / (F.count("*") + 1.0)) + 1.0).alias("idf"))
    more = said.join(counted, "term").groupBy(*unit).agg(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).alias("more"))
    rank = F.struct((F.col("licence") == RESERVED).alias("reserved"), (-F.col("cosine")).alias("less"), "licence")
    matched = likely.alias("a").join(more.alias("b"), _same(unit), "left").select("a.*", "more")
    matched = matched.withColumn("cosine", F.round(F.col("dot") / F.sqrt(F.col("square") + F.coalesce("more", F.lit(0.0))), 9)).where(F.col("cosine") >= threshold)
    own = matched.groupBy("doc_id", "h").agg(F.min_by(F.struct("licence", "cosine"), rank).alias("best"), F.greatest(*[F.sum(F.when(F.col("kind") == k, F.col("said_words")).otherwise(0)) for k in (0, 1)]).alias("said"), F.first("n").alias("n"))
    own = cut(own.select(F.col("doc_id").alias("i"), F.col("h").alias("g"), "best.cosine", "best.licence", (F.col("said") * 2 >= F.col("n")).alias("mostly")), "licences")

    folder = F.when(F.instr("path", "/") > 0, F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).otherwise(F.when(F.col("path").isNotNull(), F.lit("")))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    placed = docs.select("doc_id", "h", folder.alias("folder"), name.alias("name"))
    judged = cut(placed.join(own, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")), "left").select("doc_id", "folder", "cosine", "licence", (F.col("licence").isNotNull() & (F.col("mostly") | F.coalesce(F.col("name").rlike(FILE_NAMES), F.lit(False)))).alias("is_file")), "judged")

    files = judged.where("is_file and folder is not null").groupBy("folder").agg(F.min_by(F.struct("licence", "cosine"), F.struct(-F.col("cosine"), "licence")).alias("of")).select(F.col("folder").alias("directory"), "of")
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    each = judged.where("folder is not null").select("folder").distinct().select("folder", F.explode(F.array_distinct(above)).alias("directory"))
    nearest = each.join(files, "directory").groupBy("folder").agg(F.max_by(F.struct("directory", "of"), F.length("directory")).alias("near")).select(F.col("folder").alias("f"), "near")
    nearest = cut(nearest, "nearest")
    out = judged.join(nearest, F.col("folder") == F.col("f"), "left")
    mine = F.col("licence").isNotNull()
    origin = F.when(mine & F.col("is_file"), "file").when(mine, "header").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return out.select("doc_id", F.coalesce("licence", "near.of.licence").alias("licence"), F.round(F.coalesce("cosine", "near.of.cosine"), 6).alias("cosine"), origin.alias("origin"), F.when(origin == "inherited", F.col("near.directory")).when(origin == "file", F.col("folder")).alias("directory"))
