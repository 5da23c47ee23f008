"""Licence scans (operator 9): a trained paragraph classifier, all on the JVM.

Paragraphs are the lines of a text, and blocks of up to ``BLOCK`` lines joined
(from the first line after a blank one, and from every fourth line; never over a
blank line), so wrapped notices are seen whole. Words and word pairs are hashed into
a sparse binary vector (``HashingTF``); a multinomial logistic regression tells the
licence families and one *unknown* class apart. It learns from the templates below
and cut or framed forms of them, from ordinary sentences that use the same words,
and from a bounded background sample of the table (``BACKGROUND`` paragraphs by a
hash threshold; those that share half of their words with a template left out).
The unknown class is calibrated on wordings and background that training does not
see: a family needs more probability than 99.5 % of the held-out others reach,
and at least ``min_probability``.

A prediction only counts if a template of the family confirms it: the paragraph
holds one of the ``KEYS`` and at least ``confirm`` of the template's words. So
texts and paragraphs without any key are left out before they are cut into words;
this drops nothing that could be found.

Result: one row per document row and family: the best confirmed paragraph (by
overlap, the shorter one, the first one) and the number of confirmed ones. No shuffle of
texts: cutting, scoring and confirming are narrow, only findings are grouped.

Defined cases: null, empty and blank texts have no paragraphs; repeated rows
have findings of their own; a null doc_id stays null; ties go to the first line;
an empty table gives an empty result; other columns never matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stage

BACKGROUND, BLOCK, STRIDE = 4000, 10, 4

# What a licence notice holds at least one of (in lower case).
KEYS = ("licens", "licenc", "copyright", "permission", "redistribut", "warrant", "public domain", "spdx", "gpl", "cc0",
        "cc by", "creative commons")

# Names of well-known public licences, and sentences of their texts, by family.
NAMES: dict[str, list[str]] = {
    "MIT": ["MIT", "MIT/X11", "Expat"],
    "Apache-2.0": ["Apache", "Apache 2", "Apache, Version 2.0", "Apache-2.0"],
    "GPL": ["GPL", "GPLv3", "GPL-3.0-or-later", "GNU GPL", "GNU General Public"],
    "LGPL": ["LGPL", "LGPLv2.1", "LGPL-3.0-only", "GNU LGPL", "GNU Lesser General Public", "GNU Library General Public"],
    "AGPL": ["AGPL", "AGPLv3", "AGPL-3.0-or-later", "GNU Affero General Public"],
    "BSD": ["BSD", "BSD 2-Clause", "BSD-3-Clause", "Simplified BSD", "New BSD"],
    "MPL": ["MPL", "MPL-2.0", "Mozilla Public"],
    "EPL": ["EPL", "EPL-2.0", "Eclipse Public"],
    "ISC": ["ISC"],
    "Unlicense": ["Unlicense"],
    "CC0": ["CC0", "CC0 1.0 Universal"],
    "CC": ["CC BY 4.0", "CC BY-SA 4.0", "CC BY-NC 4.0", "CC BY-ND 4.0", "Creative Commons Attribution",
           "Creative Commons Attribution-ShareAlike 4.0 International"],
    "Zlib": ["zlib", "zlib/libpng"],
    "BSL-1.0": ["Boost Software", "BSL-1.0"],
}
SENTENCES = ("{} License", "{} licensed", "Licensed under {}.", "Licensed under the {} License.", "Released under the {} License.",
             "This software is distributed under the terms of the {} License.", "SPDX-License-Identifier: {}")
TEXTS: dict[str, list[str]] = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. For more information, please refer to unlicense.org",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. This work is dedicated to the public domain under CC0.",
        "No Copyright: the person who associated a work with this deed has dedicated the work to the public domain by waiving all rights (CC0 1.0 Universal Public Domain Dedication).",
    ],
    "CC": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc-sa/4.0/",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software",
    ],
}
# Ordinary sentences with the same words; every second one only calibrates.
OTHERS = (
    "He lost his driving licence after the accident.", "The fishing license costs ten dollars a year.",
    "She studied physics at MIT before moving to Boston.", "The Apache helicopter landed near the village.",
    "With the permission of the owner we crossed the field.", "Please ask for permission before you take pictures.",
    "The warranty covers all parts for two years.", "There is no warranty on used cars.", "Copyright law protects authors and composers.",
    "All rights reserved by the publisher.", "The songs of that time are in the public domain.", "The land was public domain until the war.",
    "A general public meeting will be held on Monday.", "The council gave planning permission for the house.",
    "The eclipse was seen by the public from the hill.", "Plans to redistribute wealth were rejected by parliament.",
    "The taxi license office is closed on Sundays.", "We license our images to newspapers.", "The dealer offered a warranty on the engine.",
    "Copyright infringement is a matter for the courts.", "Boost your software sales with our license manager.",
    "The common creative work of the team won a prize.", "You may obtain a copy of the map at the office.", "Commercial use of the hall requires a licence from the city.",
)
FAMILIES = ["unknown", *NAMES]


def templates(family: str) -> list[str]:
    return [s.format(n) for n in NAMES[family] for s in SENTENCES] + TEXTS[family]


def tokens(text: Column) -> Column:
    """Lower-cased letter runs; every number becomes ``0``; all forms of
    *license* are one word."""
    plain = F.regexp_replace(F.lower(text), "[0-9]+", "0")
    plain = F.regexp_replace(plain, "\\blicen[cs](e|es|ed|ing)\\b", "license")
    return F.filter(F.split(plain, "[^\\p{L}0]+"), lambda w: w != "")


def grams(ws: Column) -> Column:
    return F.concat(ws, F.zip_with(ws, F.slice(ws, F.lit(2), F.greatest(F.size(ws), F.lit(1))),
                                   lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)).otherwise(a)))


def has_key(text: Column) -> Column:
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [low.contains(k) for k in KEYS])


def _template_words(spark) -> list[tuple[str, list[str]]]:
    rows = [(fam, t) for fam in NAMES for t in templates(fam)]
    df = spark.createDataFrame(rows, "family string, line string")
    found = {(r["family"], tuple(sorted(r["w"]))) for r in
             df.select("family", F.array_distinct(tokens(F.col("line"))).alias("w")).collect()}
    return sorted((f, list(w)) for f, w in found if len(w) > 1 or f in ("CC0", "Unlicense"))


def _overlap(ws: Column, template: list[str]) -> Column:
    return F.size(F.array_intersect(ws, F.array(*map(F.lit, template)))) / F.lit(float(len(template)))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, row, paragraph (number of its first line, from 0), text of the lines
    and joined blocks of every row of ``docs``."""
    lines = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.split("text", "\r?\n").alias("lines"))
    blank = lambda x: ~x.rlike("[^\\x20\\x09-\\x0D]")
    start = lambda i: (i == 0) | (i % STRIDE == 0) | blank(F.element_at("lines", F.greatest(i, F.lit(1))))
    # a block ends before the first blank line
    joined = lambda i: F.element_at(F.split(F.array_join(F.slice("lines", i + 1, F.lit(BLOCK)), "\n"), "\n[\\x20\\x09-\\x0D]*(\n|$)"), 1)
    units = F.transform("lines", lambda x, i: F.struct(
        i.alias("i"), x.alias("line"), F.when(start(i) & ~blank(x), joined(i)).alias("block")))
    each = lines.select("doc_id", "row", F.explode(units).alias("u"))
    block = F.when(F.size(F.split("u.block", "\n")) > 1, F.regexp_replace("u.block", "\\s+", " "))
    return (each.select("doc_id", "row", F.col("u.i").alias("paragraph"), F.explode(F.array_compact(F.array("u.line", block))).alias("text"))
            .where(F.col("text").rlike("[^\\x20\\x09-\\x0D]")))


def _sampled(units: DataFrame, n: int) -> DataFrame:
    """About ``n`` texts by a threshold on their hash: no sort, no one task."""
    total = units.count()
    if not total:
        return units.select("text")
    return units.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(int(min(1.0, n / total) * (1 << 30)))).select("text")


def _training(docs: DataFrame, words: list[tuple[str, list[str]]], background: int) -> DataFrame:
    """words, label, held: made forms of templates, other sentences, background."""
    spark = docs.sparkSession
    made = []
    for i, fam in enumerate(NAMES, 1):
        for k, line in enumerate(templates(fam)):
            w = line.split()
            parts = [" ".join(w[: len(w) * 2 // 3]), " ".join(w[len(w) // 3:])] if len(w) > 12 else []
            forms = [line, f"Notice: {line}", f"{line} All rights as stated.", f"Copyright (c) 2020 the authors. {line}", *parts]
            made += [(float(i), v, False) for v in forms]
            made += [(float(i), f"See the file named here: {line} Thank you for reading.", True)] * (k % 3 == 0)
    made += [(0.0, s, j % 2 == 1) for j, s in enumerate(OTHERS)]
    own = spark.createDataFrame(made, "label double, line string, held boolean") \
        .select(tokens(F.col("line")).alias("words"), "label", "held")
    # half of the background holds a key, half is any text of few documents
    with_key = _sampled(paragraphs(docs.where(has_key(F.col("text")))).where(has_key(F.col("text"))), background // 2)
    total = max(1, docs.count())
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(int(min(1.0, 100 / total) * (1 << 30))))
    best = F.greatest(*[_overlap(F.col("w"), t) for _, t in words])
    sample = with_key.unionByName(_sampled(paragraphs(some), background // 2)) \
        .select(F.array_distinct(tokens(F.col("text"))).alias("w"), tokens(F.col("text")).alias("words"),
                (F.xxhash64("text") % 2 == 0).alias("held")) \
        .where(best < 0.5).select("words", F.lit(0.0).alias("label"), "held")
    return stage(sample.unionByName(own).repartition(4), "licence-training")


def licence_scan(docs: DataFrame, background: int = BACKGROUND, features: int = 1 << 14,
                 min_probability: float = 0.4, confirm: float = 0.6) -> DataFrame:
    """One row per document row and family found: doc_id, family, paragraph,
    probability, overlap (with the best template), n_paragraphs, line."""
    words = _template_words(docs.sparkSession)
    tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=features, binary=True)
    train = tf.transform(_training(docs, words, background).withColumn("grams", grams(F.col("words"))))
    weight = F.when(F.col("label") == 0, 1.0).otherwise(3.0)
    model = LogisticRegression(maxIter=60, regParam=0.0005, elasticNetParam=0.0, weightCol="wt", family="multinomial") \
        .fit(train.where("not held").withColumn("wt", weight))

    def family_probability(p):
        return F.array_max(F.slice(p, 2, len(FAMILIES)))

    p = vector_to_array("probability")
    seen = model.transform(train.where("held and label = 0")).agg(
        F.percentile_approx(family_probability(p), 0.995, 100000).alias("q")).first()["q"]
    least = max(min_probability, min(seen or 0.0, 0.9))
    units = paragraphs(docs.where(has_key(F.col("text")))).where(has_key(F.col("text"))).withColumn("words", tokens(F.col("text")))
    scored = model.transform(tf.transform(units.withColumn("grams", grams(F.col("words")))))
    confirmations = F.coalesce(*[
        F.when(F.col("label_id") == i, F.greatest(*[_overlap(F.array_distinct("words"), t) for f, t in words if f == fam] + [F.lit(0.0)]))
        for i, fam in enumerate(FAMILIES) if i])
    found = (scored.select("doc_id", "row", "paragraph", "text", "words", F.col("prediction").cast("int").alias("label_id"),
                           family_probability(p).alias("probability"))
             .where((F.col("label_id") > 0) & (F.col("probability") >= least))
             .withColumn("overlap", confirmations).where(F.col("overlap") >= confirm))
    best = F.max_by(F.struct("doc_id", "paragraph", "probability", "overlap", "text"),
                    F.struct("overlap", (-F.char_length("text")).alias("short"), (-F.col("paragraph")).alias("first")))
    return (found.groupBy("row", "label_id").agg(best.alias("b"), F.countDistinct("paragraph").alias("n_paragraphs"))
            .select("b.doc_id", F.element_at(F.array(*map(F.lit, FAMILIES)), F.col("label_id") + 1).alias("family"),
                    "b.paragraph", "b.probability", "b.overlap", "n_paragraphs", F.col("b.text").alias("line")))
