"""License scans by MinHash bands over overlapping windows, in DataFrame functions only.

Windows are as long as a template and start at every word. A window can share a band with a template only if
it holds the template's least shingle under that band's permutation, so those few shingles are looked for
first; for each one found, the window that has it where the template does is verified by exact shingle containment.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Short license notices, and usual license bodies and headers. A license can have several.
TEMPLATES = (
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MIT", "Distributed under the MIT License."),
)
SHINGLE, CONTAINMENT, BANDS, SEED = 5, 0.75, 8, 11


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for null and for texts without any."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(tokens: Column, k: int = SHINGLE) -> Column:
    """Hashes of each run of k words, in order, with repeats; shorter texts give none."""
    def of(t: Column) -> Column:
        def run(i: Column) -> Column:
            return F.xxhash64(*[F.element_at(t, (i + F.lit(j)).cast("int")) for j in range(k)])

        return F.when(F.size(t) >= k, F.transform(F.sequence(F.lit(1), F.size(t) - F.lit(k - 1)), run)).otherwise(F.array().cast("array<bigint>"))

    # The words are bound by a lambda: named in the inner one they would be cut anew for each place.
    return F.element_at(F.transform(F.array(tokens), of), 1)


def masks(bands: int = BANDS) -> list[int]:
    """One permutation of 64-bit hashes for each band: exclusive or with a fixed number."""
    draw = random.Random(SEED)
    return [draw.getrandbits(64) - (1 << 63) for _ in range(bands)]


def band_values(hashes: Column, bands: int = BANDS) -> Column:
    """The MinHash signature: the least hash under each permutation. A band is one of them, so sets of Jaccard
    similarity s share a band with probability 1 - (1 - s) ** bands: for 8 bands 0.996 at s = 0.5, 0.99998 at 0.75."""
    def least(mask: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(mask))))

    return F.array(*[least(m) for m in masks(bands)])


def scan(docs: DataFrame, templates=TEMPLATES, key: str = "doc_id", text: str = "text", least: float = CONTAINMENT, bands: int = BANDS) -> DataFrame:
    """(key, license, containment_bp, at): each document's best place of each template that it holds; at counts words from 0.

    Windows are as long as the template and start at every word, so they overlap. One that shares a band with
    the template is verified: it is held where the window, with a quarter of its length on either side, has at
    least `least` of the template's distinct shingles (containment_bp: in hundredths of a percent). Templates
    need five words or more. Null and short texts hold none, long ones are read whole; rows that repeat a key give one row; of places
    that tie the first counts; other columns, whatever their names, are not read; empty tables
    give none. The list of templates is a parameter, so its size, which bounds the broadcast, is known beforehand.
    """
    spark = docs.sparkSession
    listed = spark.createDataFrame([tuple(t) for t in templates], "license string, template string")
    known = listed.select("license", shingles(words(F.col("template"))).alias("t")).withColumn("signature", band_values(F.col("t"), bands)).collect()
    # The shingle that stands for each band is the signature with the permutation undone.
    rows = [(r["license"], r["t"], r["signature"], a, r["t"].index(a), len(r["t"])) for r in known for a in {v ^ m for v, m in zip(r["signature"], masks(bands), strict=True)}]
    anchored = spark.createDataFrame(rows, "license string, t array<bigint>, signature array<bigint>, anchor bigint, offset int, n int")
    anchors = sorted({r[3] for r in rows})

    hashed = docs.select(F.col(key).alias("__key"), shingles(words(F.col(text))).alias("h"))
    places = F.filter(F.transform("h", lambda h, i: F.when(h.isin(anchors), F.struct(h.alias("anchor"), i.alias("i")))), lambda p: p.isNotNull())
    hits = hashed.withColumn("places", places).filter(F.size("places") > 0).withColumn("p", F.explode("places"))
    near = hits.select("__key", "h", F.col("p.anchor").alias("anchor"), F.col("p.i").alias("i")).join(F.broadcast(anchored), "anchor")
    start, margin = F.greatest(F.col("i") - F.col("offset"), F.lit(0)), F.expr("n div 4")
    windows = near.withColumn("start", start).withColumn("around", F.greatest(F.col("start") - margin, F.lit(0)))
    windows = windows.select(
        "__key", "license", "t", "signature", "start", F.slice("h", F.col("start") + 1, F.col("n")).alias("window"),
        F.slice("h", F.col("around") + 1, (F.col("n") + 2 * margin).cast("int")).alias("wide"),
    )
    same_band = F.exists(F.zip_with(band_values(F.col("window"), bands), "signature", lambda a, b: a == b), lambda x: x)
    contained = F.size(F.array_intersect("t", "wide")) / F.size(F.array_distinct("t"))
    found = windows.filter(same_band).select("__key", "license", "start", contained.alias("c")).filter(F.col("c") >= least)
    best = F.max_by("start", F.struct("c", -F.col("start")))
    return found.groupBy(F.col("__key").alias(key), "license").agg(F.floor(F.max("c") * 10000 + 0.5).cast("long").alias("containment_bp"), best.cast("long").alias("at"))
