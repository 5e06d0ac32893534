"""License notices in documents, retrieved by MinHash bands, verified exactly.

Documents are cut into windows of ``WINDOW`` words that overlap, so that each
five-word shingle is in one window; templates are cut into such windows at every
place. A window's signature has ``BANDS`` bands of ``ROWS`` minima of its shingles,
each under an order of its own. Windows that share a band retrieve the template.
Exact containment of the template's shingles in the document then decides.

What the bands guarantee: windows of equal shingles share every band, so a passage
of ``2 * PER_WINDOW - 1`` shingles of a template in one piece is always retrieved. A
finding lacks a fifth of the shingles at most. Where these are missing at the ends or
by changed, added or lost words (each takes ``PER_WINDOW`` shingles or more, of two
windows), a template of ``LONG`` shingles keeps such a window: it is retrieved with
certainty. Only a template scattered over a document in pieces of fewer than 7
shingles depends on chance. A window with 3 shingles of 4 in common (likeness 0.6) shares
a band with a probability of 0.972, with 2 of 4 (likeness 1/3) of 0.61, and any window of
the document is enough.

Templates of fewer than ``LONG`` shingles are shorter than that. Their band is the
single shingle, which equal shingles always share.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeseries.llm.shingled import hashes, keyed, meet, words

SHINGLE = 5
WINDOW = 8
PER_WINDOW = WINDOW - SHINGLE + 1
CONTAINMENT = 0.8
BANDS = 8
ROWS = 2
LONG = 9  # shingles; four fifths of them hold a whole window at any place

# Notices as licenses ask for them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                   "this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
                "of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms "
                "of the GNU General Public License as published by the Free Software Foundation; either "
                "version 2 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("BSD", "Released under the BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this permission "
            "notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
            "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
            "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
            "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
            "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
            "USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met: 1. Redistributions of source code "
            "must retain the above copyright notice, this list of conditions and the following "
            "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other "
            "materials provided with the distribution. 3. Neither the name of the copyright holder nor "
            "the names of its contributors may be used to endorse or promote products derived from this "
            "software without specific prior written permission."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event "
             "will the authors be held liable for any damages arising from the use of this software. "
             "Permission is granted to anyone to use this software for any purpose, including commercial "
             "applications, and to alter it and redistribute it freely, subject to the following "
             "restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
             "that you wrote the original software. If you use this software in a product, an "
             "acknowledgment in the product documentation would be appreciated but is not required. 2. "
             "Altered source versions must be plainly marked as such, and must not be misrepresented as "
             "being the original software. 3. This notice may not be removed or altered from any source "
             "distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def templates(spark: SparkSession) -> DataFrame:
    """``template`` (number), ``license``, ``text``."""
    rows = [(i, *x) for i, x in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "template int, license string, text string")


def _windows(rows: DataFrame, keep: list[str], step: int) -> DataFrame:
    """``s0`` and on: the shingles of windows of ``hashed``, ``step`` words apart, null past the end."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("hashed") - SHINGLE + 1, F.lit(1)), F.lit(step))
    cut = F.transform(starts, lambda s: F.slice("hashed", s, WINDOW))
    windows = rows.where(F.size("hashed") >= SHINGLE).select(*keep, F.explode(cut).alias("w"))
    word = [F.get("w", F.lit(i)) for i in range(WINDOW)]
    return windows.select(
        *keep,
        *[
            F.when(word[i + SHINGLE - 1].isNotNull(), F.xxhash64(*word[i : i + SHINGLE])).alias(f"s{i}")
            for i in range(PER_WINDOW)
        ],
    )


def _shingles(windows: DataFrame, keep: list[str]) -> DataFrame:
    """``key``: every shingle of the windows."""
    found = windows.select(*keep, F.explode(F.array(*[f"s{i}" for i in range(PER_WINDOW)])).alias("key"))
    return found.where(F.col("key").isNotNull())


def _bands(windows: DataFrame, keep: list[str]) -> DataFrame:
    """``key``: every band of the windows, a hash of the least shingles under ``ROWS`` orders."""

    def least(order: int) -> Column:
        shingles = [F.col(f"s{i}") for i in range(PER_WINDOW)]
        # The least skips nulls, but the hash of a null is none.
        return F.least(*[F.when(s.isNotNull(), F.xxhash64(F.lit(order), s)) for s in shingles])

    bands = [
        F.xxhash64(F.lit(band), *[least(band * ROWS + row) for row in range(ROWS)])
        for band in range(BANDS)
    ]
    return windows.select(*keep, F.explode(F.array(*bands)).alias("key"))


def license_notices(
    docs: DataFrame, notices: DataFrame, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """``doc``, ``variant``, ``license``, ``containment``: the notices that documents hold.

    ``containment`` is the share of a template's five-word shingles that the
    document has; templates with ``CONTAINMENT`` or more are findings, and a
    license counts once with its best template. ``variant`` is a hash of the
    text, which tells rows with the same id apart.

    Words are lower-cased runs of letters and digits. Null texts and texts or
    templates of fewer than five words have no shingles and no findings.
    Repeated rows give one finding. Null ids are kept. Other columns of ``docs``,
    also such named like those of the result, are not read. Long texts are cut like
    others; no text is shuffled. The bands and shingles of ``notices`` are broadcast in
    blocks of bounded size, each one pass over the documents.
    """
    known = notices.select("template", "license", hashes(words(F.col("text"))).alias("hashed"))
    parts = _shingles(_windows(known, ["template"], PER_WINDOW), ["template"]).distinct()
    sizes = parts.groupBy("template").agg(F.count("*").alias("n"))
    of = ["doc", "variant"]
    rows = keyed(docs, text, id_column)
    windows = _windows(rows.select(*of, hashes(words("text")).alias("hashed")), of, PER_WINDOW)
    # Retrieval: bands of windows, and single shingles for short templates.
    at_all_places = _windows(known, ["template"], 1).where(F.col(f"s{PER_WINDOW - 1}").isNotNull())
    long = sizes.where(F.col("n") >= LONG).select("template")
    bands = _bands(at_all_places.join(long, "template", "left_semi"), ["template"]).distinct()
    retrieved = meet(_bands(windows, of), bands, "key").select(*of, "template").distinct()
    # Verification: the shingles that a document and a template have in common.
    met = meet(_shingles(windows, of), parts, "key").groupBy(*of, "template").agg(
        F.size(F.collect_set("key")).alias("common")
    )
    pairs = met.join(sizes, "template").withColumn("containment", F.col("common") / F.col("n"))
    pairs = pairs.where(F.col("containment") >= CONTAINMENT)
    same = (
        pairs["doc"].eqNullSafe(retrieved["doc"])
        & (pairs["variant"] == retrieved["variant"])
        & (pairs["template"] == retrieved["template"])
    )
    found = pairs.join(retrieved.withColumn("retrieved", F.lit(True)), same, "left").where(
        (F.col("n") < LONG) | F.col("retrieved")
    )
    found = found.select(pairs["doc"], pairs["variant"], pairs["template"], "containment")
    return (
        found.join(known.select("template", "license"), "template")
        .groupBy(*of, "license")
        .agg(F.max("containment").alias("containment"))
    )
