"""License notices in documents: MinHash bands of overlapping windows retrieve templates, exact containment verifies.

DataFrame functions only. Templates fall into classes by their number of five-word shingles; a class of up to ``s``
shingles is searched in windows of ``2 s`` shingles that begin every ``s``, so each occurrence lies whole in a window.
Three quarters of a template with more than ``s / 2`` shingles then make at least 3/19 of the shingles of window and
template together, and ``BANDS`` bands of one row miss such a window with probability (16/19)^64, below 2 in 100,000.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.llm.decontaminate import words_of

SHINGLE, BANDS, SHARE = 5, 64, 0.75

# Notices of public licences.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "mit-licensed": "This project is licensed under the terms of the MIT license.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-line": "This work is licensed under the GNU General Public License, version 2.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "agpl": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def anchors(templates: dict[str, str], share: float = SHARE) -> list[str]:
    """Words such that whatever holds ``share`` of a template's shingles holds one of them.

    They are in more than ``1 - share`` of the shingles of each template, so a match cannot avoid them. Chosen greedily,
    the word that serves most templates first, ties by name; only words of six letters or more, if they suffice.
    """
    open_ = {}
    for name, text in templates.items():
        w = _plain_words(text)
        open_[name] = [set(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))]
    chosen: list[str] = []

    def lacks(name):
        covered = sum(1 for s in open_[name] if s & set(chosen))
        return covered <= (1 - share) * len(open_[name])

    while todo := [n for n in open_ if lacks(n)]:
        gain: dict[str, int] = {}
        for name in todo:
            for shingle in open_[name]:
                if not shingle & set(chosen):
                    for word in shingle:
                        gain[word] = gain.get(word, 0) + 1
        long = {w: g for w, g in gain.items() if len(w) >= 6} or gain
        chosen.append(min(long, key=lambda w: (-long[w], w)))
    return sorted(chosen)


def _shingles(words: Column) -> Column:
    """Distinct hashes of the runs of five words; of all words, if there are fewer."""
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, F.lit(SHINGLE)))))


def _bands(shingles: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, k)))))


def _starts(size: int, last: Column) -> Column:
    """The windows of a class: one every ``size`` words up to the last shingle."""
    return F.transform(F.sequence(F.lit(0), last, F.lit(size)), lambda i: F.struct(F.lit(size).alias("size"), i.alias("word")))


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = []
    for name, text in sorted(templates.items()):
        n = max(1, len(_plain_words(text)) - SHINGLE + 1)
        rows.append((name, text, 1 << (n - 1).bit_length()))
    df = spark.createDataFrame(rows, "license string, template string, size int")
    return df.select("license", "size", _shingles(words_of(F.col("template"))).alias("template"))


def scan(documents: DataFrame, templates: dict[str, str] | None = None, share: float = SHARE) -> DataFrame:
    """``doc_id``, ``license``, ``containment`` and the ``word`` the best window begins at, for each notice found.

    ``containment`` is the part of the template's distinct shingles that one window holds, ``share`` at least. Of
    several windows, and of several rows with one id and licence, the best counts, ties to the first. Null and empty texts hold
    nothing; a text of fewer than five words can only equal a whole template. A null id is one id. The template list is
    the driver's own and of fixed size, so its bands are broadcast whatever the size of the documents.
    Only windows that hold an anchor word (:func:`anchors`) are hashed; no other can hold ``share`` of a template.
    """
    templates = TEMPLATES if templates is None else templates
    spark = documents.sparkSession
    fixed = _templates(spark, templates)
    sizes = sorted({1 << (max(1, len(_plain_words(t)) - SHINGLE + 1) - 1).bit_length() for t in templates.values()})
    words = anchors(templates, share)
    text = F.lower("text")
    some = F.lit(False)
    for word in words:
        some = some | text.contains(word)
    rows = documents.where(some).select("doc_id", words_of(F.col("text")).alias("w"))
    last = F.greatest(F.size("w") - SHINGLE, F.lit(0))
    starts = F.flatten(F.array(*(_starts(size, last) for size in sizes)))
    rows = rows.where(F.size("w") > 0).select("doc_id", "w", F.explode(starts).alias("at"))
    rows = rows.select("doc_id", "at.size", "at.word", F.slice("w", F.col("at.word") + 1, 2 * F.col("at.size") + SHINGLE - 1).alias("w"))
    rows = rows.where(F.arrays_overlap("w", F.array(*(F.lit(w) for w in words)))).select("doc_id", "size", "word", _shingles(F.col("w")).alias("held"))
    found = rows.select("doc_id", "size", "word", "held", F.explode(_bands(F.col("held"))).alias("band"))
    index = fixed.select("license", "size", F.explode(_bands(F.col("template"))).alias("band"))
    found = found.join(F.broadcast(index), ["size", "band"]).select("doc_id", "license", "word", "held")
    found = found.join(F.broadcast(fixed.select("license", "template")), "license")
    held = F.size(F.array_intersect("held", "template")) / F.size("template")
    found = found.select("doc_id", "license", "word", held.alias("containment")).where(F.col("containment") >= share)
    best = found.groupBy("doc_id", "license").agg(F.max(F.struct("containment", (-F.col("word")).alias("w"))).alias("o"))
    return best.select("doc_id", "license", "o.containment", (-F.col("o.w")).alias("word"))
