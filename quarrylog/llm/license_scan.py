"""License notices: MinHash bands over overlapping windows find templates, exact containment confirms.

Texts become words; shingles are `SHINGLE` words, or all words of a template that has fewer, so that short notices
and SPDX tags are found as well. For each shingle width and size class of templates (up to L shingles, L a power
of two) windows of 2 L shingles start every L, so that every notice lies whole in one window, where its
share is more than a quarter at the least similarity. Each of BANDS minimum hashes is a band of its own: a window
with a Jaccard similarity of s to a template misses it with probability (1 - s) ** BANDS, under 1e-5 for
s = 0.2. Windows and templates meet by an equi-join on (band, minimum), and stay if the window holds
`least` of the template's shingles.

Only windows with a key word are hashed. The key words of a template are chosen so that more than a
fifth of its shingles hold one: a window without any can't reach the similarity, so none is lost.

Defined results: null and empty texts match nothing; repeated rows are each reported; a null doc_id is kept;
the leftmost window of the best containment is reported; other columns are ignored; an empty table gives
an empty result; very long texts are whole, in windows; a template without a word is not allowed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written

SHINGLE, BANDS = 5, 48
WORD = r"[\p{L}\p{N}]++(?:[.-][\p{L}\p{N}]++)*+"
#: Notices by licence, as they are published.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("mit", "Released under the MIT License"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("all-rights-reserved", "All rights reserved"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())


def _width(words: list[str]) -> int:
    """Words of a shingle: fewer than SHINGLE where the template has fewer."""
    return min(SHINGLE, len(words))


def key_words(templates, least: float) -> list[str]:
    """Words of which every template has some in so many shingles that a match must hold one."""
    chosen: set[str] = set()
    for _, text in templates:
        words = _words(text)
        if not words:
            raise ValueError(f"a template needs a word: {text!r}")
        width = _width(words)
        shingles = [words[i : i + width] for i in range(len(words) - width + 1)]
        free = lambda keys: sum(not keys.intersection(s) for s in shingles)  # noqa: B023, E731
        own = sorted(set(words), key=lambda w: (not w.startswith("licen"), -len(w), w))
        for w in own:
            if free(chosen) < least * len(shingles):
                break
            chosen.add(w)
    return sorted(chosen)


def find_licenses(docs: DataFrame, templates=TEMPLATES, least: float = 0.8) -> DataFrame:
    """doc_id, license, template, containment, first_word for each row and template that match."""
    spark = docs.sparkSession
    keys = key_words(templates, least)
    size_class = lambda text: (_width(_words(text)), 1 << max(0, (len(_words(text)) - SHINGLE)).bit_length())
    shingled = lambda words: F.transform(F.sequence(F.lit(1), F.size(words) - F.col("width") + 1), lambda i: F.xxhash64(F.slice(words, i, F.col("width"))))
    own = spark.createDataFrame([(i, name, *size_class(t), _words(t)) for i, (name, t) in enumerate(templates)], "template int, license string, width int, size int, words array<string>")
    own = own.withColumn("own", F.array_distinct(shingled(F.col("words")))).drop("words")
    # BANDS rows a template: a bound that the template list sets.
    minima = lambda shingles: F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.xxhash64(b, F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, b)))))
    bands = own.select("template", "license", "width", "size", "own", F.explode(minima(F.col("own"))).alias("band"))
    sizes = sorted({size_class(t) for _, t in templates})
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    d = d.where(F.col("text").rlike(r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, keys)) + r")(?![\p{L}\p{N}])"))
    d = d.select("rid", "doc_id", F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("words"))
    near = F.transform("words", lambda w: w.isin(*keys))
    starts = F.array(*[F.named_struct(F.lit("width"), F.lit(w), F.lit("size"), F.lit(s), F.lit("starts"), F.sequence(F.lit(1), F.greatest(F.size("words") - w + 1, F.lit(1)), F.lit(s))) for w, s in sizes])
    spread = d.withColumn("near", near).select("rid", "doc_id", "words", "near", F.explode(starts).alias("x")).select("rid", "doc_id", "words", "near", "x.width", "x.size", F.explode("x.starts").alias("at"))
    reach = F.col("size") * 2 + F.col("width") - 1
    windows = (
        spread.where(F.array_contains(F.slice("near", F.col("at"), reach), True))
        .select("rid", "doc_id", "width", "size", "at", F.slice("words", F.col("at"), reach).alias("words")).where(F.size("words") >= F.col("width"))
        .select("rid", "doc_id", "width", "size", "at", F.array_distinct(shingled(F.col("words"))).alias("shingles"))
    )
    windows = written(windows, "license-windows")
    met = windows.select("rid", "doc_id", "width", "size", "at", "shingles", F.explode(minima(F.col("shingles"))).alias("band")).join(F.broadcast(bands), ["width", "size", "band"])
    share = F.size(F.array_intersect("own", "shingles")) / F.size("own")
    sure = met.select("rid", "doc_id", "license", "template", "at", share.alias("containment")).where(F.col("containment") >= least)
    best = sure.groupBy("rid", "doc_id", "license", "template").agg(F.min(F.struct((-F.col("containment")).alias("c"), "at")).alias("x"))
    return best.select("doc_id", "license", F.col("template").cast("long"), (-F.col("x.c")).alias("containment"), F.col("x.at").cast("long").alias("first_word"))


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return find_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
