"""License scans by MinHash bands over overlapping windows of text.

The words of a text are cut into windows of ``WINDOW`` words every ``STRIDE``. A window's band i is
the smallest of its shingles' hashes with seed i; a template's windows have bands, too, and a common
band retrieves the template. Bands are independent: where half of the shingles of two windows are
common, all ``BANDS`` bands miss with a chance of 2^-24. A template so short that a match needs all of
its shingles is retrieved by its first one, without a chance to miss. The match is then verified by
the share of the template's shingles in the whole text. Only DataFrame functions are used on texts;
the templates are a short fixed list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE, WINDOW, STRIDE, BANDS = 2, 8, 4, 24
CONTAINED = 0.8
# Templates are broadcast; a longer list is refused.
MOST_TEMPLATES = 1000

# Texts of public licenses and the usual short forms that refer to them.
TEMPLATES = {
    "MIT short": "Released under the MIT License.",
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 short": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 short": "Licensed under CC BY-NC 4.0.",
    "All rights reserved": "All rights reserved.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}

# SQL over the text column ``t``: words of a-z and 0-9, A-Z lower-cased.
_WORDS = f"split(trim(regexp_replace(translate(coalesce(t, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ')), ' ')"
_SHINGLES = "if(size(w) < 2, array(), transform(sequence(0, size(w) - 2), i -> xxhash64(w[i], w[i + 1])))"


def _bands(shingles: str) -> str:
    return "array(" + ", ".join(f"array_min(transform({shingles}, x -> xxhash64(x, {i})))" for i in range(BANDS)) + ")"


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """Rows ``(template, shingles, keys)``: distinct shingles, and what retrieves the template.

    These are the bands of all windows, and the first shingle if a match needs every shingle.
    """
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"{len(templates)} templates; at most {MOST_TEMPLATES} are broadcast")
    rows = spark.createDataFrame(sorted(templates.items()), "template string, t string")
    hashed = rows.withColumn("w", F.expr(_WORDS)).withColumn("h", F.expr(_SHINGLES)).where("size(h) > 0")
    size = WINDOW - SHINGLE + 1
    windows = f"transform(sequence(1, greatest(1, size(h) - {size - 1})), s -> {_bands(f'slice(h, s, {size})')})"
    first = f"if(size(shingles) - 1 < {CONTAINED} * size(shingles), slice(h, 1, 1), array())"
    return hashed.withColumn("shingles", F.array_distinct("h")).select("template", "shingles", F.expr(f"array_distinct(concat(flatten({windows}), {first}))").alias("keys"))


def scan(documents: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Rows ``(doc_id, template, n_shingles, n_found)``: every template that a document holds.

    A document holds a template if it has at least ``CONTAINED`` of the template's distinct
    shingles; ``n_found`` is how many, of ``n_shingles``. Texts are taken whole; null and empty ones
    hold nothing; rows that share an id and a template are one, with the larger number. Other
    columns are ignored. Only matches are shuffled.
    """
    spark = documents.sparkSession
    known = template_table(spark, TEMPLATES if templates is None else templates).collect()
    # Bounded by the list of templates.
    shingles = sorted({h for r in known for h in r.shingles})
    keys = sorted({(k, r.template) for r in known for k in r.keys})
    index = spark.createDataFrame(keys or [], "key long, template string")
    wanted = spark.createDataFrame([(r.template, r.shingles) for r in known], "template string, shingles array<bigint>")

    def among(x: str, values: list[int]) -> str:
        return f"{x} IN ({', '.join(map(str, values))})" if values else "false"

    size = WINDOW - SHINGLE + 1
    # A band comes from one of the window's shingles, so a window without any template's shingle has
    # none to look up. No filter stands on a computed array: it would be pushed down and compute it again.
    windows = f"filter(transform(sequence(1, greatest(1, size(h)), {STRIDE}), s -> slice(h, s, {size})), v -> exists(v, x -> {among('x', shingles)}))"
    present = f"array_distinct(filter(h, x -> {among('x', shingles)}))"
    bands = f"filter(concat(v, {_bands('v')}), k -> {among('k', sorted({k for k, _ in keys}))})"
    texts = documents.select("doc_id", F.col("text").alias("t")).select("doc_id", F.expr(_WORDS).alias("w")).select("doc_id", F.expr(_SHINGLES).alias("h"))
    near = texts.select("doc_id", F.expr(present).alias("h"), F.expr(windows).alias("v")).select("doc_id", "h", F.explode_outer("v").alias("v")).where("v IS NOT NULL")
    found = near.select("doc_id", "h", F.explode_outer(F.expr(bands)).alias("key")).where("key IS NOT NULL")
    candidates = found.join(F.broadcast(index), "key").join(F.broadcast(wanted), "template")
    verified = candidates.select(
        "doc_id", "template", F.size("shingles").alias("n_shingles"), F.size(F.array_intersect("shingles", "h")).alias("n_found")
    ).where(F.col("n_found") >= CONTAINED * F.col("n_shingles"))
    return verified.groupBy("doc_id", "template", "n_shingles").agg(F.max("n_found").alias("n_found"))
