"""License scan: MinHash bands over overlapping windows retrieve templates,
exact shingle containment verifies them.

Words are runs of letters and digits, lower-cased; shingles have five words.
Templates of fewer than four shingles are looked for with windows of one
shingle, whose MinHash is the shingle itself (collision certain); longer ones
with windows of four, every second place, against the template's windows at
every place: an untouched stretch of nine words collides for certain.  Each band
is the minimum of a hash of its own, so windows with Jaccard similarity j share a
band with probability 1 - (1 - j)^4: 0.97 where they share three of four
shingles (j = 0.6), and a template has many windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import at, let, written

# License notices, as their publishers word them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
WORD = r"[\p{L}\p{N}]+"
SHINGLE = 5
#: (shingles in a window, places between windows, bands of one minimum each)
SHORT, LONG = (1, 1, 1), (4, 2, 4)


def shingles(text: Column) -> Column:
    """array<bigint>: hashes of the 5-word shingles in text order; fewer words
    (or a null text) give none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE),
                                          lambda i: F.xxhash64(*[at(h, i + d) for d in range(SHINGLE)])))
        .otherwise(F.array().cast("array<bigint>")))


def band_keys(h: Column, kind: tuple[int, int, int], every: int) -> Column:
    """array<bigint>: each band's minimum of every window of the shingles.
    The last window may be short."""
    size, _, bands = kind
    places = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.greatest(F.size(h) - size + every - 1, F.lit(0)), F.lit(every)))
    places = F.coalesce(places, F.array().cast("array<int>"))

    def band(seed: int) -> Column:
        # a hash of its own, computed once a shingle
        hashes = F.transform(h, lambda x: F.when(x.isNotNull(), F.xxhash64(x, F.lit(seed))))
        return let(hashes, lambda g: F.transform(places, lambda i: F.least(*[at(g, i + d) for d in range(size)]) if size > 1 else at(g, i)))

    return F.concat(*[band(b) for b in range(bands)])


def _templates(spark, templates: dict[str, str]) -> DataFrame:
    rows = spark.createDataFrame(list(templates.items()), "license_id string, template string")
    return rows.withColumn("h", shingles(F.col("template"))).select(
        "license_id", "h", F.array_distinct("h").alias("wanted"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, similarity: float = 0.8) -> DataFrame:
    """(doc_id, license_id, n_shingles, n_matched) for every row of ``docs``
    (doc_id, text; others ignored) that holds at least ``similarity`` of a
    template's distinct shingles.  Null and empty texts hold none; a row that
    repeats is reported as often.  Templates have a fixed number and so have
    their bands: the only table that is broadcast."""
    spark = docs.sparkSession
    known = _templates(spark, templates or TEMPLATES)
    short = F.size("wanted") < LONG[0]
    bands = F.broadcast(known.select("license_id", F.explode(F.when(short, band_keys(F.col("h"), SHORT, 1))
                                                             .otherwise(band_keys(F.col("h"), LONG, 1))).alias("key")).distinct())
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    keys = rows.select("doc_id", F.xxhash64("text").alias("row"), shingles(F.col("text")).alias("h"))
    keys = keys.select("doc_id", "row", F.explode(F.concat(band_keys(F.col("h"), SHORT, SHORT[1]), band_keys(F.col("h"), LONG, LONG[1]))).alias("key"))
    found = written(keys.join(bands, "key").select("doc_id", "row", "license_id").distinct(), "license-candidates")
    found = found.groupBy("doc_id", "row").agg(F.collect_set("license_id").alias("licenses"))
    texts = (rows.withColumn("row", F.xxhash64("text"))
                 .join(found.withColumnRenamed("doc_id", "d").withColumnRenamed("row", "r"),
                       F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")))
                 .select("doc_id", "licenses", F.array_distinct(shingles(F.col("text"))).alias("have")))
    return (texts.select("doc_id", "have", F.explode("licenses").alias("license_id"))
                 .join(F.broadcast(known.select("license_id", "wanted")), "license_id")
                 .withColumn("n_matched", F.size(F.array_intersect("have", "wanted")))
                 .withColumn("n_shingles", F.size("wanted"))
                 .filter(F.col("n_matched") >= F.col("n_shingles") * F.lit(similarity))
                 .select("doc_id", "license_id", "n_shingles", "n_matched"))
