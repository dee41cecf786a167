"""License scan (operator 2). DataFrame functions only.

Texts and license templates are lower-cased, stripped of punctuation and of the marks of comments, and cut into
5-word shingles. A template of m shingles belongs to class s, the least power of two that is
at least m, and is looked for in windows of 2 s shingles that start every s shingles, so
that each occurrence lies whole in one window. Windows and templates are MinHashed, and a
window retrieves the templates that share a band with it: BANDS bands of one value. A window
that holds 0.8 of a template's shingles has a Jaccard similarity of at least 0.19 with it
(m > s / 2), so it shares no band with probability under (1 - 0.19) ** 64 < 2e-6. Matches are
verified by exact shingle containment, of 0.8 at least.

Windows that share no shingle at all with any template cannot share a band; a join of
the shingles leaves them out before the hashing.

Defined cases
  * null or empty texts and texts of under 5 words match nothing; templates of under
    5 words are not looked for.
  * a null doc_id is a document of its own; rows that share a doc_id are judged together.
  * equal templates are reported each; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.common import read, stored
from lakeshelf.operators.joins import fits, maybe_broadcast

SHINGLE, BANDS, CONTAINED = 5, 64, 0.8
MAX_BROADCAST_SHINGLES = 1_000_000
PUNCTUATION = ".,;:!?\"'()[]"
# A word of these alone is the mark of a comment: a notice behind " * ", "#" or "//" has the words of the bare one.
MARKS = "*#/\\|=+-_~`%&$@^<>{}"

# Public license notices.
TEMPLATES = [
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("mit-line", "Released under the MIT License."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("isc-full", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("mit-full", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("lgpl-notice", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("cc-by-4.0-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0-line", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("unlicense-notice", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
]


def _shingles(text: Column) -> Column:
    """Hashes of the 5-word shingles, in order."""
    clean = F.translate(F.lower(text), PUNCTUATION, " " * len(PUNCTUATION))
    return F.filter(F.split(clean, r"[ \t-\r]+"), lambda w: F.translate(w, MARKS, "") != "")


def _hashed(df: DataFrame, *keep: str) -> DataFrame:
    d = df.select(*keep, _shingles(F.col("text")).alias("_w")).filter(F.size("_w") >= SHINGLE)
    d = d.select(*keep, F.transform("_w", lambda w: F.xxhash64(w)).alias("_w"))
    at = F.sequence(F.lit(1), F.greatest(F.size("_w") - (SHINGLE - 1), F.lit(1)))  # Spark may place this before the filter
    return d.select(*keep, F.transform(at, lambda i: F.xxhash64(F.slice("_w", i, SHINGLE))).alias("sh"))


def _bands(shingles: Column) -> Column:
    """Array of BANDS values: band b has the least of the shingles' hashes with seed b."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, b))))


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "template_id string, text string")


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, template_id, n_shared, n_template, word: the window that holds most of each template found."""
    t = _hashed(templates, "template_id").withColumn("sh", F.array_distinct("sh"))
    t = stored(t.select("template_id", "sh", F.pow(2, F.ceil(F.log2(F.size("sh")) - 1e-9)).cast("int").alias("s")), "templates")
    known = stored(t.select(F.explode("sh").alias("x"), "s").distinct(), "template-shingles")
    small = fits(known, MAX_BROADCAST_SHINGLES)
    hits = _hashed(docs, "doc_id").select("doc_id", F.posexplode_outer("sh").alias("p", "x")).join(maybe_broadcast(known, small), "x")
    k = F.floor(F.col("p") / F.col("s")).cast("int")
    spots = hits.select("doc_id", "s", F.explode(F.array(k, F.when(k > 0, k - 1))).alias("k")).filter("k is not null").distinct()
    spots = stored(spots.groupBy("doc_id").agg(F.collect_list(F.struct("s", "k")).alias("spots")).withColumnRenamed("doc_id", "at_id"), "spots")

    near = _hashed(docs.select("doc_id", "text").join(spots, F.col("doc_id").eqNullSafe(F.col("at_id"))), "doc_id", "spots")
    # The plain explode adds a test that the array is not empty, and Spark would compute the shingles anew for it in each place.
    # A spot that another row of the same doc_id gave may lie beyond this row's end: its window is empty and shares no band.
    near = near.select("doc_id", F.explode_outer("spots").alias("z"), "sh")
    near = near.select("doc_id", F.col("z.s").alias("s"), F.col("z.k").alias("k"), F.array_distinct(F.slice("sh", F.col("z.s") * F.col("z.k") + 1, 2 * F.col("z.s"))).alias("win"))
    signed = near.select("*", F.posexplode_outer(_bands(F.col("win"))).alias("b", "v"))
    wanted = t.select("template_id", F.col("s").alias("ts"), F.posexplode(_bands(F.col("sh"))).alias("tb", "tv"))  # BANDS rows a template
    pair = (F.col("s") == F.col("ts")) & (F.col("b") == F.col("tb")) & (F.col("v") == F.col("tv"))
    sets = t.select(F.col("template_id").alias("tid"), F.col("sh").alias("tsh"))
    found = signed.join(maybe_broadcast(wanted, fits(wanted, MAX_BROADCAST_SHINGLES)), pair).select("doc_id", "template_id", "s", "k", "win").distinct()
    found = found.join(maybe_broadcast(sets, small), F.col("template_id") == F.col("tid")).select(
        "doc_id", "template_id", "s", "k", F.size("tsh").alias("n_template"), F.size(F.array_intersect("win", "tsh")).alias("n_shared"))
    found = found.filter(F.col("n_shared") >= CONTAINED * F.col("n_template"))
    best = found.groupBy("doc_id", "template_id").agg(F.max(F.struct("n_shared", (-F.col("k") * F.col("s")).alias("at"), "n_template")).alias("m"))
    return best.select("doc_id", "template_id", F.col("m.n_shared").cast("long").alias("n_shared"), F.col("m.n_template").cast("long").alias("n_template"),
                       (-F.col("m.at")).cast("long").alias("word"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in the whole of documents."""
    return scan(read(spark, sf_dir, "documents"), template_table(spark))


_SIGNS, _BLANKS = PUNCTUATION.replace("'", "''"), " " * len(PUNCTUATION)
_VALUES = ",\n  ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in TEMPLATES)
OP2_SQL = rf"""
WITH tpl(template_id, text) AS (VALUES {_VALUES}),
tw AS (SELECT template_id, list_filter(regexp_split_to_array(translate(lower(text), '{_SIGNS}', '{_BLANKS}'), '[ \t-\r]+'), lambda x: translate(x, '{MARKS}', '') <> '') AS w FROM tpl),
ts AS (SELECT DISTINCT template_id, w[i + 1:i + 5] AS sh FROM (SELECT template_id, w, unnest(range(len(w) - 4)) AS i FROM tw)),
tn AS (SELECT template_id, count(*) AS m, CAST(pow(2, ceil(log2(count(*)) - 1e-9)) AS BIGINT) AS s FROM ts GROUP BY template_id),
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(lower(text), '{_SIGNS}', '{_BLANKS}'), '[ \t-\r]+'), lambda x: translate(x, '{MARKS}', '') <> '') AS w
       FROM documents WHERE text IS NOT NULL),
ds AS (SELECT doc_id, i AS p, w[i + 1:i + 5] AS sh FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 0))) AS i FROM dw)),
h AS (SELECT doc_id, template_id, m, s, p // s AS k, sh FROM ds JOIN ts USING (sh) JOIN tn USING (template_id)),
v AS (SELECT doc_id, template_id, m, s, k, sh FROM h UNION ALL SELECT doc_id, template_id, m, s, k - 1, sh FROM h WHERE k > 0),
c AS (SELECT doc_id, template_id, m, s, k, count(DISTINCT sh) AS n FROM v GROUP BY ALL HAVING count(DISTINCT sh) >= 0.8 * m)
SELECT doc_id, template_id, max(n) AS n_shared, max(m) AS n_template, min(k * s) FILTER (n = best) AS word
FROM (SELECT *, max(n) OVER (PARTITION BY doc_id, template_id) AS best FROM c) GROUP BY doc_id, template_id
"""
