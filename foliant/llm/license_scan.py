"""License scans: a trained paragraph classifier with confirmation by templates.

A paragraph is a line of a text; neighbouring lines that look like parts of a notice
are also taken together, as one wrapped paragraph. Its features are hashed words and
pairs of neighbouring words (letters and digits, A-Z lower-cased). A multinomial
logistic regression with an elastic net is trained on variants of the paragraphs of each
family's licence texts, notices and SPDX tag, and on the corpus's own distinct lines, all
of them, as the class ``unknown``: three of four teach, the fourth is held out. It knows the
features that a variant holds; the others tell of no family. A family is predicted where
its probability passes a threshold that is calibrated on all held-out lines; the prediction counts
when the paragraph also shares enough word pairs with a template of that family, and
with every other family less. DataFrame functions and Spark ML only.

Defined results: a null text has no paragraphs; lines without a word are none;
repeated rows each yield their own row; null doc_ids stay null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from foliant.llm.decontaminate import item_words
from foliant.session import materialize, release

UNKNOWN = "unknown"
#: Paragraphs of the public licence texts and notices of each family, as they
#: stand in files and documents.
TEMPLATES = {
    "agpl": ["This work is licensed under the GNU Affero General Public License, version 3.",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
             "You should have received a copy of the GNU Affero General Public License along with this program.",
             "SPDX-License-Identifier: AGPL-3.0-or-later", "SPDX-License-Identifier: AGPL-3.0-only"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
                   "See the License for the specific language governing permissions and limitations under the License.",
                   "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Licensed under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
            "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
            "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "cc0": ["Dedicated to the public domain under CC0 1.0.", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law.",
            "SPDX-License-Identifier: CC0-1.0"],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
                "SPDX-License-Identifier: EPL-2.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
            "You should have received a copy of the GNU General Public License along with this program.",
            "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-2.0-only"],
    "isc": ["Licensed under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
            "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
            "SPDX-License-Identifier: ISC"],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
             "You should have received a copy of the GNU Lesser General Public License along with this library.",
             "SPDX-License-Identifier: LGPL-2.1-or-later", "SPDX-License-Identifier: LGPL-3.0-only"],
    "mit": ["Released under the MIT License.", "This project is licensed under the terms of the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
            "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
            "SPDX-License-Identifier: MIT"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
                "SPDX-License-Identifier: MPL-2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
                  "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
                  "SPDX-License-Identifier: Unlicense"],
    "zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
             "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
             "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
             "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
             "This notice may not be removed or altered from any source distribution.",
             "SPDX-License-Identifier: Zlib"],
}
FAMILIES = [UNKNOWN, *sorted(TEMPLATES)]
#: Variants of a template, and the weight of the lines of unknown class that teach, all together, at most.
VARIANTS, TAUGHT = 24, 2250
#: Tasks of the training at least, and the lines of one.
TASKS, TASK_LINES = 4, 500_000
#: Buckets of the hashed features, the weight of the penalty, the part of it that is L1 (the rest, L2,
#: spreads the weight over all telling words of a notice), and the passes of the training.
BUCKETS, PENALTY, L1, PASSES = 1 << 14, 0.0005, 0.1, 60
#: Hash values of the vocabulary's words and pairs (a multiple of BUCKETS and of 64).
MARKS = 1 << 18
#: Held-out lines of unknown class that may pass the threshold, and its least value.
FALSE_RATE, LEAST = 0.001, 0.5
#: Share of the word pairs of the line or of the template, whichever has fewer, that both must hold,
#: and how many at least.
CONFIRM, LEAST_PAIRS = 0.6, 3
#: Words of which two in a row say nothing about a licence.
PLAIN = ("a an and any are as at be by for from in is it may not of on or shall that the this to under was will with without you").split()


def _pairs(words: Column) -> Column:
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words) + 1),
                      lambda a, b: F.concat_ws(" ", a, b))


def _grams(words: Column) -> Column:
    return F.concat(words, _pairs(words))


def _hashed(grams: Column, values: int) -> Column:
    return F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(values)).cast("int"))


def _buckets(words: Column) -> Column:
    return _hashed(_grams(words), BUCKETS)


def _constant(numbers: list[int], kind: str) -> Column:
    """A constant array, as one text: each literal of a list would be a call."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


def _features(words: Column, vocabulary: list[int], rows: DataFrame) -> DataFrame:
    """``rows`` with ``b``: the distinct buckets of the words and pairs whose hash value is in the vocabulary."""
    bits = [0] * (MARKS // 64)
    for mark in vocabulary:
        bits[mark // 64] |= 1 << mark % 64
    table = _constant([x - (1 << 64) if x >> 63 else x for x in bits], "bigint")

    def listed(mark: Column) -> Column:
        place = F.element_at(table, F.shiftright(mark, 6) + 1)
        return F.call_function("getbit", place, mark.bitwiseAND(F.lit(63))) == 1

    marks = rows.withColumn("_marks", _hashed(_grams(words), MARKS)).withColumn("_marks", F.filter("_marks", listed))
    found = F.transform("_marks", lambda mark: F.pmod(mark, F.lit(BUCKETS)))
    return marks.withColumn("b", F.sort_array(F.array_distinct(found))).drop("_marks")


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, n, text) for family in sorted(TEMPLATES) for n, text in enumerate(TEMPLATES[family])]
    return spark.createDataFrame(rows, "family string, n int, text string").withColumn("w", item_words(F.col("text")))


def _lines(docs: DataFrame) -> DataFrame:
    """``line, h`` of every line with a word; explode_outer, as the plain form would cut every text twice."""
    lines = docs.select(F.explode_outer(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    return lines.where(F.col("line").rlike("[0-9A-Za-z\\x{80}-\\x{10ffff}]")).withColumn("h", F.xxhash64("line"))


def variants(docs: DataFrame) -> DataFrame:
    """``family, w``: variants of the templates.

    Variants drop words by hash and stand alone or between words of a corpus line;
    these words are all that is taken from the VARIANTS lines of lowest hash.
    """
    # by hash first, so that neither the lines are exchanged nor all of them cut into words
    lines = _lines(docs)
    chosen = lines.select("h").distinct().orderBy("h").limit(VARIANTS)
    picked = lines.join(F.broadcast(chosen), "h").dropDuplicates(["h"])
    around = picked.select(item_words(F.col("line")).alias("w")).distinct()
    frame = around.select(F.row_number().over(Window.orderBy(F.xxhash64("w"))).alias("v"), F.slice("w", 1, 6).alias("around"))
    each = _templates(docs.sparkSession).withColumn("v", F.explode(F.sequence(F.lit(1), F.lit(VARIANTS)))) \
        .join(F.broadcast(frame), "v", "left")
    kept = F.filter("w", lambda x, i: (F.col("v") <= 2) | (F.pmod(F.xxhash64(x, i, F.col("v")), F.lit(5)) > 0))
    framed = F.when(F.col("v") % 3 == 0, F.concat(F.coalesce("around", F.array().cast("array<string>")), kept)).otherwise(kept)
    return each.select("family", framed.alias("w"))


def unknown_lines(rows: DataFrame) -> DataFrame:
    """``h, b, held``: every distinct line of unknown class of ``paragraphs``.

    Lines that share a template's word pairs to the confirming share are not of
    unknown class; every fourth line by hash is held out for the threshold.
    """
    listed = [F.lit(" ".join(_words(t))) for texts in TEMPLATES.values() for t in texts]
    noted = F.exists(F.array(*listed), lambda t: _share(F.col("w"), F.split(t, " ")) >= CONFIRM)
    lines = rows.where(F.col("h").isNotNull() & F.when(F.col("w").isNull(), True).otherwise(~noted))
    return lines.select("h", "b").distinct().withColumn("held", F.pmod(F.xxhash64("h"), F.lit(4)) == 0)


def _words(text: str) -> list[str]:
    """The words of a template, by the rule of ``item_words`` (templates are ASCII)."""
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _share(a: Column, b: Column) -> Column:
    """Share of common word pairs, of the list with fewer; 0 where too few are common."""
    pa, pb = F.array_distinct(_pairs(a)), F.array_distinct(_pairs(b))
    common = F.size(F.array_intersect(pa, pb))
    return F.when(common >= LEAST_PAIRS, common / F.greatest(F.least(F.size(pa), F.size(pb)), F.lit(1))).otherwise(F.lit(0.0))


def _one_hot(at: Column, size: int) -> Column:
    """A sparse vector of ones, from the JSON form of the vector type."""
    stored = F.struct(F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), at.alias("indices"),
                               F.transform(at, lambda _: F.lit(1.0)).alias("values")).alias("v"))
    return F.from_json(F.to_json(stored), StructType([StructField("v", VectorUDT())]))["v"]


def train(known: DataFrame, unknown: DataFrame, buckets: list[int]) -> tuple[DataFrame, list[float], float]:
    """Weights (``bucket, weights`` by family), intercepts, and the calibrated threshold.

    ``known``: ``family, b``; ``buckets``: all that these hold, sorted; ``unknown``: ``unknown_lines``, all of which teach or calibrate; those that
    teach weigh together as TAUGHT lines at most, so that the classes keep their shares in corpora of any size.
    Lines with the same features are one example with their number.
    """
    spark = known.sparkSession
    counts = {r["held"]: r["n"] for r in unknown.groupBy("held").agg(F.count(F.lit(1)).alias("n")).collect()}
    taught, n_held = counts.get(False, 0), counts.get(True, 0)
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")).cast("double") - 1
    lines = unknown.where(~F.col("held")).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    learn = known.select(label.alias("label"), F.lit(1.0).alias("weight"), "b").unionByName(
        lines.select(F.lit(0.0).alias("label"), (F.col("n") * F.lit(min(1.0, TAUGHT / max(taught, 1)))).alias("weight"), "b"))
    at = dict(zip(buckets, range(len(buckets))))
    places = _constant([at.get(b, -1) for b in range(BUCKETS)], "int")
    learn = materialize(learn.select("label", "weight", _one_hot(F.transform("b", lambda b: F.element_at(places, b + 1)), len(buckets)).alias("features")))
    model = LogisticRegression(family="multinomial", elasticNetParam=L1, regParam=PENALTY, maxIter=PASSES, standardization=False,
                               weightCol="weight").fit(learn.coalesce(max(TASKS, taught // TASK_LINES)))
    matrix, intercepts = model.coefficientMatrix.toArray(), [float(x) for x in model.interceptVector]
    used = [(buckets[b], [float(x) for x in matrix[:, b]]) for b in matrix.any(axis=0).nonzero()[0]]
    weights = materialize(spark.createDataFrame(used, "bucket int, weights array<double>").coalesce(1))
    high = _percentile(probabilities(unknown.where("held").select(F.col("h").alias("key"), "b"), weights, intercepts), n_held)
    release(learn)
    return weights, intercepts, max(LEAST, high)


def _percentile(scored: DataFrame, n: int) -> float:
    """The probability that FALSE_RATE of the ``n`` rows pass, by their upper end alone; 0 without rows."""
    at = max(n - 1, 0) * (1 - FALSE_RATE)
    upper = scored.select("probability").orderBy(F.desc("probability")).limit(max(n - int(at), 1))
    ends = [r["probability"] for r in upper.orderBy("probability").limit(2).collect()]
    return ends[0] + (ends[-1] - ends[0]) * (at - int(at)) if ends else 0.0


def probabilities(rows: DataFrame, weights: DataFrame, intercepts: list[float]) -> DataFrame:
    """``key, family, probability``: the likeliest family (unknown aside) of each row of ``key, w``
    (or ``key, b``, its distinct buckets).

    ``weights`` has at most BUCKETS rows and is broadcast.
    """
    n = len(intercepts)
    buckets = F.col("b") if "b" in rows.columns else F.array_distinct(_buckets(F.col("w")))
    each = rows.select("key", F.explode_outer(buckets).alias("bucket"))
    sums = each.join(F.broadcast(weights), "bucket", "left").groupBy("key").agg(
        *[F.coalesce(F.sum(F.col("weights")[i]), F.lit(0.0)).alias(f"z{i}") for i in range(n)])
    scored = sums.select("key", F.array(*[F.col(f"z{i}") + F.lit(intercepts[i]) for i in range(n)]).alias("z")) \
        .withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z")))) \
        .withColumn("best", F.array_max(F.transform(F.slice("e", 2, n - 1), lambda x, i: F.struct(x.alias("e"), (-i).alias("i")))))
    total = F.aggregate("e", F.lit(0.0), lambda acc, x: acc + x)
    return scored.select("key", F.element_at(F.lit(FAMILIES[1:]), 1 - F.col("best.i")).alias("family"),
                         F.round(F.col("best.e") / total, 9).alias("probability"))


def _template_pairs() -> list[str]:
    """The telling word pairs of the templates: not both words are plain."""
    pairs = set()
    for texts in TEMPLATES.values():
        for text in texts:
            w = _words(text)
            pairs.update(f"{a} {b}" for a, b in zip(w, w[1:]) if a not in PLAIN or b not in PLAIN)
    return sorted(pairs)


def paragraphs(docs: DataFrame, vocabulary: list[int]) -> DataFrame:
    """A row of every line with a word (``rid, doc_id, n_paragraphs, at, h, b, w``), or one without line
    of a document that has none. ``h, b``: hash and distinct buckets of the vocabulary. ``w`` only of lines
    that hold a telling word pair of any template; only such lines can be confirmed."""
    w, telling = F.col("x.w"), ", ".join(f"'{p}'" for p in _template_pairs())
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.struct(i.alias("at"), item_words(x).alias("w")))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                       F.filter(lines, lambda x: F.size(x["w"]) > 0).alias("_lines"))
    rows = rows.select("rid", "doc_id", F.size("_lines").cast("long").alias("n_paragraphs"), F.explode_outer("_lines").alias("x"))
    rows = _features(w, vocabulary, rows).withColumn("_pairs", _pairs(w))
    return rows.select("rid", "doc_id", "n_paragraphs", F.col("x.at").alias("at"), F.when(w.isNotNull(), F.xxhash64(w)).alias("h"), "b",
                       F.when(F.expr(f"exists(_pairs, p -> p in ({telling}))"), w).alias("w"))


def wrapped(rows: DataFrame) -> DataFrame:
    """``rid, at, until, w``: the lines of ``paragraphs``, and every stretch of two or more
    neighbouring ones as one paragraph."""
    lines = rows.where("w is not null").select("rid", "at", "w")
    by_line = Window.partitionBy("rid").orderBy("at")
    joined = lines.withColumn("_g", F.col("at") - F.row_number().over(by_line)).groupBy("rid", "_g").agg(
        F.min("at").alias("at"), F.max("at").alias("until"), F.array_sort(F.collect_list(F.struct("at", "w"))).alias("_all"))
    joined = joined.where("until > at").select("rid", "at", "until", F.flatten(F.transform("_all", lambda x: x["w"])).alias("w"))
    return lines.select("rid", "at", F.col("at").alias("until"), "w").unionByName(joined)


def classified(rows: DataFrame, vocabulary: list[int], weights: DataFrame, intercepts: list[float], threshold: float) -> DataFrame:
    """``rid, at, until, family, probability, share``: the confirmed lines and wrapped paragraphs."""
    lines = wrapped(rows).select(F.struct("rid", "at", "until").alias("key"), "w")
    features = _features(F.col("w"), vocabulary, lines).select("key", "b")
    predicted = probabilities(features, weights, intercepts).where(F.col("probability") >= threshold)

    def best(texts: Column) -> Column:
        return F.aggregate(texts, F.lit(0.0), lambda acc, t: F.greatest(acc, _share(F.col("w"), t)))

    families = sorted(TEMPLATES)
    temps = F.create_map(*[x for f in families for x in (F.lit(f), F.array(*[F.lit(_words(t)) for t in TEMPLATES[f]]))])
    near = lines.join(predicted, "key").withColumn("share", best(F.element_at(temps, F.col("family")))).where(F.col("share") >= CONFIRM)
    # a part that fits another family's template as well says nothing
    others = F.array_max(F.transform(F.map_entries(temps), lambda e: F.when(e["key"] != F.col("family"), best(e["value"])).otherwise(F.lit(0.0))))
    return near.where(F.col("share") > others).select("key.rid", "key.at", "key.until", "family", "probability", "share")


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_paragraphs, n_licensed, families, probability`` of every row of ``docs`` (``doc_id, text``).
    ``n_licensed``: the lines that are confirmed by themselves or as part of a wrapped paragraph."""
    docs = docs.select("doc_id", "text")
    texts = materialize(variants(docs))
    vocabulary = sorted(r["m"] for r in texts.select(F.explode(_hashed(_grams(F.col("w")), MARKS)).alias("m")).distinct().collect())
    rows = materialize(paragraphs(docs, vocabulary))
    unknown = materialize(unknown_lines(rows))
    known = texts.select("family", F.sort_array(F.array_distinct(_buckets(F.col("w")))).alias("b"))
    weights, intercepts, threshold = train(known, unknown, sorted({m % BUCKETS for m in vocabulary}))
    release(texts, unknown)
    confirmed = materialize(classified(rows, vocabulary, weights, intercepts, threshold))
    found = confirmed.groupBy("rid").agg(F.array_join(F.array_sort(F.collect_set("family")), ",").alias("f"), F.max("probability").alias("p"))
    lines = confirmed.select("rid", F.explode(F.sequence("at", "until")).alias("at")).distinct().groupBy("rid").agg(F.count(F.lit(1)).alias("n"))
    heads = rows.select("rid", "doc_id", "n_paragraphs").distinct()
    return heads.join(found.join(lines, "rid"), "rid", "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n", F.lit(0)).cast("long").alias("n_licensed"),
        F.coalesce("f", F.lit("")).alias("families"), F.coalesce("p", F.lit(0.0)).alias("probability"))
