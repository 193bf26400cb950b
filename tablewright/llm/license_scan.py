"""Operator 2: license scans by diagonal voting.

Templates are a table: telling sentences, identifiers, and whole bodies of
licenses.  Every rolling word k-gram of every text is joined with the places
where templates have that k-gram, on its hash and its words; short templates
take pairs, long ones k words.  A match at word i of a text and word t of a
template votes for diagonal i - t.  Votes are summed by diagonal; diagonals of
a template that lie close together (words put in or left out shift them) are
merged, every run of them that may hold the template on its own; and a merged
span counts as found if enough of the template's words lie on it in order."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import texts_of

#: Fixed: the base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Fixed: telling sentences of common licenses and their labels.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "licensed under a creative commons attribution": "cc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: Fixed: SPDX identifiers of common licenses.
IDENTIFIERS = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
               "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0",
               "Unlicense", "Zlib", "BSL-1.0")

#: Fixed: the texts of common licenses, or the notices that stand for them in files, and their labels.
BODIES = {
    """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
    (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
    publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
    subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
    substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
    BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
    AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
    ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""": "mit",
    """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
    that the above copyright notice and this permission notice appear in all copies.""": "isc",
    """The software is provided "as is" and the author disclaims all warranties with regard to this software including all implied
    warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential
    damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other
    tortious action, arising out of or in connection with the use or performance of this software.""": "isc",
    """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
    conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
    disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
    disclaimer in the documentation and/or other materials provided with the distribution.""": "bsd",
    """This software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but
    not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the
    copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages
    (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption)
    however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise)
    arising in any way out of the use of this software, even if advised of the possibility of such damage.""": "bsd",
    """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
    You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
    writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
    either express or implied. See the License for the specific language governing permissions and limitations under the
    License.""": "apache-2.0",
    """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
    published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
    distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
    FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""": "gpl",
    """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
    this file, You can obtain one at https://mozilla.org/MPL/2.0/.""": "mpl",
    """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
    sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial,
    and by any means.""": "unlicense",
    """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
    damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
    commercial applications, and to alter it and redistribute it freely, subject to the following restrictions""": "zlib",
    "THE SOFTWARE IS PROVIDED \"AS IS\"": "as-is",
}

#: Words in a k-gram of a long template; one of less than four times as many words takes pairs.
K = 3
#: A merged span must hold this share of a template's words, in at most this many times its length.
SHARE, STRETCH = 0.8, 1.5
#: So many words may be put into a template, however short it is.
PUT_IN = 3
#: Diagonals at most this far apart count together as they are; others, if their words come in the template's order.
NEAR = 2
#: Most template word pairs for which they are broadcast; more are joined by shuffle.
MOST_BROADCAST = 100_000

#: What separates words: ASCII characters other than digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The text's words, in their own case."""
    return F.filter(F.split(text, _BETWEEN), lambda w: w != "")


def template_table(spark: SparkSession, phrases: dict[str, str] = TEMPLATES, bodies: dict[str, str] = BODIES,
                   identifiers: tuple[str, ...] = IDENTIFIERS) -> DataFrame:
    """The library's templates as a table: label, text, least (the share of its
    words that a span must hold; null: ``SHARE``).  An identifier must be whole:
    behind its SPDX tag, after "licensed under", or, from four words on, alone."""
    rows = [(label, text, None) for text, label in (*phrases.items(), *bodies.items())]
    for name in identifiers:
        alone = [name] if len(re.findall("[0-9A-Za-z]+", name)) >= 4 else []
        rows += [(name.lower(), text, 1.0) for text in (f"SPDX-License-Identifier: {name}", f"licensed under {name}", *alone)]
    return spark.createDataFrame(rows, "label string, text string, least double")


def template_grams(base: dict[str, str], templates: DataFrame, k: int) -> DataFrame:
    """One row for each place of each template: template (its own hash), label,
    base, size (words), least, k, t (place) and gram (k words)."""
    spark = templates.sparkSession
    phrases = spark.createDataFrame([(label, phrase) for phrase, label in base.items()], "label string, text string")
    least = F.col("least").cast("double") if "least" in templates.columns else F.lit(None).cast("double")
    both = (phrases.select("label", "text", F.lit(True).alias("base"), F.lit(1.0).alias("least"))
            .union(templates.select("label", "text", F.lit(False), F.coalesce(least, F.lit(SHARE)))))
    own = both.select("label", "base", "least", words(F.translate("text", _UPPER, _LOWER)).alias("w")).withColumn("size", F.size("w"))
    own = own.withColumn("k", F.when(F.col("base") | (F.col("size") < 4 * k), 2).otherwise(k))
    short = F.raise_error(F.concat(F.lit("a template needs two words at least: "), F.coalesce(F.array_join("w", " "), F.lit("null"))))
    own = own.where(F.when(F.col("size") >= 2, True).otherwise(short.cast("boolean")))
    named = own.withColumn("template", F.md5(F.concat_ws("/", F.col("base").cast("string"), "label", F.array_join("w", " ")))).dropDuplicates(["template"])
    return (named.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k"))))
            .withColumn("gram", F.array_join(F.slice("w", F.col("t") + 1, F.col("k")), " ")).drop("w"))


def _gram_hash(w: Column, i: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.lower(F.element_at(w, i + n)) for n in range(1, k + 1)])


def scan(docs: DataFrame, base: dict[str, str] = BASE, templates: DataFrame | dict[str, str] | None = None,
         id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base (places of base
    phrases), first_word and last_word (smallest and largest start of a base
    phrase, else null), base_labels, labels, score (best share of a template's
    words found in a span, 0 to 1) and spans (template label, first and last
    word, share).

    ``templates`` is a table of label, text and, if wanted, least (see
    ``template_table``, which is taken if there is none), or a dict from text
    to label; a template of less than two words fails the job.  ``k`` words
    make a gram of a template of 4 * k words or more, two of a shorter one.

    A null or empty text has no words and no labels (empty strings).  Rows
    that repeat give rows that repeat."""
    spark = docs.sparkSession
    if k < 2:
        raise ValueError("a gram needs two words at least")
    if templates is None:
        templates = template_table(spark)
    elif isinstance(templates, dict):
        templates = template_table(spark, templates, {}, ())
    own_grams = template_grams(base, templates, k)
    about = own_grams.agg(F.count(F.lit(1)).alias("n"), F.max(F.when(~F.col("base"), (STRETCH - F.col("least")) * F.col("size"))).alias("reach"),
                          F.array_sort(F.collect_set("k")).alias("ks")).first()
    ks = about["ks"] or [2]
    # the gram's words are lower-cased already: lower() leaves them as they are
    by_hash = own_grams.withColumn("h", F.coalesce(*[F.when(F.col("k") == n, _gram_hash(F.split("gram", " "), F.lit(0), n)) for n in ks]))
    split = (texts_of(docs, id_col, text_col)
             .select("doc_id", words("text").alias("w"))
             .withColumn("rid", F.monotonically_increasing_id()))
    # a row for each word and length of gram, and one (i = -1) that carries the document through
    rows = F.sequence(F.lit(-1), F.greatest(len(ks) * (F.size("w") - 1), F.lit(0)) - 1)
    places = split.select("rid", "doc_id", "w", F.explode(rows).alias("p"))
    places = places.select("rid", "doc_id", "w", F.floor(F.col("p") / len(ks)).cast("int").alias("i"), F.pmod("p", F.lit(len(ks))).alias("which"))
    i = F.col("i")
    grams = places.select(
        "rid", "doc_id", F.size("w").alias("n_words"), "i",
        F.coalesce(*[F.when((i >= 0) & (F.col("which") == at) & (i + n <= F.size("w")), _gram_hash(F.col("w"), i, n)) for at, n in enumerate(ks)]).alias("h"),
        *[F.array_join(F.slice("w", F.greatest(i, F.lit(0)) + 1, n), " ").alias(f"gram_{n}") for n in ks])
    if about["n"] <= MOST_BROADCAST:
        by_hash = F.broadcast(by_hash)
    # lower() folds a few letters outside ASCII onto a-z; the words themselves decide
    same = F.coalesce(*[F.when(F.col("k") == n, F.translate(f"gram_{n}", _UPPER, _LOWER) == F.col("gram")) for n in ks])
    votes = (grams.join(by_hash, "h", "left")
             .where((i == -1) | F.col("template").isNotNull() & same)
             .withColumn("diagonal", i - F.col("t")))
    of_doc = ["rid", "doc_id", "n_words"]
    of_template = ["template", "label", "base", "size", "least", "k"]
    by_diagonal = votes.groupBy(*of_doc, *of_template, "diagonal").agg(
        F.count("t").alias("votes"), F.collect_set("t").alias("ts"))
    # base phrases stand word by word: their diagonals stay apart.  A template's span may begin at any diagonal and end at
    # any within reach: a stray pair nearby then spoils no span, and what is gathered follows the templates' length.
    room = F.greatest(F.lit(float(PUT_IN)), (STRETCH - 1) * F.col("size"))
    reach = max(PUT_IN, int((about["reach"] or 0) + 1))
    own_reach = F.greatest(F.lit(float(PUT_IN)), (STRETCH - F.col("least")) * F.col("size") + 1)
    ahead = Window.partitionBy(*of_doc, "template").orderBy("diagonal").rangeBetween(0, reach)
    alone = F.coalesce(F.col("base"), F.lit(True))  # also the row that carries the document

    def hit(ts: Column) -> Column:  # the template words that lie on the span
        return F.array_distinct(F.flatten(F.transform(ts, lambda t: F.sequence(t, t + F.col("k") - 1))))

    run = F.col("run")
    close = ~F.exists(run, lambda y: ~F.exists(run, lambda x: (x["diagonal"] < y["diagonal"]) & (y["diagonal"] - x["diagonal"] <= NEAR))
                      & (y["diagonal"] != run[0]["diagonal"]))
    # in the order of the text, the template's words must not step back
    along_text = F.array_sort(F.flatten(F.transform(run, lambda x: F.transform(x["ts"], lambda t: F.struct((x["diagonal"] + t).alias("at"), t.alias("t"))))))
    ordered = F.aggregate(along_text, F.struct(F.lit(True).alias("ok"), F.lit(-1).alias("t")),
                          lambda acc, x: F.struct((acc["ok"] & (acc["t"] <= x["t"])).alias("ok"), x["t"].alias("t")))["ok"]
    own = F.struct("diagonal", "ts")
    merged = (by_diagonal.withColumn("near", F.when(alone, F.array(own)).otherwise(F.array_sort(F.collect_list(own).over(ahead))))
              .withColumn("near", F.filter("near", lambda x: F.coalesce(x["diagonal"] - F.col("diagonal") <= own_reach, F.lit(True))))
              .where(alone | (F.size(hit(F.flatten("near.ts"))) >= F.col("least") * F.col("size")))
              .withColumn("run", F.explode(F.transform(F.sequence(F.lit(1), F.size("near")), lambda n: F.slice("near", 1, n))))
              .select(*of_doc, *of_template, F.col("diagonal").alias("lo"), "run", F.flatten("run.ts").alias("ts")))
    # verify: the template words that lie on the span, and how far it reaches
    checked = (merged.withColumn("share", F.size(hit(F.col("ts"))) / F.col("size"))
               .withColumn("start", F.array_min(F.transform("run", lambda x: x["diagonal"] + F.array_min(x["ts"]))))
               .withColumn("end", F.array_max(F.transform("run", lambda x: x["diagonal"] + F.array_max(x["ts"]))) + F.col("k") - 1)
               .where(F.col("template").isNull() | F.col("base") | (F.col("share") >= F.col("least")))
               .withColumn("ok", F.when(F.col("base"), F.size(F.array_distinct("ts")) == F.col("size") - 1)
                           .otherwise((close | ordered) & (F.col("share") >= F.col("least")) & (F.col("end") - F.col("start") + 1 <= F.col("size") + room)))
               .where(F.col("ok") | F.col("template").isNull()))
    # of spans that overlap, the best stays
    along = Window.partitionBy(*of_doc, "template").orderBy("start", "end", F.desc("share"))
    until = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    checked = (checked.withColumn("new", F.when(alone | F.coalesce(F.col("start") > until, F.lit(True)), 1).otherwise(0))
               .withColumn("span", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
               .groupBy(*of_doc, *of_template, "span")
               .agg(F.max_by(F.struct("lo", "start", "end", "share", "ok"), F.struct("share", F.col("start") - F.col("end"), -F.col("start"))).alias("best"))
               .select(*of_doc, *of_template, "best.*"))
    is_base = F.col("ok") & F.col("base")

    def listed(c: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(c)), ",")

    return checked.groupBy(*of_doc).agg(
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("lo"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("lo"))).cast("long").alias("last_word"),
        listed(F.when(is_base, F.col("label"))).alias("base_labels"),
        listed(F.when(F.col("ok"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("ok"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("ok"), F.struct("label", "start", "end", "share")))).alias("spans"),
    ).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
             "base_labels", "labels", "score", "spans")
