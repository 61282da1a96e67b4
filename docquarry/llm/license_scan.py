"""License texts and notices by diagonal voting.

All of it is DataFrame operations. All rolling groups of three words of every text are hashed and
joined with those of the templates, a table of fixed size; phrases, and notices of two words, are
joined by pairs. A hit votes for the diagonal (place
in the text minus place in the template) of its template. Votes are counted per diagonal,
neighbouring diagonals are merged, as words put in or left out shift the place, and a merged span
counts if the template places it hits cover enough of the template; of a short one, all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``exact``: every word must stand there, in order, without others between."""

    label: str
    text: str
    exact: bool = False


# The phrases and labels of the contract.
PHRASES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)

# Well-known public license texts, whole, after their titles and copyright lines.
TEXTS = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
        "and or other materials provided with the distribution "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors "
        "be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods "
        "or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability "
        "or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    ),
    Template(
        "bsd-3-clause",
        "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright "
        "notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability "
        "and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from "
        "loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of "
        "this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it "
        "freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original "
        "software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required "
        "2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software "
        "3 this notice may not be removed or altered from any source distribution",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software "
        "either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the "
        "license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing "
        "permissions and limitations under the license",
    ),
)

# Well-known public notices.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("mit", "released under the mit license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("apache-2.0", "spdx license identifier apache 2 0"),
    Template("mit", "mit license"),
    Template("mit", "spdx license identifier mit"),
    Template("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-3.0", "gnu gpl v3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    *TEXTS,
)

#: Everything but letters, digits and non-ASCII characters parts words; A-Z are lower-cased later.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


#: Words of a hashed group, of phrases and notices of two words, and of all other templates.
_SHORT, _LONG = 2, 3


@dataclass(frozen=True)
class LicenseParams:
    """``shift``: diagonals at most so far apart are merged. ``covered``: share of a template's groups that is a
    find; of a template with fewer than ``whole_under`` groups, all must be there."""

    shift: int = 3
    covered: float = 0.6
    whole_under: int = 8


def _words(text: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), _BETWEEN), lambda w: w != "")


def _rolling(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``words`` and ``size``) as one row per place ``at`` and ``gram``, the hash of the two words, and of the three, from there.

    The words are exploded beside their array, so that hashing and the join stay in generated code.
    Groups cut short by the end of the text hash like shorter ones; the join tells them apart by the template's ``k``.
    """
    words = rows.select("*", F.posexplode("words").alias("at", "word"))
    second, third = (F.get("words", F.col("at") + i) for i in (1, 2))
    grams = F.array(F.xxhash64("word", second), F.xxhash64("word", second, third))
    return words.select(*[c for c in rows.columns if c != "words"], "at", F.explode(grams).alias("gram"))


def _group(template: Template) -> int:
    return _SHORT if template.exact or len(template.text.split()) < _LONG else _LONG


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(gram, template, label, exact, k, place, n_grams) of every group of ``k`` words of every template: as large as ``templates``."""
    rows = [(i, t.label, t.exact, k, " ".join(words[at : at + k]), at, len(words) - k + 1) for i, t in enumerate(templates) for k, words in [(_group(t), t.text.split())] for at in range(len(words) - k + 1)]
    table = spark.createDataFrame(rows, "template int, label string, exact boolean, k int, words string, place int, n_grams int").withColumn("words", _words(F.col("words")))
    pair = F.xxhash64(F.get("words", F.lit(0)), F.get("words", F.lit(1)))
    triple = F.xxhash64(F.get("words", F.lit(0)), F.get("words", F.lit(1)), F.get("words", F.lit(2)))
    return table.withColumn("gram", F.when(F.col("k") == _SHORT, pair).otherwise(triple)).drop("words")


def license_spans(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES, params: LicenseParams = LicenseParams()) -> DataFrame:
    """(doc_id, text_key, template, label, exact, first_word, last_word, covered) of every find in ``docs`` (doc_id, text).

    ``text_key`` hashes the text, as ids may repeat. Words count from 0. Templates need two words or
    more. Rows that are equal in id and text give their finds once.
    """
    return _spans(_texts(docs), templates, params)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), _words(text).alias("words"))


def _votes(texts: DataFrame, templates: Sequence[Template]) -> DataFrame:
    known = F.broadcast(template_grams(texts.sparkSession, templates))
    hits = _rolling(texts.withColumn("size", F.size("words"))).join(known, "gram").where(F.col("at") + F.col("k") <= F.col("size"))
    return hits.select("doc_id", "text_key", "size", "template", "label", "exact", "n_grams", "k", (F.col("at") - F.col("place")).alias("diagonal"), "at", "place")


def _spans(texts: DataFrame, templates: Sequence[Template], params: LicenseParams) -> DataFrame:
    key = ["doc_id", "text_key", "size", "template", "label", "exact", "n_grams", "k"]
    votes = _votes(texts, templates).distinct()
    lines = votes.groupBy(*key, "diagonal").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("place").alias("places"))

    # Diagonals are grouped by their distance alone: one that a repeated group of the template votes for lies
    # apart from its neighbours in number, wherever in the text it stands, and so splits no span. Those of
    # an exact phrase stay by themselves.
    in_text = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    beside = F.lag("diagonal").over(in_text)
    apart = F.col("exact") | beside.isNull() | (F.col("diagonal") - beside > params.shift)
    merged = lines.withColumn("span", F.sum(apart.cast("int")).over(in_text)).groupBy(*key, "span").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min_by("diagonal", F.struct("first", "diagonal")).alias("from_first"),
        F.max_by("diagonal", F.struct("last", "diagonal")).alias("from_last"),
        (F.size(F.array_distinct(F.flatten(F.collect_list("places")))) / F.first("n_grams")).alias("covered"),
    )
    enough = F.when(F.col("exact") | (F.col("n_grams") < params.whole_under), 1.0).otherwise(params.covered)
    # The words that were put in may not outnumber those of the template.
    kept = merged.where((F.col("covered") >= enough) & (F.col("last") - F.col("first") < 2 * F.col("n_grams")))
    # An edit next to an end of the template hides the k - 1 words beyond it: they are taken in, as far as the template goes.
    first = F.greatest(F.lit(0), F.least("first", F.greatest("from_first", F.col("first") - (F.col("k") - 1))))
    end, whole = F.col("last") + F.col("k") - 1, F.col("from_last") + F.col("n_grams") + F.col("k") - 2
    end = F.least(F.col("size") - 1, F.greatest(end, F.least(whole, end + F.col("k") - 1)))
    return kept.select("doc_id", "text_key", "template", "label", "exact", first.alias("first_word"), end.alias("last_word"), "covered")


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES, params: LicenseParams = LicenseParams()) -> DataFrame:
    """Licenses of every whole text of ``docs`` (doc_id, text).

    One row per input row: ``doc_id``, ``n_words``, ``n_base`` (places of exact phrases),
    ``first_word`` and ``last_word`` (their least and largest start, null without one),
    ``base_labels`` and ``labels`` (of exact phrases, and of all templates: distinct, sorted, joined by commas),
    ``score`` (largest share of a template that was found, 0 without a find).

    Defined cases: a null or empty text has no words and no labels. Rows with a null id, or that
    repeat one, are scanned each. An empty table gives an empty result. Other columns are ignored.
    """
    texts = _texts(docs)
    spans = _spans(texts, templates, params)
    found = spans.groupBy("doc_id", "text_key").agg(
        F.count(F.when(F.col("exact"), 1)).alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first_word"))).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base"),
        F.array_sort(F.collect_set("label")).alias("all"),
        F.max("covered").alias("covered"),
    )
    rows = texts.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_key"] == found["text_key"])
    return rows.join(found, same, "left").select(
        rows["doc_id"],
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce(F.array_join("base", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("all", ","), F.lit("")).alias("labels"),
        F.coalesce("covered", F.lit(0.0)).alias("score"),
    )
