"""License scans: units of a text against licence templates by Dice coefficient.

Units are the lines of a text, the whole text if it has several lines with words,
and word windows: where a text has one of the template's anchor bigrams, as many
words as the template has, placed so that the bigram stands where the template
has it, cut at the ends of the text and then at the outermost bigrams it shares
with the template. So notices are found that are wrapped over lines, stand inside
a longer line, or are part of a longer licence text. Units and templates are
normalised to lower-case letters and digits and seen as sets of word bigrams; a
unit carries a licence if Dice = 2 |A n B| / (|A| + |B|) with one of its templates
reaches ``DICE``. Dice can only reach d if |A| lies between |B| d / (2 - d) and
|B| (2 - d) / d, so a template is listed under each size in these bounds and a
unit meets only the templates under its own size, by an equality join.

Such a unit shares at least the least overlap of these sizes, so it holds one of
any |B| - least + 1 bigrams of the template: the longest ones, which are rare in
other texts, are its anchors. Texts without any anchor are left out by one pattern
search, before they are cut into words; this loses no unit. Equal texts are compared once.

DataFrame functions only. The templates are a parameter of the job, at most
``MAX_TEMPLATES`` of them, and are broadcast.

Defined results
    null or empty text: no licence; a unit of fewer than two words has no bigram
    and never matches; ties: every template that reaches the bound counts, a
    licence once per unit; repeated rows: the same result; very long texts are
    compared whole; empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vehiscope.llm.common import scratch, table, written

DICE = 0.8
MAX_TEMPLATES = 10_000
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Notices, licence texts and openings of licence texts (licence, text).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction,"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _bigrams(words: Column) -> Column:
    return F.transform(F.array(words), lambda w: F.when(F.size(w) >= 2, F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(w) - 2),
        lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1))))).otherwise(F.array().cast("array<string>")))[0]


def bigrams(text: Column, least: int = 1, most: int | None = None) -> Column:
    """The distinct word bigrams of a text; none if their number is surely not in
    least..most: a text has fewer bigrams than words, and at least one less than
    it has different words."""
    def pruned(w: Column) -> Column:
        out = F.size(w) <= least
        if most is not None:
            out = out | (F.size(F.array_distinct(w)) > most + 1)
        return F.when(out, F.array().cast("array<string>")).otherwise(_bigrams(w))

    return F.transform(F.array(_words(text)), pruned)[0]


def template_words(text: str) -> list[str]:
    """The words of a template, on the driver."""
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    """Its distinct bigrams."""
    w = template_words(text)
    return list(dict.fromkeys(" ".join(p) for p in zip(w, w[1:])))


def size_bounds(n: int, dice: float) -> range:
    """Sizes that can reach the coefficient with a set of n."""
    return range(max(1, math.ceil(n * dice / (2 - dice) - 1e-9)), math.floor(n * (2 - dice) / dice + 1e-9) + 1)


def anchors(text: str, dice: float) -> list[tuple[str, int]]:
    """``(bigram, place)`` of a template's longest bigrams: so many that a unit
    without any of them cannot reach the coefficient."""
    w = template_words(text)
    own = template_bigrams(text)
    if not own:
        return []
    least = min(math.ceil(dice * (n + len(own)) / 2 - 1e-9) for n in size_bounds(len(own), dice))
    chosen = set(sorted(own, key=lambda g: (-len(g), g))[:len(own) - least + 1])
    return [(g, i) for i, g in enumerate(" ".join(p) for p in zip(w, w[1:])) if g in chosen]


def bigram_pattern(grams: list[str]) -> str:
    """A pattern that a lower-cased text holds just if one of the bigrams is among
    its word bigrams; it is tried where a word starts."""
    following: dict[str, list[str]] = {}
    for first, second in sorted(g.split(" ") for g in grams):
        following.setdefault(first, []).append(second)
    if not following:
        return "(?!)"
    word, between = WORD.removesuffix("+"), "[" + WORD.removeprefix("[^")
    return f"(?<!{word})(?:" + "|".join(
        rf"\Q{first}\E{between}(?:" + "|".join(rf"\Q{w}\E" for w in seconds) + ")"
        for first, seconds in following.items()) + f")(?!{word})"


def _neighbours(words: str) -> Column:
    """The bigrams of a column of words, in order."""
    return F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
                      lambda a, b: F.concat_ws(" ", a, b))


def _windows(texts: DataFrame, templates: list[tuple[str, str]], dice: float) -> DataFrame:
    """``digest, line (-2), word, license, dice`` of the word windows that match."""
    spark = texts.sparkSession
    at = spark.createDataFrame([(g, k, i) for k, (_, text) in enumerate(templates) for g, i in anchors(text, dice)],
                               "gram string, template int, place int")
    known = spark.createDataFrame(
        [(k, name, len(template_words(text)), own, min(bounds), max(bounds)) for k, (name, text) in enumerate(templates)
         for own in [template_bigrams(text)] if own for bounds in [size_bounds(len(own), dice)]],
        "template int, license string, words int, own array<string>, least int, most int")
    starts = (texts.select("digest", F.posexplode(_neighbours("words")).alias("pos", "gram"))
              .join(F.broadcast(at), "gram").select("digest", "template", (F.col("pos") - F.col("place")).alias("start"))
              .distinct())
    lo = F.greatest(F.col("start"), F.lit(0))
    hi = F.least(F.col("start") + F.col("words_"), F.size("words"))
    cut = (starts.join(texts.select("digest", "words"), "digest")
           .join(F.broadcast(known.withColumnRenamed("words", "words_")), "template")
           .select("digest", "license", "own", "least", "most", lo.alias("lo"),
                   F.slice("words", lo + 1, hi - lo).alias("w")))
    # the anchor itself is shared, so a window has a first and a last shared bigram
    grams = cut.withColumn("g", F.slice(_neighbours("w"), F.lit(1), F.size("w") - 1))
    shared = grams.withColumn("at", F.filter(F.sequence(F.lit(0), F.size("g") - 1),
                                             lambda i: F.array_contains(F.col("own"), F.get("g", i))))
    first, last = F.get("at", F.lit(0)), F.get("at", F.size("at") - 1)
    unit = shared.select("digest", "license", "own", "least", "most", (F.col("lo") + first).alias("word"),
                         F.array_distinct(F.slice("g", first + 1, last - first + 1)).alias("grams"))
    both = F.size(F.array_intersect("grams", "own"))
    return (unit.where(F.size("grams").between(F.col("least"), F.col("most")))
            .withColumn("dice", 2 * both / (F.size("grams") + F.size("own"))).where(F.col("dice") >= dice)
            .groupBy("digest", F.lit(-2).alias("line"), "word", "license").agg(F.max("dice").alias("dice")))


def _text_matches(docs: DataFrame, templates: list[tuple[str, str]], dice: float) -> DataFrame:
    """``digest, line, word, license, dice`` of every match of the distinct texts."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError("more templates than may be broadcast")
    sized = [(size, k, name, own) for k, (name, text) in enumerate(templates)
             for own in [template_bigrams(text)] for size in size_bounds(len(own), dice) if own]
    sizes = [size for size, *_ in sized] or [1]
    least, most = min(sizes), max(sizes)
    spark = docs.sparkSession
    by_size = spark.createDataFrame(sized, "n int, template int, license string, own array<string>")
    rare = sorted({g for _, text in templates for g, _ in anchors(text, dice)})
    held = (docs.where(F.lower("text").rlike(bigram_pattern(rare)))
            .select("text", _words(F.col("text")).alias("words")))
    texts = written(held.groupBy(F.md5(F.col("text").cast("binary")).alias("digest"))
                    .agg(F.first("text").alias("text"), F.first("words").alias("words")), "licence-texts")
    lines = F.split("text", "\n")
    units = F.concat(F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("unit"))),
                     F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit"))))
                     .otherwise(F.array().cast("array<struct<line:int,unit:string>>")))
    found = (texts.select("digest", F.explode(units).alias("u"))
             .select("digest", "u.line", bigrams(F.col("u.unit"), least, most).alias("grams"))
             .withColumn("n", F.size("grams")).where("n > 0"))
    both = F.size(F.array_intersect("grams", "own"))
    found = (found.join(F.broadcast(by_size), "n")
             .withColumn("dice", 2 * both / (F.size("grams") + F.size("own"))).where(F.col("dice") >= dice)
             .groupBy("digest", "line", F.lit(None).cast("int").alias("word"), "license").agg(F.max("dice").alias("dice")))
    return found.unionByName(_windows(texts, templates, dice))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, dice: float = DICE) -> DataFrame:
    """``doc_id, digest, line, word, license, dice`` of every match, the best template
    of a licence per unit; line -1 is the whole text, line -2 a window, which
    starts at word number ``word`` of the text."""
    with scratch(docs.sparkSession):
        matches = written(_text_matches(docs, TEMPLATES if templates is None else templates, dice), "licence-matches", keep=True)
    own = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    return own.distinct().join(matches, "digest").select("doc_id", "digest", "line", "word", "license", "dice")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document: how many lines (with the whole text) and windows
    carry one, and which."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark):
        per_text = written(_text_matches(docs, TEMPLATES, DICE).groupBy("digest").agg(
            F.countDistinct(F.when(F.col("line") >= -1, F.col("line"))).alias("n_units"),
            F.countDistinct("word").alias("n_windows"), F.array_sort(F.collect_set("license")).alias("names"),
            F.max("dice").alias("best")), "licence-matches", keep=True)
    own = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    return own.join(per_text, "digest", "left").select(
        "doc_id", F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"), F.col("best").alias("best_dice"))


def _templates_sql() -> str:
    rows = [f"({k}, '{name}', '{g}')" for k, (name, text) in enumerate(TEMPLATES) for g in template_bigrams(text)]
    return "(VALUES " + ", ".join(rows) + ") AS v(template, license, g)"


def _anchors_sql() -> str:
    rows = [f"({k}, {len(template_words(text))}, '{g}', {i})" for k, (_, text) in enumerate(TEMPLATES)
            for g, i in anchors(text, DICE)]
    return "(VALUES " + ", ".join(rows) + ") AS v(template, words, g, place)"


OP9_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT k, unnest(range(0, len(ls))) AS line, unnest(ls) AS unit FROM d
  UNION ALL SELECT k, -1, text FROM d WHERE len(ls) > 1),
w AS (SELECT k, line, regexp_extract_all(lower(unit),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM u),
g AS MATERIALIZED (SELECT DISTINCT k, line, w[i] || ' ' || w[i + 1] AS g
  FROM (SELECT k, line, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) >= 2)),
n AS (SELECT k, line, count(*) AS n FROM g GROUP BY k, line),
t AS (SELECT * FROM {_templates_sql()}),
tn AS (SELECT template, license, count(*) AS n FROM t GROUP BY template, license),
m AS (SELECT k, line, template, count(*) AS c FROM g JOIN t USING (g) GROUP BY k, line, template),
f AS (SELECT k, line, NULL AS word, license, 2 * c / CAST(n.n + tn.n AS DOUBLE) AS dice FROM m JOIN n USING (k, line) JOIN tn USING (template)),
tw AS MATERIALIZED (SELECT k, regexp_extract_all(lower(text), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM d),
pg AS MATERIALIZED (SELECT k, i, w[i] || ' ' || w[i + 1] AS g FROM (SELECT k, w, unnest(range(1, len(w))) AS i FROM tw)),
st AS MATERIALIZED (SELECT DISTINCT k, template, words, i - place AS s FROM pg JOIN {_anchors_sql()} USING (g)),
wg AS MATERIALIZED (SELECT x.k, x.template, x.s, x.i, pg.g, t.g IS NOT NULL AS own
  FROM (SELECT k, template, s, unnest(range(s, s + words - 1)) AS i FROM st) x JOIN pg ON pg.k = x.k AND pg.i = x.i
  LEFT JOIN t ON t.template = x.template AND t.g = pg.g),
we AS (SELECT k, template, s, min(i) AS lo, max(i) AS hi FROM wg WHERE own GROUP BY k, template, s),
wc AS (SELECT k, template, lo, count(DISTINCT g) AS n, count(DISTINCT CASE WHEN own THEN g END) AS c
  FROM wg JOIN we USING (k, template, s) WHERE i BETWEEN lo AND hi GROUP BY k, template, s, lo),
fw AS (SELECT k, -2 AS line, lo AS word, license, 2 * c / CAST(wc.n + tn.n AS DOUBLE) AS dice FROM wc JOIN tn USING (template)),
h AS (SELECT k, count(DISTINCT CASE WHEN line >= -1 THEN line END) AS n_units, count(DISTINCT word) AS n_windows,
  string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS best_dice
  FROM (SELECT * FROM f UNION ALL SELECT * FROM fw) WHERE dice >= {DICE} GROUP BY k)
SELECT doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, CAST(coalesce(n_windows, 0) AS BIGINT) AS n_windows,
  coalesce(licenses, '') AS licenses, best_dice
FROM d LEFT JOIN h USING (k)
"""
