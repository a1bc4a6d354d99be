"""License scan by an exact set-similarity join, in DataFrame functions alone.

A template's blocks are windows of twice its words (``WINDOW`` at least) that begin at every word, so that no notice
depends on its offset and a template of any length fits. A block meets a template if it holds at least
``CONTAINMENT`` of the template's distinct words, its words in ``NAMING`` among them. Only blocks that begin at a
word of some template are made: any other holds no template word that the block at the next template word doesn't
hold too.

The text is read once: counts, base labels and the places of all template words are written as a table. Template
words are ordered by their frequency over all documents, rarest first. A document can have a block that meets a
template only if its own words do, so whole documents are joined first: on the template's first n - need + 1 words
(prefix filter), from which only the first shared one counts, with at least ``need`` template words at all (length
filter) and enough of them after the shared one (positional filter); then the intersection is verified. Of these
documents and templates all blocks are made. Filters only discard what can't meet a template, so every block that
does is found. Beside these labels, the base labels say where the words of a phrase stand consecutively.

Templates are a parameter of fixed size; the index of their prefixes is broadcast. Frequencies cover all
documents and are combined before they are shuffled; only the counts of template words reach the driver.

Defined results: null text counts as empty: no words, no labels, score 0; an empty table gives an empty table;
rows that repeat, or share an id, are scanned each for itself; documents of any length are scanned whole; of other
columns only the id is kept. Score: 1 where a base label is found, else the highest containment that met the
threshold, else 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm.common import documents, text_of, written

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices in common use, by the label that a block gets which meets one.
TEMPLATES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-notice": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "gpl-notice": "licensed under the gnu general public license version 3",
    "mit-notice": "released under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "apache-header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "bsd-disclaimer": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "gpl-header": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
}
#: Words that a block must hold besides, where the other words of a notice meet the threshold alone.
NAMING = {"apache-header": ["apache"], "apache-notice": ["apache"], "cc-by-notice": ["attribution"], "cc-by-nc-notice": ["nc"], "gpl-header": ["gnu"], "mit-notice": ["mit"]}
CONTAINMENT = 0.8
#: Words of a block at least, and the step from block to block.
WINDOW, STRIDE = 24, 1


def window_of(template: str, least: int = WINDOW) -> int:
    """The words of a template's blocks."""
    return max(least, 2 * len(template.split()))


def spaced_words(column: str = "text") -> Column:
    """The words of a text with A-Z lower-cased, joined by single spaces."""
    spaced = F.trim(F.regexp_replace(text_of(column), NOT_WORD, " "))
    # the two other characters whose lower case begins with an ASCII letter stay apart from it
    return F.lower(F.replace(F.replace(spaced, F.lit("\u212a"), F.lit("\ufffd")), F.lit("\u0130"), F.lit("\ufffd")))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _base(words: Column) -> dict[str, Column]:
    any_phrase = " (?:" + "|".join(PHRASES) + ") "
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    found = F.when(F.contains(words, F.lit("license")) | F.contains(words, F.lit("cc by")), F.regexp_count(padded, F.lit(f"(?={any_phrase})"))).otherwise(0)
    has = [F.when(F.contains(padded, F.lit(f" {p} ")), F.lit(label)) for p, label in sorted(PHRASES.items(), key=lambda x: x[1])]
    return {
        "n_words": F.when(words == "", 0).otherwise(_spaces(words) + 1).cast("long"),
        "n_base": found.cast("long"),
        "first_word": F.when(found > 0, _spaces(F.regexp_extract(padded, f"(?s)^(.*?){any_phrase}", 1))).cast("long"),
        "last_word": F.when(found > 0, _spaces(F.regexp_extract(padded, f"(?s)^(.*){any_phrase}", 1))).cast("long"),
        "base": F.when(found > 0, F.array_compact(F.array(*has))).otherwise(F.array().cast("array<string>")),
    }


def _words_in(words: Column, vocabulary: list[str]) -> Column:
    """The words of a text that stand in ``vocabulary``, with their places."""
    numbered = F.transform(F.split(words, " "), lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    return F.filter(numbered, lambda x: x["word"].isin(vocabulary))


def _vocabulary(templates: dict[str, str]) -> list[str]:
    return sorted({w for t in templates.values() for w in t.split()})


def _met(placed: DataFrame, templates: dict[str, str], containment: float, naming: dict[str, list[str]]) -> DataFrame:
    """From rows (key, places), the places being those of template words: key, block, label, score."""
    sets = {label: sorted(set(t.split())) for label, t in templates.items()}
    counted = placed.select(F.explode("places.word").alias("word")).groupBy("word").count().collect()  # words of templates
    seen = {r["word"]: r["count"] for r in counted}
    rank = {w: i for i, w in enumerate(sorted(_vocabulary(templates), key=lambda w: (seen.get(w, 0), w)))}
    index = []
    for label, words in sets.items():
        ranks, need = sorted(rank[w] for w in words), math.ceil(containment * len(words) - 1e-9)
        named = sorted(rank[w] for w in naming.get(label, []) if w in words)
        index += [(r, label, i, len(ranks), need, ranks, named, window_of(templates[label])) for i, r in enumerate(ranks[: len(ranks) - need + 1])]
    prefixes = placed.sparkSession.createDataFrame(index, "word int, label string, i int, n int, need int, ranks array<int>, named array<int>, window int")
    by_rank = sorted(rank, key=rank.get)
    leading = [by_rank[r] for r in sorted({x[0] for x in index})]
    number = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    ranked = F.transform("places", lambda x: F.struct(x["at"].alias("at"), F.element_at(number, x["word"]).alias("word")))
    likely = placed.filter(F.arrays_overlap("places.word", F.array(*map(F.lit, leading)))).select("key", ranked.alias("places"))
    held = likely.withColumn("held", F.array_sort(F.array_distinct("places.word"))).withColumn("size", F.size("held"))
    after = F.least(F.col("n") - F.col("i"), F.col("size") - F.col("j")) - 1
    candidates = (
        held.filter(F.col("size") >= min(x[4] for x in index))
        .select("*", F.posexplode("held").alias("j", "word"))
        .join(F.broadcast(prefixes), "word")
        .filter((F.col("size") >= F.col("need")) & (1 + after >= F.col("need")))
        .filter(~F.arrays_overlap(F.slice("ranks", F.lit(1), F.col("i")), F.col("held")))
        .filter(F.size(F.array_intersect("held", "ranks")) >= F.col("need"))
    )

    def block(first: Column, j: Column) -> Column:
        ahead = F.filter(F.slice("places", j + 1, F.col("window")), lambda x: (x["at"] < first["at"] + F.col("window")) & F.array_contains("ranks", x["word"]))
        words = F.array_distinct(F.transform(ahead, lambda x: x["word"]))
        return F.struct(first["at"].alias("block"), F.size(words).alias("shared"), (F.size(F.array_except("named", words)) == 0).alias("named"))

    met = F.filter(F.transform("places", block), lambda x: (x["shared"] >= F.col("need")) & x["named"])
    return candidates.select("key", "label", "n", F.explode(met).alias("met")).select("key", "met.block", "label", (F.col("met.shared") / F.col("n")).alias("score"))


def template_blocks(df: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, naming: dict[str, list[str]] = NAMING) -> DataFrame:
    """From rows (key, words), words being joined by spaces: key, block (the place of its first word), label, score of
    every block that begins at a template word and meets a template."""
    return _met(df.select("key", _words_in(F.col("words"), _vocabulary(templates)).alias("places")), templates, containment, naming)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: its id, counts, places and labels."""
    spaced = df.select(F.col(id_col).alias("doc_id"), spaced_words(text_col).alias("words"))
    columns = [c.alias(n) for n, c in _base(F.col("words")).items()]
    table = written(spaced.select(F.monotonically_increasing_id().alias("key"), "doc_id", *columns, _words_in(F.col("words"), _vocabulary(templates)).alias("places")), "zstd")
    found = _met(table.select("key", "places"), templates, CONTAINMENT, NAMING).groupBy("key").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return table.drop("places").join(found, "key", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w0 FROM documents),
w AS (SELECT doc_id, CASE WHEN w0 = [''] THEN [] ELSE w0 END AS w FROM d),
p(phrase, label) AS (VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')),
h AS (SELECT doc_id, label, s.i FROM w, p, LATERAL (SELECT unnest(range(len(w))) AS i) s WHERE w[s.i + 1 : s.i + len(phrase)] = phrase),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h GROUP BY doc_id),
t(label, words, named, win) AS (VALUES """ + ", ".join(f"('{k}', list_distinct(string_split('{v}', ' ')), {NAMING.get(k, [])}::VARCHAR[], {window_of(v)})" for k, v in TEMPLATES.items()) + r"""),
v AS (SELECT list_distinct(flatten(list(words))) AS known FROM t),
e AS (SELECT doc_id, label, w, words, named, win FROM w, t WHERE len(list_intersect(list_distinct(w), words)) >= 0.8 * len(words)),
k AS (SELECT doc_id, label, words, named, list_distinct(w[s.i + 1 : s.i + win]) AS held
      FROM e, v, LATERAL (SELECT unnest(range(len(w))) AS i) s WHERE list_contains(known, w[s.i + 1])),
m AS (SELECT doc_id, label, max(len(list_intersect(held, words)) / len(words)) AS score FROM k
      WHERE len(list_intersect(held, words)) >= 0.8 * len(words) AND list_has_all(held, named) GROUP BY doc_id, label),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM h UNION ALL SELECT doc_id, label FROM m) GROUP BY doc_id),
g AS (SELECT doc_id, max(score) AS best FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN g USING (doc_id)
"""
