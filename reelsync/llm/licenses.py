"""License scans by diagonal voting (operator 12).

A template is a short phrase, or a longer notice, as a list of words. Every
rolling word k-gram of a document (``GRAM`` words, and ``PHRASE_GRAM`` for
phrases) is hashed and joined with the templates' k-gram hashes; a hit at word
``p`` of the document and word ``t`` of the template votes for the diagonal
``p - t``. Votes are added up per document, template and diagonal; a notice's
diagonals within ``DRIFT`` words of each other are merged, so that words added
or left out do not break a span; and each span is verified:

* a phrase must stand word for word: its diagonal holds all its k-grams;
* of a notice, at least ``LEAST`` of the words must be covered by hits. Merged
  diagonals that reach over more than the notice and ``DRIFT`` words (places one
  after another) are verified one by one.

The templates are a fixed list of a few hundred words, so their positions are
broadcast and no k-gram of a document is shuffled; the hits are, combined in
their task first. A hit compares the words besides their hash, so a collision
adds no vote. A document's hits meet in one task: they are bounded by that
document's own words.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z. A
NULL or empty text has no words and no spans. Very long texts are read whole.
Repeated rows, NULL ids and repeated ids give a row each. Spans that tie are
ordered by start, end and label. Columns other than the id and the text are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import only

PHRASE_GRAM = 2
GRAM = 3
DRIFT = 5      # words by which two diagonals of one span may differ
LEAST = 0.8    # of a notice's words that its span must cover
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False  # must stand word for word


# The base phrases and their labels.
BASE = [
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
]

# Phrases that name a license and its version.
VERSIONS = [
    Template("gpl-2", "gnu general public license version 2", True),
    Template("gpl-3", "gnu general public license version 3", True),
    Template("lgpl", "gnu lesser general public license", True),
    Template("agpl", "gnu affero general public license", True),
    Template("apache-2.0", "apache license version 2.0", True),
    Template("cc-by-4.0", "cc by 4.0", True),
    Template("cc-by-sa", "cc by-sa", True),
    Template("cc-by-nc", "cc by-nc", True),
    Template("cc-by-nd", "cc by-nd", True),
    Template("mpl-2.0", "mozilla public license version 2.0", True),
]

# Opening sentences and notices of public licenses.
NOTICES = [
    Template("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or "
                    "neighboring rights to this work"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
                    "software and associated documentation files the software to deal in the software without "
                    "restriction"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or "
                    "without fee is hereby granted provided that the above copyright notice and this permission "
                    "notice appear in all copies"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are "
                    "permitted provided that the following conditions are met"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of "
                    "the gnu general public license as published by the free software foundation"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
]
TEMPLATES = BASE + VERSIONS + NOTICES


def template_words(template: Template) -> list[str]:
    return re.findall(WORD, template.text.translate(str.maketrans(UPPER, LOWER)))


def gram_rows(templates: list[Template]) -> list[tuple]:
    """Every k-gram of every template: template number, label, phrase, length in
    words, k, its place t, its words."""
    rows = []
    for number, template in enumerate(templates):
        words, k = template_words(template), PHRASE_GRAM if template.phrase else GRAM
        if len(words) < k:
            raise ValueError(f"{template.text!r} has fewer than {k} words")
        rows += [(number, template.label, template.phrase, len(words), k, t, words[t:t + k])
                 for t in range(len(words) - k + 1)]
    return rows


GRAMS = "template int, label string, phrase boolean, length int, k int, t int, gram array<string>"
SPANS = "array<struct<start: long, end: long, label: string, template: int, score: double>>"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def votes(docs: DataFrame, templates: list[Template], id: str, text: str) -> DataFrame:
    """One row per document, template and diagonal, with the template's words
    ``ts`` where hits stand. Every document also has a row (of its first word, or
    of none) that may be without a template, so that it is read once and kept."""
    spark = docs.sparkSession
    grams = spark.createDataFrame(gram_rows(templates), GRAMS).withColumn("hash", F.xxhash64("gram"))
    words = F.col("words")
    later = [F.slice(words, i + 1, F.greatest(F.size(words) - i, F.lit(0))).alias(f"w{i}") for i in range(1, GRAM)]
    rows = only(docs, id, text).select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"),
                                       words_of(F.col(text)).alias("words"))
    # after each word those that follow it (NULL past the end); exploded, so
    # that hashing and the join run in generated code, word by word
    sized = rows.select("*", F.size("words").cast("long").alias("n_words"))  # the list itself is not copied to its words
    placed = sized.select("row", "id", "n_words", F.posexplode_outer(F.arrays_zip(words.alias("w0"), *later)).alias("p", "w"))
    gram = lambda k: F.when(F.col(f"w.w{k - 1}").isNotNull(), F.array(*[F.col(f"w.w{i}") for i in range(k)]))
    rolled = placed.select("row", "id", "n_words", "p", F.explode(F.array(gram(PHRASE_GRAM), gram(GRAM))).alias("words"))
    same = (F.xxhash64("words") == F.col("hash")) & (F.col("words") == F.col("gram"))
    found = rolled.join(F.broadcast(grams), same, "left")  # some hundred rows, fixed
    found = found.where(F.col("template").isNotNull() | F.col("p").isNull() | (F.col("p") == 0))
    keys = ["row", "id", "n_words", "template", "label", "phrase", "length", "k"]
    return found.groupBy(*keys, (F.col("p") - F.col("t")).alias("diagonal")).agg(F.sort_array(F.collect_set("t")).alias("ts"))


def _span(parts: Column, length: str = "length") -> Column:
    """The span of some diagonals: covered words of the template, start and end."""
    covered = F.array_distinct(F.flatten(F.flatten(F.transform(
        parts, lambda d: F.transform(d.ts, lambda t: F.sequence(t, t + F.col("k") - 1))))))
    start = F.array_min(F.transform(parts, lambda d: d.diagonal + d.ts[0]))
    end = F.array_max(F.transform(parts, lambda d: d.diagonal + F.element_at(d.ts, -1))) + F.col("k")
    return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), F.col("label"), F.col("template"),
                    (F.size(covered) / F.col(length)).alias("score"))


def find_licenses(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  templates: list[Template] | None = None, drift: int = DRIFT, least: float = LEAST) -> DataFrame:
    """Per row of ``docs``: its id, ``n_words``, and ``spans``, an array of
    ``(start, end, label, template, score)`` ordered by start: places in words,
    end exclusive, the template's number, and the part of its words that hits
    cover."""
    diagonals = votes(docs, TEMPLATES if templates is None else templates, id, text)
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.when(F.col("phrase"), 0).otherwise(drift)
    chained = diagonals.withColumn("chain", F.sum(F.when(apart, 1).otherwise(0)).over(order))
    keys = ["row", "id", "n_words", "template", "label", "phrase", "length", "k"]
    merged = chained.groupBy(*keys, "chain").agg(F.collect_list(F.struct("diagonal", "ts")).alias("parts"))
    whole = _span(F.col("parts"))
    spans = F.when(whole.end - whole.start <= F.col("length") + drift, F.array(whole)).otherwise(
        F.transform("parts", lambda d: _span(F.array(d))))
    needed = F.when(F.col("phrase"), 1.0).otherwise(least)
    verified = merged.select("row", "id", "n_words", F.when(F.col("template").isNotNull(), F.filter(
        spans, lambda s: s.score >= needed)).otherwise(F.array().cast(SPANS)).alias("spans"))
    return (verified.groupBy("row", "id", "n_words").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
            .select(F.col("id").alias(id), "n_words", "spans"))


def digest(found: DataFrame, id: str, base: int = len(BASE)) -> DataFrame:
    """The columns of the query: places and labels of the first ``base``
    templates (the base phrases), and all labels."""
    places = F.filter("spans", lambda s: s.template < base)
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")
    starts = F.transform(places, lambda s: s.start)
    return found.select(id, "n_words", F.size(places).cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        labels(places).alias("base_labels"), labels(F.col("spans")).alias("labels"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s.score)), F.lit(0.0)).alias("score"))


def digest_sql(templates: list[Template] | None = None, drift: int = DRIFT, least: float = LEAST) -> str:
    """``digest(find_licenses(documents))`` as DuckDB SQL (ids tell rows apart)."""
    value = lambda v: f"'{' '.join(v)}'" if isinstance(v, list) else f"'{v}'" if isinstance(v, str) else str(v)
    grams = ",\n  ".join("(" + ", ".join(map(value, row)) + ")" for row in gram_rows(TEMPLATES if templates is None else templates))
    return f"""WITH grams(template, label, phrase, length, k, t, gram) AS (VALUES
  {grams}),
texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
          FROM documents),
places AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM texts),
followed AS (SELECT doc_id, p, word || ' ' || lead(word) OVER o AS two, two || ' ' || lead(word, 2) OVER o AS three
             FROM places WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
rolled AS (SELECT doc_id, p, two AS gram FROM followed UNION ALL SELECT doc_id, p, three FROM followed),
hits AS (SELECT doc_id, template, label, phrase, length, k, p - t AS diagonal, t FROM rolled JOIN grams USING (gram)),
voted AS (SELECT doc_id, template, label, phrase, length, k, diagonal, min(t) AS t0, max(t) AS t1 FROM hits GROUP BY ALL),
flagged AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER o > CASE WHEN phrase THEN 0 ELSE {drift} END, false) AS apart
            FROM voted WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
chained AS (SELECT *, sum(apart::INT) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS chain FROM flagged),
sized AS (SELECT *, max(diagonal + t1 + k) OVER c - min(diagonal + t0) OVER c <= length + {drift} AS whole FROM chained
          WINDOW c AS (PARTITION BY doc_id, template, chain)),
parts AS (SELECT *, CASE WHEN whole THEN chain ELSE diagonal END AS part FROM sized),
covered AS (SELECT DISTINCT doc_id, template, diagonal, unnest(range(t, t + k)) AS word FROM hits),
spans AS (SELECT p.doc_id, p.template, p.label, p.phrase, min(p.diagonal + p.t0) AS start,
                 count(DISTINCT c.word) / p.length AS score
          FROM parts p JOIN covered c USING (doc_id, template, diagonal)
          GROUP BY p.doc_id, p.template, p.label, p.phrase, p.length, p.whole, p.part),
verified AS (SELECT * FROM spans WHERE score >= CASE WHEN phrase THEN 1.0 ELSE {least} END),
found AS (SELECT doc_id, count(*) FILTER (template < {len(BASE)}) AS n_base,
                 min(start) FILTER (template < {len(BASE)}) AS first_word, max(start) FILTER (template < {len(BASE)}) AS last_word,
                 string_agg(DISTINCT label, ',' ORDER BY label) FILTER (template < {len(BASE)}) AS base_labels,
                 string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
          FROM verified GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM texts LEFT JOIN found USING (doc_id)"""
