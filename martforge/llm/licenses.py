"""License scans by diagonal voting, in DataFrame expressions only.

Every rolling ``K``-word hash of every document is joined to the positions of
the templates (a broadcast table of fixed size).  A hit at document position p
and template position q votes for the diagonal p - q.  Votes are counted per
diagonal, diagonals at most ``GAP`` apart are merged (words put in or left
out), and the merged span is verified by the share of the template's positions
it holds and by the word pairs that tell it from other licenses (``MARKS``).  A
phrase stands at place p exactly if diagonal p has all its votes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martforge.llm import words as W
from martforge.llm.common import read, texts

K = 2
GAP = 3
COVERAGE = 0.7  # of a license text's positions, for a label of the method

#: fixed values: phrases and their labels
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: fixed values: sentences of public licenses and their labels
SENTENCES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2 0", "mpl"),
    ("creative commons attribution", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("all rights reserved", "all-rights-reserved"),
]
#: fixed values: word pairs of which a span of the sentence must hold one, as other notices hold most of its other pairs
MARKS = {
    "licensed under the apache license version 2 0": ("the apache", "apache license"),
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": ("gnu general",),
    "mozilla public license version 2 0": ("mozilla public",),
    "this is free and unencumbered software released into the public domain": ("and unencumbered", "unencumbered software"),
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": ("software for",),
}


def templates(spark: SparkSession) -> DataFrame:
    """(template, label, phrase, votes, hash, q): one row per template position."""
    rows = [(i, text, label, i < len(PHRASES)) for i, (text, label) in enumerate(PHRASES + SENTENCES)]
    base = spark.createDataFrame(rows, "template int, text string, label string, phrase boolean")
    return base.select(
        "template", "label", "phrase", (F.size(W.alnum_words(F.col("text"))) - (K - 1)).alias("votes"),
        F.posexplode(W.gram_hashes(W.alnum_words(F.col("text")), K)).alias("q", "hash"))


def diagonals(docs: DataFrame) -> DataFrame:
    """(doc_id, th, template, label, phrase, votes, diagonal, qs): voted diagonals with the template positions hit."""
    rows = texts(docs).withColumn("th", F.xxhash64("text"))
    grams = rows.select("doc_id", "th", F.posexplode(W.gram_hashes(W.alnum_words(F.col("text")), K)).alias("p", "hash"))
    return (grams.join(F.broadcast(templates(docs.sparkSession)), "hash")
            .groupBy("doc_id", "th", "template", "label", "phrase", "votes", (F.col("p") - F.col("q")).alias("diagonal"))
            .agg(F.collect_set("q").alias("qs")))


def _marked(template: Column, qs: Column) -> Column:
    """Whether the hit positions hold a pair of the template's marks."""
    out = F.lit(True)
    for i, (text, _) in enumerate(PHRASES + SENTENCES):
        if text in MARKS:
            w = text.split(" ")
            places = [q for q in range(len(w) - 1) if f"{w[q]} {w[q + 1]}" in MARKS[text]]
            out &= (template != i) | F.arrays_overlap(qs, F.array(*map(F.lit, places)))
    return out


def spans(found: DataFrame) -> DataFrame:
    """Neighbouring diagonals merged: (doc_id, th, template, label, phrase, first, last, coverage)."""
    order = Window.partitionBy("doc_id", "th", "template").orderBy("diagonal")
    far = (F.col("diagonal") - F.lag("diagonal").over(order) > GAP).cast("int")
    # a phrase must stand as it is, so its diagonals are never merged
    group = F.when(F.col("phrase"), F.col("diagonal")).otherwise(F.sum(F.coalesce(far, F.lit(0))).over(order))
    merged = found.withColumn("span", group).groupBy("doc_id", "th", "template", "label", "phrase", "votes", "span").agg(
        F.min("diagonal").alias("first"), F.max("diagonal").alias("last"),
        F.array_distinct(F.flatten(F.collect_list("qs"))).alias("qs")).withColumn("n", F.size("qs"))
    share = F.col("n") / F.col("votes")
    return (merged.withColumn("coverage", share)
            .filter((F.col("phrase") & (F.col("n") == F.col("votes"))) | (~F.col("phrase") & (share >= COVERAGE) & _marked(F.col("template"), F.col("qs"))))
            .select("doc_id", "th", "template", "label", "phrase", "first", "last", "coverage"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    score is the largest coverage of a verified span, 0 without one.  Null and
    empty texts have no words, no labels (empty strings) and score 0; rows that
    repeat a doc_id are judged each by its own text."""
    per_doc = spans(diagonals(docs)).groupBy("doc_id", "th").agg(
        F.sum(F.col("phrase").cast("long")).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"))
    hit = per_doc.withColumnRenamed("doc_id", "hit_id").withColumnRenamed("th", "hit_th")
    base = texts(docs).select("doc_id", F.xxhash64("text").alias("th"), F.size(W.alnum_words(F.col("text"))).cast("long").alias("n_words"))
    return base.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def _sql_templates() -> str:
    rows = [f"({i}, '{label}', {i < len(PHRASES)}, '{text}')" for i, (text, label) in enumerate(PHRASES + SENTENCES)]
    return ", ".join(rows)


ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{W.UPPER}', '{W.LOWER}'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tw AS (SELECT i, label, phrase, string_split(t, ' ') AS w FROM (VALUES {_sql_templates()}) v(i, label, phrase, t)),
t AS (SELECT i, label, phrase, len(w) - 1 AS votes, q, w[q + 1] AS a, w[q + 2] AS b
      FROM (SELECT *, unnest(range(0, len(w) - 1)) AS q FROM tw)),
g AS (SELECT doc_id, p, w[p + 1] AS a, w[p + 2] AS b FROM (SELECT doc_id, w, unnest(range(0, len(w) - 1)) AS p FROM d)),
h AS (SELECT DISTINCT doc_id, i, label, phrase, votes, p - q AS diagonal, q FROM g JOIN t ON g.a = t.a AND g.b = t.b),
x AS (SELECT DISTINCT doc_id, i, diagonal FROM h),
y AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, i ORDER BY diagonal) > {GAP} THEN 1 ELSE 0 END AS far FROM x),
z AS (SELECT doc_id, i, diagonal, sum(far) OVER (PARTITION BY doc_id, i ORDER BY diagonal) AS merged FROM y),
s AS (SELECT h.doc_id, h.i, label, phrase, CASE WHEN phrase THEN h.diagonal ELSE merged END AS span,
             min(h.diagonal) AS first, count(DISTINCT q) / max(votes) AS coverage
      FROM h JOIN z ON h.doc_id = z.doc_id AND h.i = z.i AND h.diagonal = z.diagonal GROUP BY ALL),
v AS (SELECT * FROM s WHERE CASE WHEN phrase THEN coverage >= 1 ELSE coverage >= {COVERAGE} END),
r AS (SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(first) FILTER (phrase) AS first_word, max(first) FILTER (phrase) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score FROM v GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""
