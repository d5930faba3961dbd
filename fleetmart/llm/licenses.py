"""License scans by diagonal voting, in DataFrame functions throughout.

Every rolling hash of ``K`` consecutive words is joined to the positions that it has in the templates. A hit votes
for the diagonal on which document position minus template position is constant; the votes are counted by document,
template and diagonal. A diagonal with all votes of a template is an exact place of it. Neighbouring diagonals, as a
changed, lost or added word leaves behind, are merged into spans, whose diagonals lie within DRIFT of each other as a whole. A
span is verified by the template positions that it covers: each counts once, however often it is hit, and the words of
every hit are compared themselves before it may vote. The hits are stored, so that texts are split and joined once.

The templates are a fixed list, so its broadcast has a fixed size. Nothing is grouped by a template alone: groups are
bounded by a document.

Defined results: a null text is empty: no words, no places, null first and last word, empty labels, score 0; rows that
are equal get equal results; rows of one id with different texts are judged apart; an empty table gives an empty
table; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetmart.operators.settle import settle

K = 3
DRIFT = 8  # all diagonals of a span lie so close together
COVER = 0.6  # share of a template's positions that a span must cover

#: words of a text: what lies between these, with A-Z in lower case
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``base``: every exact place counts; other templates count by spans that cover enough of them."""

    label: str
    text: str
    base: bool = False


# fixed values: the base phrases, and the opening or best-known words of public licenses
TEMPLATES = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "all rights reserved"),
]


def words(text: Column) -> Column:
    """The words, A-Z in lower case. The two letters that lower-casing would turn into a-z are replaced before."""
    lowered = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[İK]", "é"))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def grams(listed: Column, k: int = K) -> Column:
    """The hash of each k consecutive words."""
    at = F.when(F.size(listed) >= k, F.sequence(F.lit(0), F.size(listed) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*(F.get(listed, i + j) for j in range(k))))


def templates(spark: SparkSession) -> DataFrame:
    """One row for each template position: hash, words, template, position, number of positions, label, base."""
    rows = spark.createDataFrame([(n, t.label, t.base, t.text) for n, t in enumerate(TEMPLATES)], "template int, label string, base boolean, template_text string")
    rows = rows.withColumn("template_words", words(F.col("template_text")))
    rows = rows.select("template", "label", "base", "template_words", F.posexplode(grams(F.col("template_words"))).alias("template_at", "h"))
    return rows.select(
        "h", "template", "label", "base", "template_at", (F.size("template_words") - (K - 1)).alias("positions"), F.slice("template_words", F.col("template_at") + 1, K).alias("template_gram")
    )


def places(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document, template and diagonal: the template positions with a verified hit (``covered``, each once), their
    number ``votes``, and the first and last hit. The diagonal is the word at which the template would begin. Equal rows
    give one set of places."""
    listed = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("version"), words(F.col(text)).alias("words"))
    hits = listed.select("id", "version", "words", F.posexplode(grams(F.col("words"))).alias("at", "h")).join(F.broadcast(templates(docs.sparkSession)), "h")
    verified = hits.filter(F.slice("words", F.col("at") + 1, K) == F.col("template_gram"))
    grouped = verified.groupBy("id", "version", "template", "label", "base", "positions", (F.col("at") - F.col("template_at")).alias("diagonal"))
    covered = grouped.agg(F.collect_set("template_at").alias("covered"), F.min("at").alias("first_hit"), F.max("at").alias("last_hit"))
    return covered.withColumn("votes", F.size("covered"))


def spans(found: DataFrame) -> DataFrame:
    """Neighbouring diagonals of a document and template merged: ``start`` and ``end`` word, and ``cover``, the share of the
    template's positions that the span has. A span begins at its smallest diagonal; of spans that overlap the best stays."""
    along = Window.partitionBy("id", "version", "template").orderBy("diagonal")
    onward, around = along.rangeBetween(0, DRIFT), along.rangeBetween(-DRIFT, DRIFT)
    covered = F.array_distinct(F.flatten(F.collect_list("covered").over(onward)))
    merged = found.withColumns({"cover": F.size(covered) / F.col("positions"), "start": F.min("first_hit").over(onward), "end": F.max("last_hit").over(onward) + K})
    best = merged.withColumn("best", F.max("cover").over(around)).filter(F.col("cover") == F.col("best"))
    return best.select("id", "version", "template", "label", "base", "positions", "diagonal", "start", "end", "cover")


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``n_words``, ``n_base`` (exact places of the base phrases), the first and last word at which one
    begins, ``base_labels`` and ``labels`` (sorted arrays), and ``score``, the best cover of any template."""
    found = settle(places(docs, id, text))
    exact = found.filter(F.col("base") & (F.col("votes") == F.col("positions"))).groupBy("id", "version").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"), F.sort_array(F.collect_set("label")).alias("base_labels")
    )
    covered = spans(found).groupBy("id", "version").agg(F.max("cover").alias("score"), F.collect_set(F.when((F.col("cover") >= COVER) & ~F.col("base"), F.col("label"))).alias("more"))
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("version"), F.size(words(F.col(text))).cast("long").alias("n_words"))
    for side in (exact, covered):
        side = side.select(F.col("id").alias("_id"), F.col("version").alias("_version"), *side.columns[2:])
        rows = rows.join(side, F.col("id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version")), "left").drop("_id", "_version")
    none = F.array().cast("array<string>")
    return rows.select(
        F.col("id").alias(id), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"), F.coalesce("base_labels", none).alias("base_labels"),
        F.sort_array(F.array_union(F.coalesce("base_labels", none), F.coalesce("more", none))).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
