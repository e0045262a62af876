"""License notices in texts, in built-in functions alone.

Two scans over words (runs of ASCII letters, digits and everything beyond ASCII, A-Z in
lower case). The phrase scan reports every place at which a known phrase stands. The template
scan is an exact set-similarity join of runs of words with license templates: a template of
n words stands in a text where some run of 2n words, whatever its lines, holds `THRESHOLD` of
its distinct tokens or more. Texts are cut into overlapping blocks, each half covered by the
next, so that every run of twice the longest template lies in one. Tokens are ordered by their frequency over all blocks, rarest first; of a template
of n tokens that must share t with a block, the first n - t + 1 are its prefix, of which any
such block holds one. Blocks meet templates on prefix tokens; a block with fewer than t
template tokens (length filter), or with too few left from the matching place on (positional
filter), is no candidate; of the rest every run is compared in full. The join is exact: every
run of a containment of `THRESHOLD` or more is found, and no tokens from farther apart count.

Templates are a fixed parameter of a few hundred tokens, the one thing that is broadcast.
Texts are read once; what is kept of them are the template tokens of each block.

A null or empty text has no words, places or labels and scores 0. Rows are kept
apart by a number of their own, so that rows of one doc_id, or of none, each have their own
places and labels. Of equal containments the label sorts first. Very long texts are many
blocks. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tertulia.sources.shared import written

IN_WORD = r"0-9A-Za-z\x{80}-\x{10FFFF}"
THRESHOLD = 0.9

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Notices by label, from the public texts of the licenses.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text: Column) -> Column:
    return F.filter(F.split(_lower(text), f"[^{IN_WORD}]+"), lambda w: w != "")


def _any_phrase(phrases) -> str:
    gap = f"[^{IN_WORD}]+"
    return f"(?i)(?<![{IN_WORD}])(?:{'|'.join(gap.join(map(re.escape, p.split())) for p in phrases)})(?![{IN_WORD}])"


def _places(words: str, phrase: str) -> Column:
    tokens, w = phrase.split(), F.col(words)
    at = lambda i: reduce(Column.__and__, (F.get(w, i + k) == t for k, t in enumerate(tokens)))
    return F.when(F.size(w) >= len(tokens), F.filter(F.sequence(F.lit(0), F.size(w) - len(tokens)), at)).otherwise(
        F.array().cast("array<int>"))


def _needed(tokens: list[str], threshold: float) -> int:
    return math.ceil(threshold * len(set(tokens)) - 1e-9)


def scanned(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """row (a number of its own), doc_id, n_words, places (label and first word of each phrase), blocks: the template
    tokens, with their places, of each block that has enough of them for any template. Texts
    are read here and nowhere else."""
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    half = 2 * max(len(t.split()) for _, t in templates)
    least = min(_needed(t.split(), threshold) for _, t in templates)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("row", "doc_id", "text", _words(F.col("text")).alias("all_words"))

    def block(k: Column) -> Column:
        run = F.transform(F.slice("all_words", k * half + 1, 2 * half), lambda w, i: F.struct(i.alias("word"), w.alias("token")))
        return F.filter(run, lambda x: x["token"].isin(vocabulary))

    # Phrases are looked for only in texts that hold one.
    rows = rows.select(
        "row", "doc_id", F.size("all_words").cast("long").alias("n_words"),
        F.when(F.col("text").rlike(_any_phrase(phrases)), F.col("all_words")).otherwise(F.array().cast("array<string>")).alias("words"),
        F.filter(
            F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("all_words") / half).cast("int") - 2)), block),
            lambda b: F.size(b) >= least).alias("blocks"))

    def labelled(phrase: str, label: str) -> Column:
        return F.transform(_places("words", phrase), lambda i: F.struct(F.lit(label).alias("label"), i.alias("word")))

    places = F.concat(*(labelled(*item) for item in phrases.items()))
    return rows.select("row", "doc_id", "n_words", places.alias("places"), "blocks")


def matched(scans: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """row, label, containment of every block and template with a run at or over the threshold."""
    spark = scans.sparkSession
    blocks = scans.select("row", F.explode("blocks").alias("run"))
    blocks = blocks.select("row", "run", F.array_distinct(F.col("run")["token"]).alias("block"))
    counts = blocks.select(F.explode("block").alias("token")).groupBy("token").count().collect()  # template tokens only
    seen = {r["token"]: r["count"] for r in counts}
    order = sorted({w for _, t in templates for w in t.split()}, key=lambda w: (seen.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    index = []
    for number, (label, text) in enumerate(templates):
        tokens = sorted(set(text.split()), key=rank.__getitem__)
        needed = _needed(tokens, threshold)
        index += [(tokens[k], number, label, tokens, 2 * len(text.split()), needed, k) for k in range(len(tokens) - needed + 1)]
    prefixes = spark.createDataFrame(index, "token string, template int, label string, tokens array<string>, span int, needed int, place int")
    ranks = F.lit(order)
    # Every block in the global order, then one row for each of its tokens that is in a prefix.
    sorted_blocks = blocks.where(F.size("block") >= min(r[5] for r in index)).where(
        F.arrays_overlap("block", F.lit(sorted({r[0] for r in index}))))
    sorted_blocks = sorted_blocks.select("row", "run", F.transform(
        F.array_sort(F.transform("block", lambda t: F.struct(F.array_position(ranks, t).alias("rank"), t.alias("token")))), lambda x: x["token"]).alias("block"))
    met = sorted_blocks.select("row", "run", "block", F.posexplode("block").alias("at", "token")).join(F.broadcast(prefixes), "token")
    met = met.where(
        (F.size("block") >= F.col("needed"))
        & (1 + F.least(F.size("tokens") - F.col("place") - 1, F.size("block") - F.col("at") - 1) + F.least("place", "at") >= F.col("needed")))
    met = met.where(F.size(F.array_intersect("block", "tokens")) >= F.col("needed"))
    # From each token of the template on, the run of `span` words.
    met = met.withColumn("run", F.filter("run", lambda x: F.array_contains("tokens", x["token"])))
    both = F.array_max(F.transform("run", lambda first: F.size(F.array_distinct(F.transform(F.filter(
        "run", lambda x: (x["word"] >= first["word"]) & (x["word"] < first["word"] + F.col("span"))), lambda x: x["token"])))))
    return met.select("row", "label", both.alias("both"), "tokens", "needed").where(F.col("both") >= F.col("needed")).select(
        "row", "label", (F.col("both") / F.size("tokens")).alias("containment")).distinct()


def licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, places, matches (label and best containment of each label)."""
    scans = written(scanned(docs, phrases, templates, threshold), "scans")
    best = matched(scans, templates, threshold).groupBy("row", "label").agg(F.max("containment").alias("containment"))
    best = best.groupBy(F.col("row").alias("of")).agg(F.array_sort(F.collect_list(F.struct("label", "containment"))).alias("matches"))
    return scans.join(best, scans["row"] == best["of"], "left").select(
        "doc_id", "n_words", "places", F.coalesce("matches", F.array().cast("array<struct<label: string, containment: double>>")).alias("matches"))


def op8(docs: DataFrame) -> DataFrame:
    found = licenses(docs)
    words = F.transform("places", lambda p: p["word"].cast("long"))
    base = F.transform("places", lambda p: p["label"])
    own = F.transform("matches", lambda m: m["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"), joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))).alias("score"))


def oracle(phrases: dict[str, str] = PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    values = ", ".join(f"('{label}', list_distinct(string_split('{text}', ' ')))" for label, text in templates)
    places = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + {len(p.split())}] = {p.split()})) AS word FROM texts"
        for p, label in phrases.items())
    return f"""WITH texts AS (SELECT doc_id, regexp_extract_all({lower}, '{word}') AS w, string_split({lower}, chr(10)) AS lines FROM documents),
    places AS ({places}),
    base AS (SELECT doc_id, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
    templates AS (SELECT * FROM (VALUES {values}) AS v(label, tokens)),
    blocks AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '{word}')) AS b FROM (SELECT doc_id, unnest(lines) AS line FROM texts)),
    own AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM (
      SELECT doc_id, label, len(list_intersect(b, tokens)) / len(tokens) AS share FROM blocks, templates) WHERE share >= {threshold} - 1e-9 GROUP BY doc_id)
    SELECT t.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
      coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
      array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
      CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
    FROM texts t LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)"""
