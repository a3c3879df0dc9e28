"""License scans by diagonal voting, with DataFrame and SQL functions only.

All rolling word 3-gram hashes of all texts are joined to the positions they have in
the license templates. A hit at document word ``p`` and template word ``t`` votes for the
diagonal ``p - t``: one copy of a template puts all its hits on one diagonal, an inserted
or dropped word moves the rest to a neighbouring one. Votes are summed per document,
template and diagonal, neighbouring diagonals are merged into spans, and a span counts
when it covers enough of the template's words (the words themselves are compared in the
join, so a hash collision cannot vote).

Beside the templates, fixed phrases are counted exactly (the base).

The templates are a constant list, so their side of the join has a proven size.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows
are scanned once and reported alike; a null id is an id of its own.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metroscope.llm.common import ALNUM_GAP

K = 3                  # words in a hashed gram
MAX_SHIFT = 3          # words by which neighbouring diagonals of one span may differ
MAX_GAP = 6            # document words between the merged parts of a span
COVERAGE = 0.8         # share of the template's words that a verified span holds

# Phrases and labels of the contract.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public license notices, (label, words). Case and punctuation are ignored.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def normal_text(text: Column) -> Column:
    """Lower-cased words joined by single spaces (no words: empty).

    ``lower`` also folds other scripts; no such letter folds into the ASCII letters of a
    phrase's words, and word characters stay word characters, so counts and places are
    those of folding A-Z alone."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), ALNUM_GAP, " "))


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """``hash``, ``tmpl``, ``label``, ``t_pos``, ``t_len`` and the ``gram`` (a space after each word)."""
    rows = [(i, label, text) for i, (label, text) in enumerate(templates)]
    t = spark.createDataFrame(rows, "tmpl int, label string, text string")
    t = t.select("tmpl", "label", F.split(normal_text(F.col("text")), " ").alias("words"))
    t = t.select("tmpl", "label", "words", F.size("words").alias("t_len"),
                 F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("t_pos"))
    words = [F.get("words", F.col("t_pos") + i) for i in range(k)]
    gram = F.concat(*[F.concat(w, F.lit(" ")) for w in words])
    return t.select("tmpl", "label", "t_len", "t_pos", gram.alias("gram"), F.xxhash64(*words).alias("hash"))


def hits(texts: DataFrame, grams: DataFrame, k: int = K) -> DataFrame:
    """``doc_id``, ``text_hash``, ``norm`` -> votes (``tmpl``, ``label``, ``t_len``, ``pos``, ``t_pos``)."""
    split = texts.select("doc_id", "text_hash", F.split("norm", " ").alias("words"))
    hashed = split.select("doc_id", "text_hash", "words", F.transform(
        "words", lambda w, i: F.xxhash64(w, *[F.get("words", i + j) for j in range(1, k)])).alias("hashes"))
    # the outer form keeps the optimizer from testing the whole array's size at the scan
    rolled = hashed.select("doc_id", "text_hash", "words", F.posexplode_outer("hashes").alias("pos", "h"))
    said = F.concat(*[F.concat(F.get("words", F.col("pos") + j), F.lit(" ")) for j in range(k)])
    # a prefix test, so that only the hash is a join key; the gram ends with a space
    return rolled.join(F.broadcast(grams), (F.col("h") == F.col("hash")) & said.startswith(F.col("gram"))).select(
        "doc_id", "text_hash", "tmpl", "label", "t_len", "pos", "t_pos")


def spans(votes: DataFrame, k: int = K, max_shift: int = MAX_SHIFT, max_gap: int = MAX_GAP) -> DataFrame:
    """Merged diagonals: ``doc_id``, ``text_hash``, ``tmpl``, ``label``, ``first``, ``last``
    (document words, last excluded), ``coverage`` of the template."""
    key = ["doc_id", "text_hash", "tmpl", "label", "t_len"]
    diagonals = votes.groupBy(*key, (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(
        F.min("pos").alias("lo"), (F.max("pos") + k).alias("hi"), F.collect_set("t_pos").alias("ts"))
    in_order = Window.partitionBy("doc_id", "text_hash", "tmpl").orderBy("lo", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(in_order)) > max_shift) | (
        F.col("lo") - F.max("hi").over(in_order.rowsBetween(Window.unboundedPreceding, -1)) > max_gap)
    marked = diagonals.withColumn("run", F.sum(F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)).over(in_order))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        F.flatten(F.collect_list("ts")), lambda t: F.sequence(t, t + (k - 1))))))
    return marked.groupBy(*key, "run").agg(
        F.min("lo").alias("first"), F.max("hi").alias("last"), (covered / F.first("t_len")).alias("coverage"),
    ).select("doc_id", "text_hash", "tmpl", "label", "first", "last", "coverage")


def base(padded: Column, phrases: dict[str, str] | None = None) -> dict[str, Column]:
    """Exact phrase counts over a normal text with a space before and after."""
    phrases = PHRASES if phrases is None else phrases
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    n_words = F.when(padded == "  ", 0).otherwise(spaces(padded) - 1).cast("long")
    count, firsts, lasts, labels = F.lit(0), [], [], []
    for p, label in phrases.items():
        has = F.instr(padded, f" {p} ") > 0
        count = count + F.when(has, F.regexp_count(padded, F.lit(f" {p}(?= )"))).otherwise(0)
        firsts.append(F.when(has, spaces(F.substring_index(padded, f" {p} ", 1))))
        lasts.append(F.when(has, n_words - spaces(F.substring_index(padded, f" {p} ", -1)) - len(p.split())))
        labels.append(F.when(has, label))
    return {
        "n_words": n_words, "n_base": count.cast("long"), "first_word": F.array_min(F.array(*firsts)).cast("long"),
        "last_word": F.array_max(F.array(*lasts)).cast("long"),
        "base_set": F.array_compact(F.array(*labels)),
    }


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, base columns, ``labels`` (base and verified
    templates), ``score`` (best template coverage)."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                        normal_text(F.col(text_col)).alias("norm"))
    found = spans(hits(named, template_grams(docs.sparkSession, templates)))
    best = found.groupBy("doc_id", "text_hash").agg(
        F.max(F.least("coverage", F.lit(1.0))).alias("best"),
        F.collect_set(F.when(F.col("coverage") >= coverage, F.col("label"))).alias("found"))
    best = best.select(F.col("doc_id").alias("b_id"), F.col("text_hash").alias("b_hash"), "best", "found")
    # a column of its own, so that the many uses below do not each build the string
    padded = named.select("doc_id", "text_hash", F.concat(F.lit(" "), "norm", F.lit(" ")).alias("padded"))
    counted = padded.select("doc_id", "text_hash", *[c.alias(n) for n, c in base(F.col("padded")).items()])
    text_of = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return counted.join(
        best, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("text_hash") == F.col("b_hash")), "left",
    ).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", text_of(F.col("base_set")).alias("base_labels"),
        text_of(F.concat("base_set", F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"))
