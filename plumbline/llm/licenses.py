"""License scans by diagonal voting. DataFrame operations only.

Every document is cut into words; the hashes of all its k-grams are joined to the positions at which the same k-gram
stands in a license template. A match votes for a diagonal (document position less template position): a copied notice
puts all its votes on one diagonal, an inserted or missing word moves the rest to a neighbouring one. Votes are summed by
diagonal, diagonals less than ``SLACK`` apart whose places touch are merged, and a merged span is verified: its k-grams
must cover enough of the template's words and enough of its own words, compared word by word and not by hash alone.

Fixed phrases (``PHRASES``) are looked up in the same k-grams, wherever their words stand consecutively.

The templates are a small table of fixed length (``template_grams`` refuses more than ``MOST_GRAMS`` rows), so it is
broadcast; no other row of a document than those that match leaves its task. Null and empty texts have no words, no
places and score 0; texts shorter than k words can still hold a phrase; very long texts are scanned whole; rows are told
apart by 64 bits of id and text, so null or equal ids do not matter; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import LETTERED, LOWER, UPPER, lowered, row_key, stored

K = 4
SLACK = 3
MOST_GRAMS = 100_000
#: Least share of the template's words and of the span's own words that matching k-grams must cover.
TEMPLATE_SHARE, SPAN_SHARE = 0.6, 0.7
#: Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: The public wording of notices, by label.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
     "this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
     "any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def words_of(text: str) -> list[str]:
    return re.findall(LETTERED, text.translate(str.maketrans(UPPER, LOWER)))


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """All k-grams of the templates: template, label, its number of words, the place and the words."""
    rows = []
    for number, (label, text) in enumerate(templates):
        words = words_of(text)
        rows += [(number, label, len(words), place, *words[place:place + k]) for place in range(len(words) - k + 1)]
    if len(rows) > MOST_GRAMS:
        raise ValueError(f"{len(rows)} k-grams of templates; at most {MOST_GRAMS} are broadcast")
    names = [f"t{i}" for i in range(k)]
    schema = "template int, label string, length int, place int, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, schema).withColumn("hash", F.xxhash64(*names))


def grams(words: Column, k: int) -> Column:
    """For each word an entry of it and the k - 1 words behind it, null past the end."""
    return F.arrays_zip(*[F.slice(words, i + 1, F.greatest(F.size(words) - i, F.lit(0))).alias(f"w{i}") for i in range(k)])


def phrase_label(phrases) -> Column:
    """The label of the phrase that begins at a k-gram; null if none does."""
    label = F.lit(None).cast("string")
    for phrase, name in phrases:
        here = F.lit(True)
        for i, word in enumerate(phrase.split()):
            here = here & (F.col(f"w{i}") == word)
        label = F.when(here, name).otherwise(label)
    return label


def hits(docs: DataFrame, id_col: str, text_col: str, templates=TEMPLATES, phrases=PHRASES, k: int = K) -> DataFrame:
    """Places of phrases (``phrase``) and matches of template k-grams (``template`` and its columns)."""
    tokens = F.regexp_extract_all(lowered(F.col(f"`{text_col}`")), F.lit(LETTERED), F.lit(0))
    # the words are a column of their own, so that they are cut once and not for every shifted copy
    rows = (docs.select(row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("id"), tokens.alias("words"))
            .select("id", F.posexplode(grams(F.col("words"), k)).alias("pos", "gram"))
            .select("id", "pos", "gram.*"))
    marked = rows.withColumn("hash", F.xxhash64(*[f"w{i}" for i in range(k)])).withColumn("phrase", phrase_label(phrases))
    known = template_grams(docs.sparkSession, templates, k)
    # the join has one number as its key; the words are compared on the few rows that it finds
    same = F.lit(True)
    for i in range(k):
        same = same & F.col(f"w{i}").eqNullSafe(F.col(f"t{i}"))
    matched = [F.when(same, F.col(c)).alias(c) for c in ("template", "label", "length", "place")]
    return (marked.join(F.broadcast(known), "hash", "left").where(F.col("phrase").isNotNull() | F.col("template").isNotNull())
            .select("id", "pos", "phrase", *matched).where(F.col("phrase").isNotNull() | F.col("template").isNotNull()).distinct())


def spans(found: DataFrame, k: int = K, slack: int = SLACK, template_share: float = TEMPLATE_SHARE,
          span_share: float = SPAN_SHARE) -> DataFrame:
    """Verified spans: id, template, label, first and last word, votes and the covered shares."""
    one = ["id", "template", "label", "length"]
    diagonals = (found.where(F.col("template").isNotNull()).withColumn("diagonal", F.col("pos") - F.col("place"))
                 .groupBy(*one, "diagonal")
                 .agg(F.sort_array(F.collect_list(F.struct("pos", "place"))).alias("votes")))
    # one diagonal holds a template at one place only, so it has at most as many votes as the template has words
    order = Window.partitionBy("id", "template").orderBy("diagonal")
    pieces = diagonals.withColumn("group", F.sum(F.when(
        F.col("diagonal") - F.lag("diagonal").over(order) <= slack, 0).otherwise(1)).over(order))
    # a run of near diagonals still ends where it would grow past the template's length and its slack
    merged = (pieces.withColumn("run", F.floor((F.col("diagonal") - F.min("diagonal").over(
        Window.partitionBy("id", "template", "group"))) / (F.col("length") + slack)))
        .groupBy(*one, "group", "run").agg(F.flatten(F.collect_list("votes")).alias("votes")))

    def covered(field: str) -> Column:
        places = F.transform("votes", lambda v: F.sequence(v[field], v[field] + F.lit(k - 1)))
        return F.array_distinct(F.flatten(places))

    inside, own = covered("place"), covered("pos")
    first, last = F.array_min(own), F.array_max(own)
    return (merged.select(*one, first.alias("first_word"), last.alias("last_word"), F.size("votes").alias("votes"),
                          (F.size(inside) / F.col("length")).alias("template_share"),
                          (F.size(own) / (last - first + 1)).alias("span_share"))
            .where((F.col("template_share") >= template_share) & (F.col("span_share") >= span_share)))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
                  k: int = K) -> DataFrame:
    """One row per document: words, places of phrases, labels, the best verified span's score and the spans."""
    found = stored(hits(docs, id_col, text_col, templates, phrases, k), "license-hits")
    base = (found.where(F.col("phrase").isNotNull()).select("id", "pos", "phrase").distinct()
            .groupBy("id").agg(F.count("*").alias("n_base"), F.min("pos").alias("first"), F.max("pos").alias("last"),
                               F.collect_set("phrase").alias("base_set")))
    span = F.struct("label", "template", "first_word", "last_word", "votes", "template_share", "span_share")
    verified = spans(found, k).groupBy("id").agg(
        F.sort_array(F.collect_list(span)).alias("spans"), F.collect_set("label").alias("span_set"),
        F.max(F.col("template_share") * F.col("span_share")).alias("best"))
    both = base.join(verified, "id", "full_outer").withColumnRenamed("id", "hit_id")
    nothing = F.array().cast("array<string>")
    base_set = F.coalesce(F.col("base_set"), nothing)
    count = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(LETTERED.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60"))), F.lit(0))
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return (docs.select(ident.alias("id"), row_key(ident, text).alias("key"), count.cast("long").alias("n_words"))
            .join(both, F.col("key") == F.col("hit_id"), "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                    F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"),
                    F.array_join(F.array_sort(base_set), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(base_set, F.coalesce(F.col("span_set"), nothing))), ",").alias("labels"),
                    # a bare phrase is weaker evidence than a whole notice
                    F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"),
                    "spans"))
