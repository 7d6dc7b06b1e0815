"""License scan by diagonal voting.

Texts become words (runs of letters, digits and non-ASCII characters). The hash of every run of ``K``
words of every text is joined with the places of the same run in a small table of license templates;
the words themselves are compared too, so a vote is never a hash collision. A match of text place p with
template place t votes for diagonal p - t: a literal copy puts all its votes on one diagonal, a copy with words
put in or left out on neighbouring ones. Votes are grouped by (text, template, diagonal); each voted diagonal
is merged with those up to ``SHIFT`` further, and the span is verified by the share of the template's
words that its runs cover, word for word. A span that covers ``SHARE`` of a notice carries its
license; a phrase must stand whole on a single diagonal.

Texts are told apart by a digest, so copies vote once, and the result of a text goes back to all rows that
hold it. Nothing but votes is shuffled.

Defined cases: null and empty texts have no words, empty labels and score 0; texts shorter than K words
have no runs; overlapping places of one phrase all count; equal rows get equal results; an empty table gives
an empty result. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ready, stored

K, SHIFT = 3, 3
#: A notice is found where a span covers this part of its words.
SHARE = (4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words before A-Z are lowered.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases that count wherever they stand whole, and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Notices and first paragraphs of public licenses, as words, and their labels.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    is_phrase: bool


def templates(phrases=PHRASES, notices=NOTICES) -> list[Template]:
    out = [Template(label, tuple(re.findall(WORD, text)), kind) for kind, rows in ((True, phrases), (False, notices)) for label, text in rows]
    short = [t for t in out if len(t.words) < K]
    if short:
        raise ValueError(f"templates of fewer than {K} words: {short}")
    return out


def template_runs(spark: SparkSession, known: list[Template]) -> DataFrame:
    """hash, template, t, label, m (words), is_phrase and the run's words: a row for each place of a template."""
    rows = [(i, t, x.label, len(x.words), x.is_phrase, *x.words[t : t + K]) for i, x in enumerate(known) for t in range(len(x.words) - K + 1)]
    said = [f"said{j}" for j in range(K)]
    return spark.createDataFrame(rows, "template int, t int, label string, m int, is_phrase boolean, " + ", ".join(f"{c} string" for c in said)).withColumn("hash", F.xxhash64(*said))


def lowered(word: Column) -> Column:
    return F.translate(word, UPPER, LOWER)


def _texts(docs: DataFrame) -> tuple[Column, Column]:
    """The text (null: empty) and its digest."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return text, F.sha2(text, 256)


def votes(docs: DataFrame, known: list[Template]) -> DataFrame:
    """text_key, template, label, m, is_phrase, diagonal, places: the template places that a text's diagonal matches."""
    text, key = _texts(docs)
    words = docs.select(key.alias("text_key"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    later = [F.slice("words", 1 + j, F.size("words")) for j in range(1, K)]
    runs = words.select("text_key", F.posexplode(F.arrays_zip("words", *later)).alias("p", "run"))
    run = [F.col("run")[name] for name in ("words", *(str(j) for j in range(1, K)))]
    runs = runs.select("text_key", "p", *[w.alias(f"w{j}") for j, w in enumerate(run)]).where(F.col(f"w{K - 1}").isNotNull())
    # lower() also changes letters beyond A-Z; the words are compared by A-Z alone below
    runs = runs.withColumn("hash", F.xxhash64(*[F.lower(f"w{j}") for j in range(K)]))
    table = F.broadcast(template_runs(docs.sparkSession, known))  # a row for each place of the fixed templates
    hits = runs.join(table, "hash")
    for j in range(K):
        hits = hits.where(lowered(F.col(f"w{j}")) == F.col(f"said{j}"))
    cell = ["text_key", "template", "label", "m", "is_phrase", (F.col("p") - F.col("t")).alias("diagonal")]
    return hits.groupBy(*cell).agg(F.collect_set("t").alias("places"))


def spans(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """text_key, template, label, is_phrase, first_word, last_word, score, found: the span that starts at each voted diagonal."""
    ready(docs.sparkSession)
    near = Window.partitionBy("text_key", "template").orderBy("diagonal").rangeBetween(0, SHIFT)
    cells = votes(docs, known or templates())
    merged = cells.withColumn("near", F.collect_list(F.struct("diagonal", "places")).over(near))
    own = F.array(F.struct("diagonal", "places"))
    merged = merged.withColumn("near", F.when(F.col("is_phrase"), own).otherwise(F.col("near")))
    covered = F.array_distinct(F.flatten(F.flatten(F.transform("near", lambda d: F.transform(d["places"], lambda t: F.sequence(t, t + K - 1))))))
    starts = F.transform("near", lambda d: d["diagonal"] + F.array_min(d["places"]))
    ends = F.transform("near", lambda d: d["diagonal"] + F.array_max(d["places"]) + K - 1)
    found = F.when(F.col("is_phrase"), F.size("covered") == F.col("m")).otherwise(F.size("covered") * SHARE[1] >= F.col("m") * SHARE[0])
    return merged.withColumn("covered", covered).select(
        "text_key", "template", "label", "is_phrase",
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(ends).cast("long").alias("last_word"),
        (F.size("covered") / F.col("m")).alias("score"), found.alias("found"),
    )


def scan(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    text, key = _texts(docs)
    all_spans = spans(docs, known)
    base = F.col("is_phrase") & F.col("found")
    # written first: a text that very many rows hold can then be split in the join
    by_text = stored(all_spans.groupBy("text_key").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("found"), F.col("label")))), ",").alias("labels"),
        F.max("score").alias("score"),
    ))
    rows = docs.select("doc_id", key.alias("text_key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"))
    none = F.lit("")
    return rows.join(by_text, "text_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
