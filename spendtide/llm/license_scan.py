"""Licence notices in documents, in DataFrame operations only.

Two searches run over every whole text. Base phrases count the places where a phrase's
words stand one after the other. Templates are found by an exact set-similarity join:
a text block (a line with words and the next three such lines, since headers wrap their
sentences and set them apart) meets a template if it holds at least ``containment`` of the template's distinct words. A block
has the words of its first line, so whatever a line alone meets is met.

The join orders words from rare to frequent over all documents. With ``need`` words to
share, a meeting pair shares a word among the first ``size - need + 1`` of the template
and among the first ``size - need + 1`` of the block (words outside all templates do
not count on either side), a block has ``need`` words at least, and the words after the
shared one must still reach ``need``. Those three filters lose no pair; what passes is
counted exactly. Templates are a fixed short table, so their word list may be broadcast.

Defined results: a null text counts as an empty one; ids are carried, not used, so null
and repeated ids keep a row each; an empty table gives an empty result; columns other
than the id and the text are never read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendtide.llm.texts import lower_ascii
from spendtide.plans.materialize import materialize

# Phrases and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# The usual one-line notices, as words.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this"
     " software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the"
     " terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are"
     " permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0",
     "mpl-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution sharealike 4 0 international license",
     "cc-by-sa"),
)

CONTAINMENT = 0.8
#: Neighbouring lines of a block, lines without a word left out.
LINES = 4


def _array(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _plain(text: Column) -> Column:
    """Lower-cased, each run of ASCII other than letters, digits and line ends a blank."""
    return F.regexp_replace(
        lower_ascii(F.coalesce(text, F.lit(""))),
        r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ",
    )


def _words(plain: Column) -> Column:
    return F.array_remove(F.split(F.translate(plain, "\n", " "), " "), "")


def frequency_order(words: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """``vocabulary`` from rare to frequent by the number of rows of ``words`` with it."""
    held = words.select(F.explode(F.array_intersect(_array(vocabulary), "words")).alias("word"))
    counts = {r.word: r.n for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _places(phrase: str) -> Column:
    """Word numbers, from 0, where ``phrase`` starts in the array ``words``."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        return reduce(
            Column.__and__, [F.get("words", i + k) == F.lit(w) for k, w in enumerate(parts)]
        )

    return F.when(
        F.array_contains("words", parts[0]) & F.array_contains("words", parts[-1]),
        F.filter(F.sequence(F.lit(0), F.size("words")), here),
    ).otherwise(F.array().cast("array<int>"))


def _meeting_blocks(
    blocks: DataFrame, templates: Sequence[tuple[str, str]], order: list[str], containment: float
) -> DataFrame:
    """(row, label, share) of each block in ``blocks`` (row, block) that meets a template."""
    rank, table = {w: k for k, w in enumerate(order)}, []
    for k, (text, label) in enumerate(templates):
        words = sorted(set(text.split()), key=rank.get)
        need = max(1, math.ceil(containment * len(words) - 1e-9))
        for at, word in enumerate(words[: len(words) - need + 1]):
            table.append((word, k, label, words, need, at))
    prefixes = blocks.sparkSession.createDataFrame(
        table, "word string, template int, label string, wanted array<string>, need int, at int"
    )
    least = min(r[4] for r in table)
    own = (
        blocks.select("row", "n", F.array_intersect(_array(order), F.split("block", " ")).alias("own"))
        .where(F.size("own") >= least)
        .select(
            "row", "n", "own",
            F.posexplode(F.slice("own", 1, F.size("own") - least + 1)).alias("place", "word"),
        )
    )
    shared = own.join(F.broadcast(prefixes), "word").where(
        (F.size("own") >= F.col("need"))
        & (F.col("place") <= F.size("own") - F.col("need"))
        & (1 + F.least(F.size("own") - F.col("place"), F.size("wanted") - F.col("at")) - 1
           >= F.col("need"))
    )
    return (
        shared.withColumn("overlap", F.size(F.array_intersect("own", "wanted")))
        .where("overlap >= need")
        .select("row", "label", (F.col("overlap") / F.size("wanted")).alias("share"))
    )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: Sequence[tuple[str, str]] = BASE,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word,
    base_labels, labels and score, the largest share of a template's words in one block
    (1 with a base phrase, 0 with nothing found)."""
    plain = docs.select(F.col(id_col).alias("id"), _plain(F.col(text_col)).alias("plain"))
    words = plain.withColumn("words", _words(F.col("plain")))
    order = frequency_order(words, sorted({w for t, _ in templates for w in t.split()}))
    rank = {w: k for k, w in enumerate(order)}
    rare = set()
    for text, _ in templates:
        own = sorted(set(text.split()), key=rank.get)
        rare |= set(own[: len(own) - max(1, math.ceil(containment * len(own) - 1e-9)) + 1])

    found = words.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.size("words").cast("long").alias("n_words"),
        *[_places(p).alias(f"at{k}") for k, (p, _) in enumerate(base)],
        F.when(
            F.arrays_overlap("words", _array(sorted(rare))),
            F.filter(F.split("plain", "\n"), lambda line: F.trim(line) != ""),
        )
        .otherwise(F.array().cast("array<string>")).alias("blocks"),
    )
    found = materialize(found, "license-words")
    joined = F.transform(
        "blocks", lambda _, i: F.array_join(F.slice("blocks", i + 1, F.lit(LINES)), " ")
    )
    blocks = found.select("row", F.posexplode(joined).alias("n", "block"))
    met = (
        _meeting_blocks(blocks, templates, order, containment)
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    )

    at = [F.col(f"at{k}") for k in range(len(base))]
    places = F.concat(*at)
    own = F.array_compact(
        F.array(*[F.when(F.size(a) > 0, F.lit(label)) for a, (_, label) in zip(at, base)])
    )
    return (
        found.join(met, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.size(places).cast("long").alias("n_base"),
            F.array_min(places).cast("long").alias("first_word"),
            F.array_max(places).cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
            F.array_join(
                F.array_sort(F.array_union(own, F.coalesce("more", F.array().cast("array<string>")))),
                ",",
            ).alias("labels"),
            F.when(F.size(places) > 0, F.lit(1.0))
            .otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        )
    )
