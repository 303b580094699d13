"""License scan: exact places of short phrases, and an exact set-similarity join of text blocks with license templates.

All in column expressions and joins. A text's words are taken once. Places of phrases are found in the words joined by
spaces. The join finds every block of a text that holds at least ``percent`` of 100 of a template's distinct words:

1. The words of all templates are ordered by the number of documents that hold them, the rarest first.
2. Of a template with s words, of which a block needs c, the first ``s - c + 1`` are its prefix. A block that matches
   holds one of them (prefix filter), so only texts with a prefix word are cut into blocks.
3. A block is a run of words twice as long as the templates of a length class, and begins every half length: a run as
   long as a template lies in one block. Blocks keep only words of their class's templates, in the global order.
4. Prefix words of blocks meet those of templates in an equality join. Blocks of fewer than c such words (length
   filter) and pairs with too few words behind the shared one (positional filter) go, the rest is counted in full.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorespan.llm.common import materialize

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PERCENT = 95
#: Words of the shortest half block.
SHORTEST = 16
#: Bytes of template words up to which templates are broadcast; larger sets of templates are joined by shuffling.
BROADCAST_BYTES = 8 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The phrases of the base scan with their labels.
PHRASES: dict[str, str] = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences of public licenses and usual notices, with their labels.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    ("all-rights-reserved", "copyright all rights reserved"),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    (
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
    ),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def words_of(text: str) -> list[str]:
    """The words of a parameter, by the rule that holds for texts."""
    return re.findall(WORDS, text.translate(str.maketrans(_UPPER, _LOWER)))


@dataclass(frozen=True)
class Template:
    """One template: ``words`` are distinct; a match holds at least ``least`` of them."""

    label: str
    words: tuple[str, ...]
    least: int
    half: int

    @property
    def prefix(self) -> int:
        return len(self.words) - self.least + 1


def prepared(templates: tuple[tuple[str, str], ...], percent: int) -> list[Template]:
    """Templates with their length classes; those without words are left out."""
    out = []
    for label, text in templates:
        found = words_of(text)
        distinct = tuple(dict.fromkeys(found))
        if distinct:
            half = SHORTEST
            while half < len(found):
                half *= 2
            out.append(Template(label, distinct, -(-percent * len(distinct) // 100), half))
    return out


def in_order(templates: list[Template], words: DataFrame) -> tuple[list[Template], list[str]]:
    """(templates, all their words) ordered by the documents that hold the words (``words``: a column of that name)."""
    vocabulary = sorted({w for t in templates for w in t.words})
    if not vocabulary:
        return templates, []
    held = words.select(F.explode(F.array_intersect(F.lit(vocabulary), "words")).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}  # a row a template word
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    return [Template(t.label, tuple(sorted(t.words, key=rank.__getitem__)), t.least, t.half) for t in templates], order


def _places(phrases: dict[str, str]) -> dict[str, Column]:
    """``n_base, first_word, last_word, base_labels`` from ``words`` and ``spaced`` (its words between spaces)."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        found = words_of(phrase)
        if not found:
            continue
        needle = " " + " ".join(found) + " "
        there = F.col("spaced").contains(needle)
        counts.append(F.when(there, F.regexp_count("spaced", F.lit(f"(?={needle})"))).otherwise(0))
        before = F.substring_index("spaced", needle, 1)
        behind = F.substring_index("spaced", needle, -1)
        firsts.append(F.when(there, _spaces(before)))
        lasts.append(F.when(there, F.size("words") - _spaces(behind) - len(found)))
        labels.append(F.when(there, F.lit(label)))
    none = F.lit(None).cast("int")
    return {
        "n_base": sum(counts, F.lit(0)).cast("long"),
        "first_word": F.array_min(F.array(none, *firsts)).cast("long"),
        "last_word": F.array_max(F.array(none, *lasts)).cast("long"),
        "base": F.array_compact(F.array(F.lit(None).cast("string"), *labels)),
    }


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _class_blocks(half: int, known: list[str], least: int) -> Column:
    """The blocks of one length class that hold at least ``least`` of its words ``known``."""

    def block(k: Column) -> Column:
        own = F.array_intersect(F.lit(known), F.slice("words", k * half + 1, 2 * half))
        return F.struct(F.lit(half).alias("half"), k.alias("block"), own.alias("words"))

    last = F.greatest(F.ceil(F.size("words") / F.lit(half)).cast("int") - 2, F.lit(0))
    return F.filter(F.transform(F.sequence(F.lit(0), last), block), lambda b: F.size(b["words"]) >= least)


def _blocks(templates: list[Template], order: list[str]) -> Column:
    """The blocks of all length classes as ``(half, block, words)``, for texts with a prefix word of a template."""
    parts = []
    for half in sorted({t.half for t in templates}):
        own = [t for t in templates if t.half == half]
        held = {w for t in own for w in t.words}
        parts.append(_class_blocks(half, [w for w in order if w in held], min(t.least for t in own)))
    prefixes = sorted({w for t in templates for w in t.words[: t.prefix]})
    return F.when((F.size("words") > 0) & F.arrays_overlap("words", F.lit(prefixes)), F.concat(*parts))


def matched_blocks(rows: DataFrame, templates: list[Template]) -> DataFrame:
    """``row, half, block, label, held, size`` of every block and template that match (``rows``: ``row, blocks``).

    ``held`` of the template's ``size`` words are in the block, which begins at word ``half * block``.
    """
    spark = rows.sparkSession
    own = [(t.half, t.label, i, w, len(t.words), t.least, list(t.words)) for t in templates for i, w in enumerate(t.words[: t.prefix])]
    schema = "half int, label string, i int, word string, size int, least int, all array<string>"
    prefixes = spark.createDataFrame(own, schema)
    if sum(len(w.encode()) for t in templates for w in t.words) * max((t.prefix for t in templates), default=1) <= BROADCAST_BYTES:
        prefixes = F.broadcast(prefixes)
    least = {half: min(t.least for t in templates if t.half == half) for half in {t.half for t in templates}}
    shortest = F.lit(1)
    for half, value in least.items():
        shortest = F.when(F.col("half") == half, F.lit(value)).otherwise(shortest)
    blocks = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.*")
    open_words = blocks.select("*", F.posexplode(F.slice("words", F.lit(1), F.size("words") - shortest + 1)).alias("j", "word"))
    behind = F.least(F.col("size") - F.col("i"), F.size("words") - F.col("j"))
    pairs = open_words.join(prefixes, ["half", "word"]).where((F.size("words") >= F.col("least")) & (behind >= F.col("least")))
    counted = pairs.withColumn("held", F.size(F.array_intersect("words", "all"))).where("held >= least")
    return counted.select("row", "half", "block", "label", "held", "size")


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row of ``docs``.

    Takes ``doc_id long, text``; other columns are ignored. Null and empty texts have no words, no places and empty
    labels. Null ids stay null; repeated rows give rows of their own. ``score`` is 1 where a phrase stands, else the
    largest share of a matched template's words that a block holds, else 0. An empty table gives an empty result.
    Phrases and templates without words are left out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(lowered(text), F.lit(WORDS), F.lit(0)).alias("words")
    )
    ready, order = in_order(prepared(templates, percent), words.select("words"))
    blocks = _blocks(ready, order) if ready else F.lit(None).cast("array<struct<half:int,block:int,words:array<string>>>")
    spaced = words.withColumn("spaced", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    # Row numbers of a written table stay what they are; they tell rows with equal ids apart.
    rows = materialize(
        spaced.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            *(c.alias(name) for name, c in _places(phrases).items()),
            blocks.alias("blocks"),
        ),
        "licenses",
    )
    found = (
        matched_blocks(rows.where("blocks IS NOT NULL"), ready)
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max(F.col("held") / F.col("size")).alias("share"))
    )
    more = F.coalesce("more", F.array().cast("array<string>"))
    return rows.drop("blocks").join(found, "row", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        _joined(F.col("base")).alias("base_labels"),
        _joined(F.concat("base", more)).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
