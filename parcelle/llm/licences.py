"""Licence scan: a positional index of the rare words of licence templates.

Each file's licence words are ranked by inverse document frequency over the corpus and looked
up in the postings (template, place) of the index. Hits that keep the same distance between
their places in file and template belong together; a template with enough of them, whose key
phrases stand in the file, gives its label. All of it are built-in functions and joins; the
index has a fixed number of rows, whatever the corpus.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelle.llm.common import cut, documents

# Phrases of the base, their labels, and what stands between words.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Label, text of the template, and the phrases without which it does not hold.
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License, version 3.", ["gnu general public license"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
     ["gnu general public license", "free software foundation"]),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
     ["gnu lesser general public license"]),
    ("apache", "Licensed under the Apache License, Version 2.0", ["apache license"]),
    ("mit", "Released under the MIT License.", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction", ["permission is hereby granted free of charge", "without restriction"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met", ["redistribution and use in source and binary forms", "provided that the following conditions"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
     ["permission to use copy modify", "with or without fee"]),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["mozilla public license"]),
    ("cc-by", "Licensed under CC BY 4.0.", ["cc by 4 0"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", ["cc by nc"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ["creative commons attribution", "international license"]),
    ("unlicense", "This is free and unencumbered software released into the public domain.", ["unencumbered software", "public domain"]),
    ("reserved", "All rights reserved.", ["all rights reserved"]),
]
#: Words too frequent in some language to be in the index; places between hits still count them.
FREQUENT = frozenset(
    "a all and any are as at by can for from in into is it later mit of on or that the this to under use with without you 0 2 3 4 v".split())
#: Licence words of a file that are looked up, rarest first. No template has so many.
LOOKED_UP = 64
#: Share of a template's index words that has to be found in place.
LEAST_SHARE = 0.6


def words_of(text: str) -> list[str]:
    return [w for w in re.split(NO_WORD, text.lower()) if w]


def postings() -> list[tuple[str, int, int]]:
    """Word, template and place of each index word."""
    return [(w, t, at) for t, (_, text, _) in enumerate(TEMPLATES) for at, w in enumerate(words_of(text)) if w not in FREQUENT]


def _values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small fixed table, as literals in the plan."""
    def literal(v) -> str:
        if isinstance(v, list):
            return f"array({', '.join(map(literal, v))})"
        return f"'{v}'" if isinstance(v, str) else str(v)
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({', '.join(map(literal, r))})" for r in rows) + f" AS fixed({names})")


def _phrase(phrase: str) -> str:
    return " " + phrase.replace(" ", "  ") + " "


def _words_in(padded: Column) -> Column:
    """Words of a text in which each word has a blank on either side."""
    return (F.length(padded) - F.length(F.replace(padded, F.lit(" "), F.lit("")))) / 2


def licence_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: key, ``n_words``, the base phrases and ``labels``, ``score``.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are their
    smallest and largest first words, counted from 0 (NULL without any). ``base_labels`` and
    ``labels`` are different labels, sorted and comma-joined; ``labels`` also has those of
    matched templates, and ``score`` is the largest share of a matched template found in place
    (0 without any). Missing and empty texts have no words, count 0 and no label; repeated rows
    each get a row; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    index = sorted({w for w, _, _ in postings()})
    core = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), NO_WORD, " "))
    rows = docs.select(F.col(key).alias("key"), core.alias("core"))
    rows = rows.withColumn("n_words", F.when(F.col("core") == "", 0).otherwise(F.length("core") - F.length(F.replace("core", F.lit(" "), F.lit(""))) + 1).cast("long"))
    overlap = F.arrays_overlap(F.split("core", " "), F.array(*map(F.lit, index)))
    # Each base phrase has an index word but for "cc by", whose "cc" is one too; other texts need no further look.
    rows = rows.select("key", "n_words", F.when(overlap, F.col("core")).alias("core"))
    found = cut(rows.withColumn("row", F.monotonically_increasing_id()))

    padded = F.concat(F.lit(" "), F.replace("core", F.lit(" "), F.lit("  ")), F.lit(" "))
    some = found.where("core IS NOT NULL").withColumn("padded", padded)
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE.items():
        there = F.lit(_phrase(phrase))
        times = (F.length("padded") - F.length(F.replace("padded", there, F.lit("")))) / len(_phrase(phrase))
        any_of = F.instr(F.col("padded"), _phrase(phrase)) > 0
        before = F.substring_index("padded", _phrase(phrase), 1)
        after = F.substring_index("padded", _phrase(phrase), -1)
        counts.append(F.when(any_of, times).otherwise(0).cast("long"))
        firsts.append(F.when(any_of, _words_in(before)).cast("long"))
        lasts.append(F.when(any_of, F.col("n_words") - _words_in(after) - len(phrase.split())).cast("long"))
        labels.append(F.when(any_of, F.lit(label)))
    base = some.select(
        "row", sum(counts[1:], counts[0]).alias("n_base"), F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"), F.array_compact(F.array(*labels)).alias("base_labels"),
    )

    places = _values(spark, postings(), "word, template, place")
    sizes: dict[int, int] = {}
    for _, t, _ in postings():
        sizes[t] = sizes.get(t, 0) + 1
    templates = _values(
        spark, [(t, label, sizes[t], [f" {k} " for k in phrases]) for t, (label, _, phrases) in enumerate(TEMPLATES)], "template, label, size, phrases")
    hits = (
        some.select("row", F.posexplode(F.split("core", " ")).alias("at", "word"))
        .join(F.broadcast(places.select("word").distinct()), "word")  # fixed words of the code
    )
    licence_words = hits.groupBy("row", "word").agg(F.count("*").alias("times"))
    frequency = licence_words.groupBy("word").agg(F.count("*").alias("files"))  # a row for each index word at most
    rarest = Window.partitionBy("row").orderBy("files", "word")
    looked_up = licence_words.join(F.broadcast(frequency), "word").withColumn("rank", F.row_number().over(rarest)).where(F.col("rank") <= LOOKED_UP)
    in_place = (
        hits.join(looked_up.select("row", "word"), ["row", "word"]).join(F.broadcast(places), "word")
        .groupBy("row", "template", (F.col("at") - F.col("place")).alias("shift")).agg(F.count("*").alias("hits"))
        .groupBy("row", "template").agg(F.max("hits").alias("hits"))
        .join(F.broadcast(templates), "template").withColumn("share", F.col("hits") / F.col("size")).where(F.col("share") >= LEAST_SHARE)
    )
    own = some.select("row", F.concat(F.lit(" "), "core", F.lit(" ")).alias("spaced"))
    matched = (
        in_place.join(own, "row").where(F.forall("phrases", lambda p: F.contains(F.col("spaced"), p)))
        .groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    )
    joined = found.drop("core").join(base, "row", "left").join(matched, "row", "left")
    none = F.array().cast("array<string>")
    mine = F.coalesce("base_labels", none)
    return joined.select(
        F.col("key").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct(mine)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(mine, F.coalesce("more", none))), ",").alias("labels"),
        F.coalesce("share", F.lit(0.0)).cast("double").alias("score"),
    )


def op7_licence_scan(spark, sf_dir: str) -> DataFrame:
    return licence_scan(documents(spark, sf_dir))
