"""License scan by a positional index of rare tokens, in Spark's own functions only.

Words of licence texts are marked in every document, with their places, in one pass over the
texts.  Document frequencies of the marked words, over all documents, choose the ``RARE`` words
of highest IDF in each template; these and their places in the template are the index.  A file
looks its marked words up there; postings agree where they put the template at the same place
of the file (place in the file less place in the template), give or take ``SLACK`` words that
were put in or left out.  A template is found where agreeing postings carry ``ALIGNED`` of its
IDF and all its mandatory key phrases stand word for word at their places.

Only marks travel: a long text gives rows in proportion to its licence words, which are grouped
by file, template and place, so that no group gathers a file or a template in one task.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: Words of a template in the index; words that places may shift; share of IDF to be found.
RARE, SLACK, ALIGNED = 16, 8, 0.6

#: Words after lower-casing A-Z; the second, for Java, finds the same words before it.
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

# Phrases that give a label by themselves.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Words too common to be marked.
COMMON_WORDS = frozenset(
    "a all an and any are as at be by do following for free from general if in is it its may not of on "
    "one or other so such that the their they this to under use with without you your".split())


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


# Notices of common licences, and phrases without which they are none.
TEMPLATES = (
    Template("mit", "the MIT License", ("mit license",)),
    Template(
        "mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions",
        ("permission is hereby granted free of charge", "publish distribute sublicense")),
    Template("apache-2.0", "the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template(
        "apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at",
        ("apache license version 2 0", "except in compliance with the license")),
    Template("gpl-2.0", "the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template(
        "gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version",
        ("gnu general public license as published", "version 2 of the license")),
    Template(
        "gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version",
        ("gnu general public license as published", "version 3 of the license")),
    Template("lgpl", "the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "the GNU Affero General Public License", ("gnu affero general public license",)),
    Template("bsd", "the BSD License", ("bsd license",)),
    Template(
        "bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer",
        ("redistribution and use in source and binary forms",)),
    Template(
        "isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
        "all copies",
        ("for any purpose with or without fee is hereby granted",)),
    Template(
        "mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license v 2 0",)),
    Template(
        "unlicense", "This is free and unencumbered software released into the public domain",
        ("free and unencumbered software released into the public domain",)),
    Template("cc0-1.0", "CC0 1.0 Universal", ("cc0 1 0",)),
    Template("cc-by-4.0", "CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template(
        "cc-by-4.0", "Creative Commons Attribution 4.0 International",
        ("creative commons attribution 4 0",)),
    Template(
        "cc-by-sa-4.0", "Creative Commons Attribution-ShareAlike 4.0 International",
        ("creative commons attribution sharealike 4 0",)),
    Template(
        "cc-by-nc-4.0", "Creative Commons Attribution-NonCommercial 4.0 International",
        ("creative commons attribution noncommercial 4 0",)),
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def marked_words(templates: Sequence[Template], base: Mapping[str, str]) -> list[str]:
    """Words whose places are kept: all of templates and phrases that are not common."""
    texts = [x for t in templates for x in (t.text, *t.phrases)] + list(base)
    return sorted({w for x in texts for w in words_of(x)} - COMMON_WORDS)


def _constant(value, kind: str) -> Column:
    """A constant column of any type, part of the plan."""
    return F.from_json(F.lit(json.dumps({"x": value})), f"x {kind}")["x"]


def _by_first_mark(phrases: Sequence[tuple[str, dict]]) -> Column:
    """Phrases as a constant map from their first marked word, which stands ``ahead`` words in."""
    by_word: dict[str, list[dict]] = {}
    for phrase, rest in phrases:
        words = words_of(phrase)
        ahead = next(i for i, w in enumerate(words) if w not in COMMON_WORDS)
        by_word.setdefault(words[ahead], []).append({"ahead": ahead, "words": words, **rest})
    return _constant(by_word, "map<string, array<struct<ahead int, words array<string>, label string, "
                              "template int, code int, place int>>>")


def _standing(marks: Column, words: Column, phrases: Column, make) -> Column:
    """``make(phrase, begin)`` for each place where one of the phrases stands word for word."""
    def at(mark):
        begin = lambda p: mark["place"] - p["ahead"]
        told = lambda p: F.transform(
            F.slice(words, F.greatest(begin(p), F.lit(0)) + 1, F.size(p["words"])), ascii_lower)
        here = F.filter(F.try_element_at(phrases, mark["word"]),
                        lambda p: (begin(p) >= 0) & (told(p) == p["words"]))
        return F.transform(here, lambda p: make(p, begin(p)))

    triggers = F.filter(marks, lambda m: F.map_contains_key(phrases, m["word"]))
    return F.flatten(F.transform(triggers, at))


def scanned(docs: DataFrame, templates: Sequence[Template] = TEMPLATES,
            base: Mapping[str, str] = BASE_PHRASES) -> DataFrame:
    """One row per document, stored: its key, counts, base places, marks and key phrases."""
    listed = marked_words(templates, base)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("key"), F.xxhash64("text", "doc_id").alias("key2"),
        F.regexp_extract_all(text, F.lit(_ANY_CASE), F.lit(0)).alias("words"))
    # lower() also turns some other letters into a-z, so what it finds is looked at again
    mark = lambda w, i: F.when(
        F.lower(w).isin(listed) & ascii_lower(w).isin(listed),
        F.struct(i.alias("place"), ascii_lower(w).alias("word")))
    rows = rows.withColumn("marks", F.filter(F.transform("words", mark), lambda m: m.isNotNull()))
    own = [(p, {"template": t, "code": RARE + n, "place": _place(template, p)})
           for t, template in enumerate(templates) for n, p in enumerate(template.phrases)]
    places = _standing(F.col("marks"), F.col("words"), _by_first_mark([(p, {"label": x}) for p, x in base.items()]),
                       lambda p, begin: F.struct(begin.alias("begin"), p["label"].alias("label")))
    phrases = _standing(F.col("marks"), F.col("words"), _by_first_mark(own), lambda p, begin: F.struct(
        p["template"].alias("template"), p["code"].alias("code"), (begin - p["place"]).alias("shift")))
    return stored(rows.select("doc_id", "key", "key2", F.size("words").alias("n_words"), "marks",
                              places.alias("places"), phrases.alias("phrases")))


def _place(template: Template, phrase: str) -> int:
    words, part = words_of(template.text), words_of(phrase)
    return next(i for i in range(len(words)) if words[i:i + len(part)] == part)


def rare_words(rows: DataFrame, templates: Sequence[Template]) -> list[dict[str, float]]:
    """For each template its ``RARE`` words of highest IDF, with the IDF, from all documents.

    What comes to the driver is one count for each marked word.
    """
    n = rows.count()
    counts = dict(rows.select(F.explode(F.array_distinct("marks.word")).alias("word"))
                  .groupBy("word").count().collect())
    idf = lambda w: math.log(1 + (n + 1) / (counts.get(w, 0) + 1))
    return [{w: idf(w) for w in sorted(set(words_of(t.text)) - COMMON_WORDS, key=lambda w: (-idf(w), w))[:RARE]}
            for t in templates]


def candidates(rows: DataFrame, templates: Sequence[Template], rare: list[dict[str, float]]) -> DataFrame:
    """(key, key2, template, share, complete) of each place where postings of a template agree.

    ``share`` is the part of the template's IDF that agrees; ``complete`` says whether its key
    phrases stand there.  Places are dealt to tiles of twice ``SLACK``, two tilings half a tile
    apart, so places no further apart than ``SLACK`` share one.
    """
    postings: dict[str, list[dict]] = {}
    for t, (template, index) in enumerate(zip(templates, rare, strict=True)):
        for code, w in enumerate(index):
            for place in (i for i, x in enumerate(words_of(template.text)) if x == w):
                postings.setdefault(w, []).append({"template": t, "code": code, "place": place})
    index = _constant(postings, "map<string, array<struct<template int, code int, place int>>>")
    looked_up = (rows.select("key", "key2", F.explode("marks").alias("mark"))
                 .select("key", "key2", F.col("mark.place").alias("at"),
                         F.explode(F.try_element_at(index, F.col("mark.word"))).alias("p"))
                 .select("key", "key2", "p.template", "p.code", (F.col("at") - F.col("p.place")).alias("shift")))
    told = rows.select("key", "key2", F.inline("phrases"))
    tile = lambda offset: F.floor((F.col("shift") + offset) / (2 * SLACK)) * 2 + int(offset > 0)
    agreeing = (looked_up.unionByName(told)
                .select("key", "key2", "template", F.expr("shiftleft(1L, code)").alias("bit"),
                        F.explode(F.array(tile(0), tile(SLACK))).alias("tile"))
                .groupBy("key", "key2", "template", "tile").agg(F.bit_or("bit").alias("bits")))
    weights = _constant([list(index.values()) for index in rare], "array<array<double>>")
    needed = _constant([sum(1 << RARE + n for n in range(len(t.phrases))) for t in templates], "array<bigint>")
    own, bits = F.get(weights, F.col("template")), F.col("bits")
    summed = lambda ws: F.aggregate(ws, F.lit(0.0), lambda a, w: a + w)
    found = summed(F.transform(own, lambda w, i: F.when(F.getbit(bits, i) == 1, w).otherwise(0.0)))
    mask = F.get(needed, F.col("template"))
    return agreeing.select("key", "key2", "template", F.least(found / summed(own), F.lit(1.0)).alias("share"),
                           (bits.bitwiseAND(mask) == mask).alias("complete"))


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES,
                  base: Mapping[str, str] = BASE_PHRASES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    ``docs`` needs doc_id and text; other columns are ignored.  Base places are those where a
    phrase of ``base`` stands word for word; labels adds those of the templates found.  score
    is the largest share of a template's IDF found at one place, halved where a key phrase is
    missing or the share is below ``ALIGNED``, and at least 0.5 with a base place.

    A null text is empty and has no words; without a label both lists are empty texts, without
    a base place first_word and last_word are null.  Rows are scored each by itself: repeated
    rows give equal rows, a null id is kept, an empty table gives an empty result.  A task
    holds the words of one text at a time.
    """
    rows = scanned(docs, templates, base)
    rare = rare_words(rows, templates)
    labels = _constant([t.label for t in templates], "array<string>")
    taken = F.col("complete") & (F.col("share") >= ALIGNED)
    found = (candidates(rows, templates, rare)
             .groupBy(F.col("key").alias("_key"), F.col("key2").alias("_key2")).agg(
                 F.collect_set(F.when(taken, F.get(labels, F.col("template")))).alias("found"),  # labels at most
                 F.max(F.when(taken, F.col("share")).otherwise(F.col("share") / 2)).alias("best")))
    begins = F.col("places.begin")
    own = F.array_distinct("places.label")
    all_labels = F.array_union(own, F.coalesce("found", F.array().cast("array<string>")))
    joined = lambda xs: F.array_join(F.array_sort(xs), ",")
    return (rows.join(found, (F.col("key") == F.col("_key")) & (F.col("key2") == F.col("_key2")), "left")
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"),
                    F.size("places").cast("long").alias("n_base"),
                    F.array_min(begins).cast("long").alias("first_word"),
                    F.array_max(begins).cast("long").alias("last_word"),
                    joined(own).alias("base_labels"), joined(all_labels).alias("labels"),
                    F.greatest(F.coalesce("best", F.lit(0.0)),
                               F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score")))
