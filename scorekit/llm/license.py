"""License scans by a positional index of rare tokens.

The words of the licence templates are ranked by inverse document frequency over all documents. Every base
phrase and every mandatory key phrase is posted in the index under its highest-IDF word, with that word's
position. A file is looked up under its own licence words: each place of an indexed word gives, by relative
position, where a phrase would have to start. There the phrase is verified word by word, and the IDF share
of the template's words in place is the match. The index is a constant of the plan, whose size does not
depend on the number of templates. DataFrame expressions only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin, lower_ascii

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and the labels they give.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# Label, notice, mandatory key phrase.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2 0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", "cc by nc 4 0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "gnu general public license version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
     "for any purpose with or without fee"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files", "permission is hereby granted free of charge"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license v 2 0"),
)


def split_words(text: str) -> list:
    return [w for w in re.split(NOT_WORD, text.lower()) if w]


def words_of(text: Column) -> Column:
    """Array of the words of a text, lower-cased (A-Z); null as empty."""
    flat = F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD, " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def word_idf(words: DataFrame, vocab: list) -> dict:
    """IDF over all rows of ``words(words)`` of every word of ``vocab`` (a word of the templates), in one pass."""
    seen = words.select(F.explode(F.concat(F.array_intersect("words", _list(vocab)), F.array(F.lit("")))).alias("w")).groupBy("w").count()
    df = {r.w: r["count"] for r in seen.collect()}  # one row for each template word at most; the empty word counts all rows
    total = df.get("", 0)
    return {w: math.log((total + 1) / (df.get(w, 0) + 1)) + 1e-6 for w in vocab}


def _list(values) -> Column:
    return F.array(*map(F.lit, values))


def _entries(base, templates, max_templates: int) -> list:
    """``(label, is_base, words, key words, where the key stands in the words)`` of every phrase and template."""
    if isinstance(templates, DataFrame):
        templates = [tuple(r) for r in templates.select("label", "notice", "key_phrase").limit(max_templates + 1).collect()]
    if len(templates) > max_templates:
        raise ValueError(f"more than {max_templates} templates")
    out = [(label, True, split_words(p), split_words(p), 0) for p, label in base]
    for label, notice, key in templates:
        words, key = split_words(notice), split_words(key)
        at = next((s for s in range(len(words)) if words[s:s + len(key)] == key), None)
        if at is None:
            raise ValueError("a key phrase must stand in its template")
        out.append((label, False, words, key, at))
    if not out or not all(e[3] for e in out):
        raise ValueError("a phrase must have a word")
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, templates=TEMPLATES, min_share: float = 0.5,
         max_templates: int = 10_000) -> DataFrame:
    """``(id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every row.

    ``templates`` is a list of ``(label, notice, key phrase)`` or a table of ``(label, notice, key_phrase)``; more
    than ``max_templates`` are refused. ``n_base`` counts the places of all base phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start (null without one). A template gives its label where its
    key phrase stands in full and ``min_share`` of its words by IDF are in place; ``score`` is the largest such
    share, 0 without one. A file that holds a phrase holds its highest-IDF word, so no place is missed; of
    equally rare words the first in the phrase is posted. A null or empty text has no word; a very long text is read
    whole. Rows are judged alone: repeated rows and ids stay; other columns are not read; an empty table gives an
    empty result."""
    begin(docs.sparkSession)
    words = docs.select(F.col(id_col), words_of(F.col(text_col)).alias("words"))
    entries = _entries(base, templates, max_templates)
    idf = word_idf(words.select("words"), sorted({w for e in entries for w in e[2]}))

    index, known = {}, []
    for k, (label, is_base, template, key, at) in enumerate(entries):
        rare = min(range(len(key)), key=lambda j: (-idf[key[j]], j))
        index.setdefault(key[rare], []).append(F.struct(F.lit(k).alias("k"), F.lit(rare).alias("shift")))
        total = sum(idf[w] for w in template)
        known.append(F.struct(F.lit(label).alias("label"), F.lit(is_base).alias("is_base"), _list(template).alias("words"),
                              _list([idf[w] / total for w in template]).alias("part"), _list(key).alias("key"), F.lit(at).alias("at")))
    known = F.array(*known)
    rarest_first = sorted(index, key=lambda w: (-idf[w], w))
    postings = F.create_map(*[x for w in rarest_first for x in (F.lit(w), F.array(*index[w]))])

    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(*rarest_first), F.struct(i.alias("at"), w.alias("w")))),
                    lambda h: h.isNotNull())
    # where an entry's key phrase would have to start, by the indexed word's place
    starts = F.flatten(F.transform(hits, lambda h: F.transform(
        F.element_at(postings, h["w"]), lambda p: F.struct(F.get(known, p["k"]).alias("e"), (h["at"] - p["shift"]).alias("at")))))

    def stands(s):
        key = s["e"]["key"]
        return (s["at"] >= 0) & (F.slice("words", F.greatest(s["at"], F.lit(0)) + 1, F.size(key)) == key)

    def share(s):
        """Share by IDF of the template's words in place."""
        e, first = s["e"], s["at"] - s["e"]["at"]
        in_place = F.zip_with(F.transform(e["words"], lambda w, j: F.coalesce(F.get("words", first + j) == w, F.lit(False))), e["part"],
                              lambda ok, part: F.when(ok, part).otherwise(0.0))
        return F.aggregate(in_place, F.lit(0.0), lambda a, b: a + b)

    found = F.transform(F.filter(starts, stands), lambda s: F.struct(
        s["e"]["label"].alias("label"), s["e"]["is_base"].alias("is_base"), s["at"].alias("at"),
        F.when(~s["e"]["is_base"], share(s)).alias("share")))
    looked = F.arrays_overlap("words", _list(rarest_first))  # the file's own words that the index has
    d = words.select(F.col(id_col), F.size("words").cast("bigint").alias("n_words"), F.when(looked, found).alias("found"))

    own = F.transform(F.filter("found", lambda f: f["is_base"]), lambda f: f["at"])
    fits = F.filter("found", lambda f: ~f["is_base"] & (f["share"] >= min_share))

    def listed(rows):
        return F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda f: f["label"]))), ","), F.lit(""))
    return d.select(id_col, "n_words", F.coalesce(F.size(own), F.lit(0)).cast("bigint").alias("n_base"),
                    F.array_min(own).cast("bigint").alias("first_word"), F.array_max(own).cast("bigint").alias("last_word"),
                    listed(F.filter("found", lambda f: f["is_base"])).alias("base_labels"),
                    listed(F.filter("found", lambda f: f["is_base"] | (f["share"] >= min_share))).alias("labels"),
                    F.least(F.coalesce(F.array_max(F.transform(fits, lambda f: f["share"])), F.lit(0.0)), F.lit(1.0)).alias("score"))
