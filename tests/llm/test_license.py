"""License scans against phrases and templates matched word by word."""

import math
import re

import pytest
from pyspark.sql import functions as F

from scorekit.llm import license as lic

from ..conftest import SF_SMALL


def words(t):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def by_hand(texts, min_share=.5):
    base = [(lic.split_words(p), label) for p, label in lic.BASE]
    temps = [(label, lic.split_words(t), lic.split_words(p)) for label, t, p in lic.TEMPLATES]
    docs = [words(t) for t in texts]
    idf = lambda w: math.log((len(docs) + 1) / (sum(w in d for d in docs) + 1)) + 1e-6
    idf = {w: idf(w) for w in {w for p, _ in base for w in p} | {w for _, t, _ in temps for w in t}}
    out = []
    for d in docs:
        at = [(i, label) for p, label in base for i in range(len(d)) if d[i:i + len(p)] == p]
        own, more, top = {x for _, x in at}, set(), 0.0
        for label, t, p in temps:
            s = next(i for i in range(len(t)) if t[i:i + len(p)] == p)
            for i in range(len(d)):
                if d[i:i + len(p)] == p:
                    share = sum(idf[w] for j, w in enumerate(t) if 0 <= i - s + j < len(d) and d[i - s + j] == w) / sum(idf[w] for w in t)
                    if share >= min_share:
                        more.add(label)
                        top = max(top, share)
        places = [i for i, _ in at]
        out.append((len(d), len(at), min(places, default=None), max(places, default=None), ",".join(sorted(own)), ",".join(sorted(own | more)),
                    pytest.approx(min(top, 1.0))))
    return out


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("words", F.lit("c")).withColumn("labels", F.lit(1))
    got = {r.doc_id: tuple(r)[1:] for r in lic.scan(docs).collect()}
    for k, want in enumerate(by_hand(texts)):
        assert got[k] == want, (k, texts[k] and texts[k][:80])


def test_documents(spark):
    check(spark, [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()])


def test_odd_rows(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    check(spark, [None, "", " .,!", "cc by", "CC-BY cc by, CC\nBY", "cc", "by cc", "General public license", "GNU General Public License version 3",
                  gpl, gpl, f"é {gpl} All rights reserved. {gpl}", "all rights, reserved", "ALL RIGHTS RESERVEDé", "Released under the MIT License.",
                  "mit license", "the MIT license of it", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0", "x " * 200_000 + gpl,
                  "Permission is hereby granted, free of charge, to any person", "for any purpose with or without fee", "cc by " * 3000, "Kcc by"])


def test_empty_table(spark):
    df = lic.scan(spark.createDataFrame([], "doc_id long, text string"))
    assert df.count() == 0 and df.columns[1:4] == ["n_words", "n_base", "first_word"]


def test_templates_from_a_table(spark):
    """Three hundred notices in a table: the same labels as by hand, and a plan no longer than for eight."""
    notes = [(f"own-{k}", f"This file falls under the house rules number {k} of the works, see rules {k}", f"house rules number {k}") for k in range(300)]
    table = spark.createDataFrame(notes, "label string, notice string, key_phrase string")
    texts = [f"intro. {notes[k][1]} end" for k in (0, 7, 299)] + ["house rules number 5", "house rules number", "Number 7 of the house rules", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in lic.scan(docs, templates=table, min_share=0.9).collect()}
    assert [got[k] for k in range(3)] == [("own-0", pytest.approx(1.0)), ("own-7", pytest.approx(1.0)), ("own-299", pytest.approx(1.0))]
    assert all(got[k] == ("", 0.0) for k in range(3, len(texts)))
    with pytest.raises(ValueError):
        lic.scan(docs, templates=table, max_templates=299)
    with pytest.raises(ValueError):
        lic.scan(docs, templates=[("x", "one two", "two one")])


def test_size_of_no_hit_is_zero(spark):
    row = lic.scan(spark.createDataFrame([(1, "plain words")], "doc_id long, text string")).first()
    assert tuple(row) == (1, 2, 0, None, None, "", "", 0.0)
