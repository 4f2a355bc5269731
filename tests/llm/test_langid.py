"""Rank-order language profiles against a plain count, and held-out accuracy."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from scorekit.llm import langid
from scorekit.llm.common import crc_mod

from ..conftest import SF_SMALL


def grams_by_hand(text):
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    out = Counter()
    for w in low.split():
        out.update(w)
    joined = " " + " ".join(low.split()) + " "
    for n in (2, 3):
        for i in range(len(joined) - n + 1):
            g = joined[i:i + n]
            if " " not in g[1:-1] and g.strip():
                out[g] += 1
    return out


def code(g):
    out = len(g) << 60
    for k, c in enumerate(g):
        out |= (0 if c == " " else ord(c)) << (langid.BITS * (len(g) - 1 - k))
    return out


def test_grams_in_one_and_many_pieces():
    letter = langid.letter_table()
    for t in ["", "a", "  Hello, wörld!! x", "ÉÀ 漢字かな 𐐀𐐁 z9z", "1 2 3", "the cat " * 40]:
        want = {code(g): n for g, n in grams_by_hand(t).items()}
        for at_once in (1 << 20, 3, 7):
            codes, n = langid.grams(t.encode(), letter, at_once=at_once)
            assert dict(zip(codes.tolist(), n.tolist())) == want, (t, at_once)


def by_hand(rows, top):
    prof = {}
    for d, t, lang in rows:
        if zlib.crc32(str("" if d is None else d).encode()) % 3 != 1 and lang is not None:
            prof.setdefault(lang, Counter()).update(grams_by_hand(t or ""))
    first = lambda c: [code(g) for g, n in sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:top]]
    prof = {k: {g: i for i, g in enumerate(first(v))} for k, v in prof.items()}
    out = []
    for d, t, _ in rows:
        mine = first(grams_by_hand(t or ""))
        if not mine or not prof:
            out.append((str(d), "und", 0.0))
            continue
        far, lang = min((sum(abs(p[g] - i) if g in p else top for i, g in enumerate(mine)), k) for k, p in prof.items())
        out.append((str(d), lang, round(1 - far / (top * len(mine)), 9)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in df.collect())


def run(docs, **kw):
    return langid.identify(docs, crc_mod("doc_id", 3) == 1, **kw)


def test_documents_and_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    res = run(docs)
    assert got(res) == by_hand(rows, 400)
    lang = {d: x for d, _, x in rows}
    held = [(r.lang_pred, lang[r.doc_id]) for r in res.collect() if r.held_out]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) > 0.95


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34 !", "de"), (4, "the cat sat", "en"), (4, "the cat sat", "en"), (5, "die katze saß", "de"),
            (6, "le chat", None), (None, "the the", "en"), (7, "katze " * 200_000, "de"), (8, "qqq", ""), (9, "漢字", "zh"), (10, "cat", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("gram", F.lit(1)).withColumn("rank", F.lit("x"))
    assert got(run(docs)) == by_hand(rows, 400)


def test_nothing_to_learn_from(spark):
    assert run(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert got(run(docs)) == [("1", "und", 0.0)]


def test_profiles_come_from_a_limited_window(spark):
    docs = spark.createDataFrame([(k, f"the cat {k} sat", "en") for k in range(50)], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs, F.lit(True), top=5)
    assert profiles._jdf.queryExecution().sparkPlan().toString().count("WindowGroupLimit") == 2  # before the shuffle and behind it
    assert sorted(r["rank"] for r in profiles.collect()) == [0, 1, 2, 3, 4]
