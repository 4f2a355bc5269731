"""Deleted interpolation against counts by hand; weights against a plain EM on the held-out bigrams."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import lm
from scorekit.llm.common import crc_mod
from scorekit.llm.queries import lm_role

from ..conftest import SF_SMALL


def tokens(t):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


def role_of(d):
    r = zlib.crc32(str("" if d is None else d).encode()) % 10
    return 0 if r == 0 else 1 if r == 1 else 2


def bigrams(toks):
    return list(zip(["", *toks[:-1]], toks))


def counts(docs):
    c1, c2 = Counter(), Counter()
    for t in docs:
        c1.update(t)
        c2.update(bigrams(t))
    return c1, c2


def bucket(c):
    return 0 if not c else c.bit_length()


def by_hand(rows):
    docs = [(d, tokens(t), role_of(d)) for d, t in rows]
    e1, e2 = counts([t for _, t, r in docs if r == 2])
    a1, a2 = counts([t for _, t, r in docs if r != 0])
    n, n_est, v = sum(a1.values()), sum(e1.values()), len(a1)
    held = {}
    for _, t, r in docs:
        if r == 1:
            for x, y in bigrams(t):
                held.setdefault(bucket(e1[x]), []).append((e2[x, y] / e1[x] if e1[x] else 0, e1[y] / max(1, n_est), 1 / (v + 1)))
    lam = {}
    for b, p in held.items():
        p, w = np.array(p), np.array([0, .5, .5] if b == 0 else [1 / 3] * 3)
        for _ in range(200):
            s = w * p
            w = (s / s.sum(axis=1, keepdims=True)).mean(axis=0)
        lam[b] = w
    out = {}
    for d, t, r in docs:
        base = sum(math.log10((a1[w] + .1) / (n + .1 * (v + 1))) for w in t)
        out[d] = (r == 0, len(t), sum(a1[w] > 0 for w in t), n, base, t)
    return out, lam, (a1, a2, n, v)


def score_by_hand(t, weights, model):
    a1, a2, n, v = model
    s = 0.0
    for x, y in bigrams(t):
        w = weights[bucket(a1[x])]
        s += math.log10(w[0] * (a2[x, y] / a1[x] if a1[x] else 0) + w[1] * a1[y] / max(1, n) + w[2] / (v + 1))
    return s


def check(spark, rows, **kw):
    seen = {}
    real = lm.learn_weights
    lm.learn_weights = lambda *a: seen.setdefault("w", real(*a))
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string") if isinstance(rows, list) else rows
        res = lm.score(docs, lm_role("doc_id"), **kw).collect()
    finally:
        lm.learn_weights = real
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, lam, model = by_hand(rows)
    assert sorted(str(r.doc_id) for r in res) == sorted(str(d) for d, _ in rows)
    for r in res:
        held, n, known, train, base, t = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if train:
            assert r.score == pytest.approx(score_by_hand(t, seen["w"], model), rel=1e-9)
    return res, seen["w"], lam


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("n_chars < 4000")
    res, got, want = check(spark, docs, block_tokens=3000)
    assert np.allclose(got.sum(axis=1), 1)
    for b, w in want.items():  # estimates are binned to 1/8 of a factor of two
        assert np.abs(got[b] - w).max() < 0.05, (b, got[b], w)
    held = [r for r in res if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the mixture beats the unigram on unseen texts


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b A"), (3, "a b A"), (None, "a a"), (5, "é ß a"), (8, "w x " * 300_000), (9, "only here"), (14, "a b")]
    want, _, _ = by_hand(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("c")).withColumn("block", F.lit(1))
    res, _, _ = check(spark, docs)
    assert len(res) == len(rows) and all(math.isfinite(r.score) for r in res)


def test_no_training_rows_and_no_rows(spark):
    res = lm.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(0)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in res] == [(3, 0, 0, 0.0)]
    assert lm.score(spark.createDataFrame([], "doc_id long, text string"), crc_mod("doc_id", 10)).count() == 0


def test_weights_are_probabilities_and_follow_the_data():
    cells = np.array([[3, -1, -160, 900], [3, -9999, -160, 100], [0, -9999, -160, 5]], float)
    w = lm.learn_weights(cells, 1e-6)
    assert np.allclose(w.sum(axis=1), 1) and w[3][0] > .8 and w[0][0] == 0 and np.allclose(w[9], w[3])
