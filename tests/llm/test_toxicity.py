"""Toxicity: the kernel against a brute-force subsequence count, and held-out accuracy on planted insults."""

import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import toxicity as tox
from scorekit.llm.common import crc_mod

INSULTS = ["pathetic", "worthless", "disgusting", "blockhead"]


def kernel_by_hand(s, decay):
    out = {}
    for at in combinations(range(len(s)), 4):
        steps = np.diff(at)
        if steps.max(initial=0) <= 2 and all(s[k] > 0 for k in at):
            code = (int(s[at[0]]) << 15) | (int(s[at[1]]) << 10) | (int(s[at[2]]) << 5) | int(s[at[3]])
            out[code] = out.get(code, 0) + decay ** (at[-1] - at[0] - 3)
    return out


def test_features_and_windows_match_brute_force():
    rng, table = np.random.default_rng(0), tox.symbol_table()
    weights = rng.normal(size=tox.TABLE).astype(np.float32)
    for text in ["pathetic", "pa thetic!", "Ümlaut ñandú wörd", "a1b2", "", "abcabcabc dd"]:
        s = tox.symbols(text.encode(), table)
        assert tox.features(s, .6) == pytest.approx(kernel_by_hand(s, .6))
    weights[[c for c in range(0, tox.TABLE) if 0 in ((c >> 15) & 31, (c >> 10) & 31, (c >> 5) & 31, c & 31)]] = 0
    s = tox.symbols(b"some words here, to be scored by windows of six", table)
    got = tox.window_scores(s, weights, .6, 6)
    for a in range(len(s)):
        want = 0.0
        for k in range(a, min(a + 6, len(s))):
            for p in tox.PATTERNS:
                if k + p[-1] < len(s) and all(s[k + o] for o in p):
                    c = [int(s[k + o]) for o in p]
                    want += .6 ** (p[-1] - 3) * weights[(c[0] << 15) | (c[1] << 10) | (c[2] << 5) | c[3]]
        assert got[a] == pytest.approx(want, abs=1e-4)


def test_single_letters_set_apart_are_one_string():
    t = tox.symbol_table()
    assert tox.symbols(b"an i-d-i-o-t here", t).tolist() == tox.symbols(b"an idiot here", t).tolist()


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(4)
    parts = ["an", "ber", "tion", "er", "the", "lo", "ing", "sa", "mu", "ri", "de", "no"]
    word = lambda: "".join(rng.choice(parts, int(rng.integers(1, 4))))
    docs, labels = [], []
    for d in range(1500):
        w = [word() for _ in range(int(rng.integers(5, 80)))]
        bad = d % 6 == 0
        if bad:
            x = str(rng.choice(INSULTS))
            if d % 12 == 0:  # half of them with an inserted character
                k = int(rng.integers(2, len(x) - 2))
                x = x[:k] + str(rng.choice(list("-x*"))) + x[k:]
            w.insert(int(rng.integers(0, len(w))), x)
        docs.append((d, " ".join(w).capitalize() + "."))
        labels.append((d, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def run(docs, labels, **kw):
    return tox.score(docs, labels, crc_mod("doc_id", 5) == 0, **kw)


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    res = run(docs, labels).collect()
    held = [r for r in res if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in res) and len(held) > 120
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in res)
    plain = [r for r in held if not (truth[r.doc_id] and r.doc_id % 12 == 0)]
    assert np.mean([r.predicted == truth[r.doc_id] for r in plain]) > 0.95
    gapped = [r.predicted for r in held if truth[r.doc_id] and r.doc_id % 12 == 0]
    assert len(gapped) > 20 and np.mean(gapped) >= 0.9
    again = run(docs.repartition(3), labels.repartition(2)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, res))


def test_odd_rows(spark, tables):
    docs, labels = tables
    rows = [(2001, None), (2002, ""), (2003, "12 !"), (2004, "pathetic"), (2004, "pathetic"), (None, "the tion " * 3), (2006, "tion ber " * 300_000 + "worthless pathetic disgusting")]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    more = labels.union(spark.createDataFrame([(None, 1), (5, None), (7, 9), (2001, 1)], "doc_id long, toxic int"))
    res = run(docs.union(odd).withColumn("toxic", F.lit("clash")).withColumn("score", F.lit(1)), more).where("doc_id > 2000 or doc_id is null").collect()
    assert len(res) == 7
    by = {}
    for r in res:
        by.setdefault(r.doc_id, []).append(r)
    assert len({r.score for d in (2001, 2002, 2003) for r in by[d]}) == 1 and by[2001][0].predicted == 0
    assert [r.predicted for r in by[2004]] == [1, 1] and by[2006][0].predicted == 1 and by[None][0].predicted == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in run(docs, none).collect()] == [(0.0, 0)] * 2 or all(r.predicted == 0 for r in run(docs, none).collect())
    assert run(docs.limit(0), none).count() == 0


def test_few_labels_still_tell_texts_apart(spark):
    from ..conftest import SF_SMALL
    res = run(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()
    assert len({r.score for r in res}) > 0.5 * len(res) and any(r.predicted for r in res)


def test_score_does_not_depend_on_pieces(spark):
    rng = np.random.default_rng(2)
    say = lambda n: " ".join(rng.choice(["the", "river", "stone", "cloud", "garden"], n))
    model = tox.fit([f"{say(8)} {w} {say(8)}".encode() for w in INSULTS * 40], [say(16).encode() for _ in range(200)], .25)
    assert model.weights.any()
    text = say(400) + " " + " ".join(INSULTS) + " " + say(10)  # all insults in one part
    s = tox.symbols(text.encode(), tox.symbol_table())
    v = tox.window_scores(s, model.weights, model.decay, model.window)
    want = float(v.max()), float(np.sort(v)[-(len(v) // 50):].mean())
    for cut in (len(v), 1000, 100, 7):
        assert tox.levels([v[a:a + cut] for a in range(0, len(v), cut)]) == pytest.approx(want, rel=1e-5)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = tox.predict(docs, model).first().score
    for at_once in (1000, 100):
        assert tox.predict(docs, model, at_once=at_once).first().score == pytest.approx(whole, rel=1e-4)
