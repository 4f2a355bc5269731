"""Collocations: the double-array trie, and the whole result, against counting by hand."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import collocations as co

from ..conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("k", [1, 2, 3])
def test_trie_counts_phrases(k):
    rng = np.random.default_rng(k)
    text = np.minimum(rng.zipf(1.3, 20_000), 900).astype(np.int32)
    text[rng.random(len(text)) < .1] = 0
    seen = Counter(zip(*[text[i:len(text) - k + 1 + i].tolist() for i in range(k)]))
    rows = np.array(sorted(p for p in seen if 0 not in p)[::2], np.int64)
    trie = co.Trie(rows).arrays()
    n = np.bincount(co.advance(trie, text, k), minlength=len(trie[3]))[trie[5]]
    assert {tuple(r): int(c) for r, c in zip(rows.tolist(), n)} == {tuple(r): seen[tuple(r)] for r in rows.tolist()}
    wanted = set(map(tuple, rows.tolist()))
    assert sum(n) == sum(c for p, c in seen.items() if p in wanted)
    assert len(np.unique(trie[5])) == len(rows)


def test_trie_is_compact():
    rng = np.random.default_rng(3)
    rows = np.unique(np.minimum(rng.zipf(1.25, (200_000, 3)), 50_000), axis=0)
    t = co.Trie(rows)
    assert len(t.base) < 24 * len(rows)


def test_trie_takes_short_texts():
    trie = co.Trie(np.array([[3, 4, 5]])).arrays()
    for n in range(4):
        assert (co.advance(trie, np.array([3, 4, 5, 9][:n], np.int32), 3) == trie[5][0]).sum() == (n == 3)


def by_hand(rows, max_words=3, least=10, top=2000, share=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = set()
    for (lang, p), a in cand.items():
        for k in range(2, len(p)):
            gone.update((lang, p[i:i + k]) for i in range(len(p) - k + 1) if 100 * a >= share * f[lang, p[i:i + k]])
    out = []
    for lang in n:
        scored = []
        for (x, p), a in cand.items():
            if x == lang and (x, p) not in gone:
                score, _, left, right = min((10**6 * a * a // (f[x, p[:k]] * f[x, p[k:]]), k, f[x, p[:k]], f[x, p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(4)
    vocab = np.array(["the", "of", "New", "york", "Été", "-x", *[f"w{i}" for i in range(12)]])
    rows = []
    for d in range(400):
        words = rng.choice(vocab, int(rng.integers(0, 40)), p=np.array([.3, .1, .1] + [.5 / 15] * 15)).tolist()
        words = [w + str(rng.choice(["", "", "", ",", ".", "\n", " \t ", "!?"])) for w in words]
        if d % 3 == 0:
            words += ["grand", "central", "station"]
        rows.append((["en", "de", None, "und"][d % 4], " ".join(words)))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block_tokens": 300, "trie_phrases": 40, "bucket_bits": 4}])
def test_same_as_by_hand(spark, texts, sizes):
    df = spark.createDataFrame(texts, "lang string, text string").repartition(4)
    assert got(co.collocations(df, **sizes)) == by_hand(texts)


def test_other_lengths_and_limits(spark, texts):
    df = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    for max_words, least, top, share in ((4, 3, 40, 90),):
        want = by_hand(texts, max_words, least, top, share)
        assert got(co.collocations(df, max_words=max_words, least=least, top=top, share=share, trie_phrases=60)) == want


def test_driver_tables(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = by_hand([(r.lang, r.text) for r in d.collect()])
    assert got(co.collocations(d)) == want and len(want) > 50


def test_scores_are_exact(spark):
    big = [(10**12 + 7, 10**12 + 9, 10**12 + 11), (3, 3, 3), (10, 7 * 10**14, 11)]
    df = spark.createDataFrame(big, "a long, l long, r long")
    dec = lambda c: F.col(c).cast("decimal(15,0)")
    assert [r[0] for r in df.select(co._floor_score(dec("a"), dec("l"), dec("r"))).collect()] == [10**6 * a * a // (l * r) for a, l, r in big]


def test_odd_rows(spark):
    rows = [(None, None), ("en", ""), ("en", " \t "), ("en", ",.;"), (None, "a b. " * 12), ("und", "a b"), ("en", "x y z " * 300_000), ("en", "one " * 9), ("en", "one\x1ftwo é ü " * 15),
            ("de", "only once")] + [("fr", "le mot juste")] * 11
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("n", F.lit("c")).withColumn("word", F.lit(2))
    res = co.collocations(df)
    assert got(res) == by_hand(rows) and res.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert co.collocations(df.limit(0)).count() == 0


def test_working_arrays_stay_short():
    """A kernel's arrays do not grow with the block: but for the states, a few megabytes over any number of tokens."""
    rng = np.random.default_rng(3)
    rows = np.unique(rng.integers(1, 400, (20_000, 2)), axis=0).astype(np.int32)
    ids = rng.integers(0, 400, 2 << 20).astype(np.int32)
    trie = co.Trie(rows).arrays()
    whole = co._advance(trie, ids, 2)
    tracemalloc.start()
    state = co.advance(trie, ids, 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (state == whole).all() and most < state.nbytes + (16 << 20)
    ends = state[state < len(trie[3]) - 1]
    assert (trie[3][trie[5]] == np.arange(len(rows))).all() and (rows[trie[3][ends]][:, 0] == ids[np.flatnonzero(state < len(trie[3]) - 1)]).all()
    assert max(map(len, co._pieces(ids))) == co.PLACES and len(co._pieces(ids[:0])) == 1


def test_candidates_are_frequent(spark, texts):
    """However coarse the buckets, only phrases that occur often enough become candidates, so tries grow with those alone."""
    df = spark.createDataFrame(texts, "lang string, text string").repartition(4)
    _, coded, _ = co._encode(df, "text", F.coalesce("lang", F.lit("und")), 10, 300)
    n = Counter()
    for r in coded.collect():
        ids = co.unpack(r["ids"], np.int32).tolist()
        n.update((a, b) for a, b in zip(ids, ids[1:]) if a and b)
    want = {p for p, f in n.items() if f >= 10}
    got_ = [tuple(r) for r in co.candidates(coded, 2, [co.pair_sites], 10_000, 10, 4).collect()]
    assert len(want) < len(n) and len(got_) == len(want) and set(got_) == want


@pytest.mark.parametrize("top", [900, 1 << 30])
def test_counted(top):
    rng = np.random.default_rng(5)
    words = [rng.integers(1, 30, 5000).astype(np.int32) * (top // 30) for _ in range(3)]
    found, n = co._counted(words)
    want = Counter(zip(*[w.tolist() for w in words]))
    assert list(zip(*[w.tolist() for w in found])) == sorted(want) and n.tolist() == [want[p] for p in sorted(want)]
    again, twice = co._counted([np.concatenate([w, w]) for w in found], np.concatenate([n, n]))
    assert all((a == b).all() for a, b in zip(again, found)) and (twice == 2 * n).all()
    assert [len(x) for x in (*co._counted([w[:0] for w in words])[0], co._counted([w[:0] for w in words], n[:0])[1])] == [0] * 4


def test_waves_start_at_their_own_words():
    """A wave's trie is entered only where a phrase of the wave can start: all waves together count a text as one does."""
    rng = np.random.default_rng(6)
    ids = rng.integers(0, 300, 50_000).astype(np.int32)
    rows = np.unique(rng.integers(1, 300, (20_000, 2)), axis=0).astype(np.int32)
    whole = co.advance(co.Trie(rows).arrays(), ids, 2)
    started, found = 0, []
    for part in np.array_split(rows, 8):
        at = co.in_range(ids, int(part[0, 0]), int(part[-1, 0]))
        started += sum(map(len, at))
        found += [p for piece in at for p in co.reach(co.Trie(part).arrays(), ids, 2, piece)[0].tolist()]
    assert sorted(found) == np.flatnonzero(whole < whole.max()).tolist() and started < 1.1 * len(ids)


@pytest.mark.parametrize("cap, own", [(10, 1), (15, 1), (200, 0)])
def test_counts_are_capped(cap, own):
    rng = np.random.default_rng(7)
    seen, n = np.zeros(64 >> own, np.uint8), np.zeros(64, np.int64)
    for size in (0, 5, 60, 300, 4000):
        h = np.minimum(rng.zipf(1.4, size) - 1, 63)
        co.add_capped(seen, h, cap, own)
        n += np.bincount(h, minlength=64)
        counts = np.stack([seen & 15, seen >> 4], axis=1).ravel() if own else seen
        assert counts.tolist() == np.minimum(n, cap).tolist()
