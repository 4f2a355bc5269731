"""Entropy balancing against hand-computed targets and a scalar solution of the dual."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import mixing

from ..conftest import SF_SMALL


def n_words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets_by_hand(rows):
    words = defaultdict(int)
    for _, t, s in rows:
        words[s] += n_words(t)
    order = sorted((s for s in words if s is not None), key=lambda s: s.encode()) + [None] * (None in words)
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, full = sum(words.values()), set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(3 * words[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] >= 3 * words[s]}
        if not above or above == set(free):
            return {s: 3 * words[s] if s in full | above else share[s] for s in order}, words
        full |= above


def rates_by_hand(rows, target, words):
    out = {}
    for s in words:
        size = np.array([n_words(t) for _, t, x in rows if x == s], float)
        size = size[size > 0]
        if not len(size) or target[s] <= 0:
            continue
        m = words[s] / len(size)
        take = lambda lam: float((size * np.minimum(3, np.exp(lam * size / (size + m)))).sum())  # noqa: E731,B023
        if target[s] >= 3 * words[s] * (1 - 1e-9):
            out[s] = (None, m)
            continue
        lo, hi = -1e4, 1e4
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if take(min(mid, 700)) > target[s] else (mid, hi)
        out[s] = (lo, m)
    return out


def check(res, rows, near):
    target, words = targets_by_hand(rows)
    rate = rates_by_hand(rows, target, words)
    src = {d: s for d, _, s in rows}
    taken = defaultdict(int)
    assert sorted(str(r.doc_id) for r in res) == sorted(str(d) for d, _, _ in rows)
    for r in res:
        s = src[r.doc_id]
        assert r.source_size == words[s] and r.target == pytest.approx(target[s], rel=1e-9, abs=1e-9)
        assert r.taken == r.size * r.copies and 0 <= r.taken <= 3 * r.size
        if r.size and s in rate:
            lam, m = rate[s]
            want = 3 if lam is None else min(3, math.exp(min(50, lam * r.size / (r.size + m))))
            assert r.rate == pytest.approx(want, rel=1e-5)
            assert math.floor(r.rate + 1e-9) - 1 <= r.copies <= math.ceil(r.rate - 1e-9) + 1
        taken[s] += r.taken
    for s, n in words.items():
        assert abs(taken[s] - target[s]) <= near * n, (s, taken[s], target[s], n)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    res = mixing.report(docs).collect()
    check(res, rows, 0.03)
    again = mixing.report(docs.repartition(5)).collect()
    assert sorted(map(tuple, res)) == sorted(map(tuple, again))
    mix = mixing.mixed(docs)
    assert sorted((r.doc_id, r.mix_copies) for r in mix.collect()) == sorted((r.doc_id, r.copies) for r in res if r.copies)
    assert mix.columns[:len(docs.columns)] == docs.columns


def test_capped_and_hot_sources(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k, (s, n) in enumerate([("a", 900), ("b", 30), ("B", 5), ("é", 60), (None, 200), ("zz", 2)]):
        rows += [(1000 * k + i, "w " * int(rng.integers(0, 300)), s) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(mixing.report(docs, bucket_rows=100).collect(), rows, 0.03)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "x y", "c"), (3, "x y", "c"), (None, "q", None), (5, "w " * 500_000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("c")).withColumn("rank", F.lit(1))
    res = mixing.report(docs).collect()
    assert len(res) == 6 and all(0 <= r.taken <= 3 * r.size for r in res)
    assert {r.target for r in res if r.doc_id in (1, 2)} == {0.0}
    assert mixing.mixed(docs).columns[:5] == docs.columns
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.report(none).count() == 0 and mixing.mixed(none).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.report(blank).collect()] == [0, 0]


def test_round_of_newton_writes_one_file_however_many_partitions(spark, monkeypatch):
    """A round's table has a row for each source; it was written as a file for each shuffle partition."""
    written, write = [], mixing.shared_table

    def noted(df, *more):
        out = write(df, *more)
        if "mult" in out.columns:
            written.append(len(out.inputFiles()))
        return out
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    monkeypatch.setattr(mixing, "shared_table", noted)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        rows = [(k, "w " * (1 + k % 9), f"s{k % 12}") for k in range(300)]
        got = mixing.report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 300 and len(written) > 1 and set(written) == {1}
