"""Dense blocked search against plain scoring by the stated formula."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import search

from ..conftest import SF_SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, items, top=10):
    words = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    words = [(d, c, sum(c.values())) for d, c in words if c]
    big_n, big_l = len(words), sum(n for _, _, n in words)
    df = Counter(w for _, c, _ in words for w in c)
    out = []
    for i, t in items:
        query = Counter(TERM.findall((t or "").translate(LOWER)))
        hits = []
        for d, c, n in words:
            m = 100 - 75 + (75 * n * big_n) // big_l
            s = sum(k * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w, k in query.items() if w in c)
            if s > 0:
                hits.append((-s, d is None, d if d is not None else 0))
        out += [(str(i), r, "None" if no else str(d), -s) for r, (s, no, d) in enumerate(sorted(hits)[:top], 1)]
    return sorted(out)


def got(df):
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    vocab = np.array([f"w{i}" for i in range(40)] + ["Été", "x1", "the"])
    say = lambda n: " ".join(rng.choice(vocab, n, p=np.array([.5 / 42] * 42 + [.5])))
    docs = [(d, say(int(rng.integers(1, 60)))) for d in range(300)]
    docs += [(1000 + k, docs[7][1]) for k in range(30)] + [(5, docs[7][1].upper())] * 2  # ties across the cut and repeated ids
    items = [(i, say(int(rng.integers(1, 20)))) for i in range(25)] + [(77, docs[7][1]), (78, docs[7][1]), (78, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"tile_items": 3, "tile_terms": 7, "cells": 200}, {"block_bytes": 300, "cells": 50}])
def test_same_as_by_hand(spark, corpus, sizes):
    docs, items = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert got(search.search(d, i, **sizes)) == by_hand(docs, items)


def test_driver_tables(spark):
    d, i = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = by_hand([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in i.collect()])
    assert got(search.search(d, i)) == want and len(want) > 100


def test_sums_past_the_exact_range(spark):
    """An item whose weights would pass 2^53 in one product, in one term and over many."""
    items = [(1, "rare " * 2_000_000), (2, " ".join(f"v{k} " * 30_000 for k in range(40)))]
    docs = [(d, "common " * (d + 1)) for d in range(30)] + [(90, "rare v1 v2"), (91, "rare " * 9 + "v3"), (92, " ".join(f"v{k}" for k in range(40)))]
    weights = [search.EXACT // 7 + 3, 5]
    parts = search.make_tiles([Counter({0: 50, 1: 2})], weights, 4, 9)[0][2]
    assert len(parts) == 8 and sum(int(m.sum()) for _, m in parts) == 50 * weights[0] + 2 * 5
    assert all(m.sum(axis=0).max() <= search.EXACT for _, m in parts)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(search.search(d, spark.createDataFrame(items, "item_id long, text string"))) == by_hand(docs, items)


def test_ties_keep_the_smallest_ids():
    s = np.array([[5, 1], [7, 1], [5, 1], [5, 0], [9, 1]])
    d, i, least = search.best_rows(s, np.ones(2, np.int64), 3)
    assert sorted(zip(d.tolist(), i.tolist())) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 1), (4, 0)] and least.tolist() == [5, 1]


def test_long_lengths_stay_exact():
    n = np.array([1, 10**9], np.int64)
    assert search.lengths(n, 10**11, 10**14).tolist() == [25 + 75 * int(x) * 10**11 // 10**14 for x in n]


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (None, "alpha beta"), (4, "alpha beta"), (4, "alpha beta"), (5, "pad, " * 400_000 + "alpha"), (6, "b é")]
    items = [(1, None), (2, ""), (3, "?!"), (None, "Alpha"), (4, "alpha alpha beta"), (4, "alpha alpha beta"), (5, "É é"), (6, "nothing")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("score", F.lit("c")).withColumn("n", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("uid", F.lit("c"))
    res = search.search(d, i)
    assert got(res) == by_hand(docs, items) and res.columns == ["item_id", "rank", "doc_id", "score"]
    no_docs, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert search.search(no_docs, i).count() == 0 and search.search(d, no_items).count() == 0
    names = spark.createDataFrame([("b", "alpha"), ("a", "alpha")], "doc_id string, text string")
    assert [(r.rank, r.doc_id) for r in search.search(names, i.where("item_id is null")).orderBy("rank").collect()] == [(1, "a"), (2, "b")]
