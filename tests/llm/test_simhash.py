"""SimHash near-dedup against brute force: every fingerprint by hand, all pairs, union-find."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scorekit.llm import simhash

from ..conftest import SF_SMALL


def fp_by_hand(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_by_hand(rows):
    """{row number: component} of (id, fp) rows."""
    fps = sorted({fp for _, fp in rows})
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                up[root(a)] = root(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return sorted((str(d), f"{f:016x}", least.get(root(f))) for d, f in rows)


def got(df):
    return sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in df.collect())


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = components_by_hand([(r.doc_id, fp_by_hand(r.text)) for r in docs.collect()])
    assert got(simhash.near_duplicates(docs, leaf=16)) == want


def test_odd_rows(spark):
    rows = [(5, None), (2, ""), (3, " \t\n"), (None, "a b c d"), (7, "A B c D"), (7, "A B c D"), (9, "x y"), (1, "Ä ä ß" * 50),
            (8, "w " * 300_000 + "end"), (4, "w " * 300_000 + "end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    assert got(simhash.near_duplicates(docs)) == components_by_hand([(d, fp_by_hand(t)) for d, t in rows])


def test_empty_table(spark):
    df = simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert df.columns == ["doc_id", "fingerprint", "component_id"] and df.count() == 0


@pytest.mark.parametrize("leaf", [4, 64, 100_000])
def test_links_keep_every_connection(spark, leaf):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 64, 60, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False)) for b in np.repeat(base, 8)]
    fps = sorted(set(near) | {0, 1, 2 ** 64 - 1, 2 ** 63})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.trie_links(spark.createDataFrame([(f,) for f in signed], "fp long"), leaf=leaf).collect()
    assert all(((u ^ v) & (2 ** 64 - 1)).bit_count() > 0 for u, v in links)
    up = {f: f for f in signed}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for u, v in links:
        up[root(u)] = root(v)
    want = {f: f for f in signed}

    def wroot(x):
        while want[x] != x:
            x = want[x]
        return x
    for i, a in enumerate(signed):
        for b in signed[i + 1:]:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3:
                want[wroot(a)] = wroot(b)
    classes = lambda r: sorted(sorted(f for f in signed if r(f) == x) for x in {r(f) for f in signed})
    assert classes(root) == classes(wroot)


def test_hot_prefix_is_split(spark):
    """Many fingerprints under one long prefix: no subtrie beyond the leaf, no link lost."""
    rng = np.random.default_rng(5)
    hot = (0xABCD1234 << 32) + np.unique(rng.integers(0, 2 ** 12, 900).astype(np.uint64))  # 52 bits in common
    fps = np.unique(np.concatenate([hot, rng.integers(0, 2 ** 64, 300, dtype=np.uint64), [np.uint64(0), np.uint64(2 ** 64 - 1)]]))
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    start, free = simhash.subtries(df, leaf=32)
    assert (np.diff(start.astype(object)) > 0).all() and np.all(start <= fps.max())
    held = np.bincount(np.searchsorted(start, fps, "right") - 1, minlength=len(start))
    assert held.sum() == len(fps) and 0 < held.min() and held.max() <= 32
    assert all(int(f) < int(s) + (1 << int(w)) for f, s, w in
               ((f, start[k], free[k]) for f, k in zip(fps, np.searchsorted(start, fps, "right") - 1)))
    up = np.arange(len(fps))
    at = {int(f): k for k, f in enumerate(fps.view(np.int64))}
    links = simhash.trie_links(df, leaf=32).collect()
    simhash.hook(up, np.array([at[r.u] for r in links]), np.array([at[r.v] for r in links]))
    want = np.arange(len(fps))
    i, j = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3, 1))
    simhash.hook(want, i, j)
    flat = lambda p: [min(k for k in range(len(p)) if p[k] == r) for r in p]
    assert flat(up) == flat(want)


def test_one_row_of_each_component(spark):
    rows = [(5, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (7, None), (8, ""), (None, "lone words of a row"), (None, "lone words of a row"),
            (None, None), (9, "quite another text of some words"), (9, "and a third one with the same id here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("root", F.lit(1))
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, [
        (3, "a b c d e"), (7, None), (None, "lone words of a row"), (9, "quite another text of some words"), (9, "and a third one with the same id here")]))
    assert simhash.one_of_each(docs.limit(0)).count() == 0
