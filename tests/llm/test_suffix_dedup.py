"""Suffix-array dedup against brute force over every window of every document."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import suffix_dedup

from ..conftest import SF_SMALL


def by_hand(rows, length):
    """(id, n_bytes, n_removed, n_spans, sha) of (id, text) rows; ids are distinct or rows equal."""
    seen, out = set(), {}
    order = sorted({(d is None, d or 0, hashlib.sha256((t or "").encode()).digest()[:8] and
                     int.from_bytes(hashlib.sha256((t or "").encode()).digest()[:8], "big", signed=True), t or "") for d, t in rows})
    for none, d, _, t in order:
        b = t.encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        left = bytes(x for x, g in zip(b, gone) if not g)
        out[None if none else d, t] = (len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest())
    return sorted((str(d), *out[d, t or ""]) for d, t in rows)


def got(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_covers_hold_every_difference():
    for v, cover in suffix_dedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 20])
def test_documents(spark, block_bytes):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    df = suffix_dedup.removal_report(docs, block_bytes=block_bytes, per_range=5_000)
    assert got(df) == by_hand([(r.doc_id, r.text) for r in docs.collect()], 100)


@pytest.mark.parametrize("length", [2, 5, 9, 40])
def test_low_entropy_texts(spark, length):
    rng = np.random.default_rng(length)
    rows = [(i, "".join(rng.choice(list("abé"), int(rng.integers(0, 90)), p=[.6, .3, .1]))) for i in range(60)]
    rows += [(100 + i, "a" * (10 * i)) for i in range(12)]
    df = suffix_dedup.removal_report(spark.createDataFrame(rows, "doc_id long, text string"), length=length, block_bytes=300, per_range=100)
    assert got(df) == by_hand(rows, length)


def test_odd_rows(spark):
    long = "".join(np.random.default_rng(1).choice(list("abcdefgh "), 300_000))
    rows = [(3, None), (4, ""), (5, "x" * 250), (5, "x" * 250), (6, "short"), (6, "short"), (2, "y" * 99), (None, "x" * 150), (None, None),
            (9, long), (8, long[1000:200_000]), (7, long), (10, "é" * 120), (11, "é" * 120 + "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sha", F.lit("c")).withColumn("block", F.lit(1)).withColumn("id", F.lit(2))
    assert got(suffix_dedup.removal_report(docs)) == by_hand(rows, 100)
    kept = {(r.doc_id, r.text) for r in suffix_dedup.remove_repeats(docs).collect()}
    ids = {d for d, _ in kept}
    assert (7, long) in kept and not ids & {8, 9} and ids >= {2, 3, 4, 5, 6, 10}  # 8 and 9 lie in 7
    assert (11, "z") in kept
    assert suffix_dedup.remove_repeats(docs).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.removal_report(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0
