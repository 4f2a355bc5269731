"""Exact dedup: the filters round trip and merge; the result against grouping by hand."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import exact_dedup

from ..conftest import SF_SMALL


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 24, 40, 63])
def test_filter_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 2, 7, 300):
        values = np.unique(rng.integers(0, 1 << bits, n, dtype=np.uint64))
        counts = rng.choice([1, 1, 2, 3, 255, 256, 257, 70_000, 10**12], len(values)).astype(np.int64)
        v, c = exact_dedup.unpack_filter(exact_dedup.pack_filter(values, counts, bits), bits)
        assert np.array_equal(v, values) and np.array_equal(c, counts)


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    draws = [rng.integers(0, 500, 400, dtype=np.uint64) for _ in range(7)]
    parts = [exact_dedup.unpack_filter(exact_dedup.pack_filter(*np.unique(d, return_counts=True), 12), 12) for d in draws]
    v, c = exact_dedup.merge(parts)
    assert dict(zip(v.tolist(), c.tolist())) == Counter(np.concatenate(draws).tolist())


@pytest.mark.parametrize("per_range,per_filter", [(1 << 21, 1 << 21), (20, 1 << 21), (20, 7)])
def test_repeated_fingerprints(spark, per_range, per_filter):
    rng = np.random.default_rng(2)
    fps = [*rng.integers(0, 1 << 20, 600).tolist(), *[77] * 500, 0, 0, (1 << 20) - 1, (1 << 20) - 1]
    marks = spark.createDataFrame([(int(x),) for x in fps], "fp bigint").repartition(6)
    got = sorted(r.fp for r in exact_dedup.repeated(marks, len(fps), 20, per_range, per_filter).collect())
    assert got == sorted(k for k, n in Counter(fps).items() if n > 1)


def by_hand(rows):
    groups = defaultdict(list)
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in rows]
    for d, t in norm:
        groups[t].append(d)
    out, seen = [], set()
    for d, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        kept = d == keep and t not in seen
        if kept:
            seen.add(t)
        out.append((str(d), str(keep), len(groups[t]), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r[0]), str(r[1]), *r[2:]) for r in df.collect())


@pytest.mark.parametrize("extra_bits,max_bytes", [(16, 1 << 26), (0, 1 << 26), (-5, 0), (16, 0)])
def test_driver_tables(spark, extra_bits, max_bytes):
    """Also with fingerprints so short that different texts share them, and with shuffle joins."""
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    rows += [(10_000 + k, rows[k % 3][1].replace(" ", " \t\n")) for k in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(exact_dedup.copies(d, extra_bits=extra_bits, max_bytes=max_bytes)) == by_hand(rows)


def test_odd_rows(spark):
    long = "word \n" * 500_000
    rows = [(1, None), (2, ""), (3, " "), (4, "\t\n"), (None, "a b"), (None, "a  b"), (9, "a b"), (9, "a b "), (8, long), (7, long.replace("\n", "\t")),
            (5, "same"), (5, "same"), (5, "same"), (6, "same"), (None, "same"), (5, "other"), (None, "alone"), (11, "\x1fx"), (12, " x")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    d = d.withColumn("fp", F.lit(1)).withColumn("sha", F.lit("c")).withColumn("uid", F.lit(None).cast("int")).withColumn("key", F.lit(1)).withColumn("row", F.lit(2))
    assert got(exact_dedup.copies(d)) == by_hand(rows)
    kept = exact_dedup.one_of_each(d)
    assert kept.columns == d.columns
    want = [x for x in by_hand(rows) if x[3]]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(x[0] for x in want)
    empty = d.limit(0)
    assert exact_dedup.copies(empty).count() == 0 and exact_dedup.one_of_each(empty).columns == d.columns
    names = spark.createDataFrame([("b", "x"), ("a", "x")], "doc_id string, text string")
    assert got(exact_dedup.copies(names)) == by_hand([("b", "x"), ("a", "x")])
