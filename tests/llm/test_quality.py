"""Quality rules against brute force: every window and every pair of suffixes of a document."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import quality

from ..conftest import SF_SMALL


def by_hand(text, m=5):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    where = {}
    for i in range(len(w) - m + 1):
        where.setdefault(tuple(w[i:i + m]), []).append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(m)}
    longest = 0
    for at in where.values():
        for x, i in enumerate(at):
            for j in at[x + 1:]:
                n = 0
                while j + n < len(w) and w[i + n] == w[j + n]:
                    n += 1
                longest = max(longest, n)
    chars = sum(map(len, w))
    rep = sum(len(w[i]) for i in covered)
    base = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), chars, len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), base, rep, longest,
            not base and rep <= 0.2 * chars and longest <= 100)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = sorted((r.doc_id, *by_hand(r.text)) for r in docs.collect())
    assert sorted(tuple(r) for r in quality.assess(docs).collect()) == want
    kept = {r.doc_id for r in quality.passing(docs).collect()}
    assert kept == {r[0] for r in want if r[-1]} and quality.passing(docs).columns == docs.columns


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    clean = " ".join(f"w{i}" for i in range(3000))
    part = " ".join(f"p{i}" for i in range(150))
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, clean), (5, f"{clean} {part} x {part}"), (6, "la " * 150), (None, clean),
            (7, "é ß # | \x1f" * 9), (8, "one two\n\n \none two\none two "), (9, " ".join(rng.choice(list("ab"), 400))),
            (10, "x" * 3_000_000 + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(1))
    got = sorted((str(r[0]), *r[1:]) for r in quality.assess(docs).collect())
    assert got == sorted((str(d), *by_hand(t)) for d, t in rows)
    out = quality.passing(docs)
    assert {r.doc_id for r in out.collect()} == {4, None} and out.columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality.assess(docs).count() == 0 and quality.passing(docs).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_over_many_documents(seed):
    rng = np.random.default_rng(seed)
    texts = [" ".join(rng.choice(list("abc"), int(rng.integers(0, 60)), p=[.7, .2, .1])).encode() for _ in range(40)]
    for at_once in (50, 10_000):
        m = quality.measure(texts, words_at_once=at_once)
        for i, t in enumerate(texts):
            n, chars, _, _, cov, _, rep, longest, _ = by_hand(t.decode())
            assert (m["n_words"][i], m["word_chars"][i], m["n_repeat_words"][i], m["repeat_chars"][i], m["longest_repeat"][i]) == (n, chars, cov, rep, longest)
