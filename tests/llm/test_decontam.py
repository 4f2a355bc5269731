"""Spaced-seed decontamination against an all-diagonals comparison, and the seeds' own guarantee."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.llm import decontam

from ..conftest import SF_SMALL


def test_seeds_meet_every_overlap():
    for k in range(4):
        for gone in itertools.combinations(range(13), k):
            assert any(all(i + o not in gone for o in s) for s in decontam.SEEDS for i in range(13 - s[-1])), gone


def tokens(t):
    return [w for p in decontam.token_pieces((t or "").encode()) for w in p]


def by_rule(docs, items):
    """The stated rule itself: any stretch of 13 tokens (the whole item where that is shorter) with 80 % of them equal."""
    out = set()
    for d, t in docs:
        a = tokens(t)
        for i, u in items:
            b = tokens(u)
            best = None
            for shift in range(-len(b) + 1, len(a)):
                lo, hi = max(0, -shift), min(len(b), len(a) - shift)
                total = [0, *itertools.accumulate(a[k + shift] == b[k] for k in range(lo, hi))]
                if total[-1] < 5:
                    continue
                for s, e in itertools.combinations(range(len(total)), 2):
                    eq = total[e] - total[s]
                    if e - s >= min(13, len(b)) and eq >= 5 and 10 * eq >= 8 * (e - s):
                        new = (s - e, -eq, lo + s + shift, lo + s)
                        best = min(best, new) if best else new
            if best:
                out.add((str(d), str(i), best[2], best[3], -best[0], -best[1], len(b)))
    return sorted(out)


def got(df):
    return sorted((str(r[0]), str(r[1]), *r[2:]) for r in df.collect())


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(5)
    vocab = np.array(["the", "of", "and", *[f"w{i}" for i in range(60)]])
    p = np.array([.15, .1, .1, *[.65 / 60] * 60])
    say = lambda n: list(rng.choice(vocab, n, p=p))
    items = [(i, " ".join(say(int(rng.integers(5, 40))))) for i in range(12)] + [(90, None), (91, ""), (92, "too few"), (3, "a b c d e f")]
    docs = []
    for d in range(40):
        body = say(int(rng.integers(0, 80)))
        if d % 2:
            part = (items[d % 12][1]).split()
            lo = int(rng.integers(0, max(1, len(part) - 14)))
            part = part[lo:lo + int(rng.integers(8, 30))]
            for k in rng.choice(len(part), len(part) // 7, replace=False):
                part[k] = "sub"
            body[len(body) // 2:len(body) // 2] = part
        docs.append((d, ", ".join(body).title()))
    return docs, items


def test_planted_overlaps(spark, planted):
    docs, items = planted
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    want = by_rule(docs, items)
    assert len(want) > 8
    assert got(decontam.find_overlaps(d, i)) == want
    assert got(decontam.find_overlaps(d, i, block_bytes=300, tokens_at_once=37)) == want
    assert {r.doc_id for r in decontam.clean(d, i).collect()} == {x for x, _ in docs} - {int(w[0]) for w in want}


def test_driver_tables(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("n_chars < 1200")
    i = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    have = [(r.item_id, " ".join(map(bytes.decode, tokens(r.text)))) for r in i.collect()]
    whole = {r.doc_id for r in d.collect() if any(f" {t} " in " " + " ".join(map(bytes.decode, tokens(r.text))) + " " for _, t in have)}
    found = {r.doc_id for r in decontam.find_overlaps(d, i).collect()}
    assert whole <= found and len(found) < 0.3 * d.count()


def test_odd_rows(spark):
    items = [(1, "one two three four five six"), (1, "one two three four five six"), (None, "é è ß ü ö ä")]
    docs = [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (None, "x É É è ß ü ö ä"),
            (5, "pad " * 300_000 + "One, two; three four five six!")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("id", F.lit("c"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("item", F.lit("c"))
    res = got(decontam.find_overlaps(d, i))
    # É stays upper-case: 5 of the 6 tokens of the item without id are equal, enough for it
    assert [r[:2] for r in res] == [("3", "1")] * 4 + [("5", "1")] * 2 + [("None", "None")]
    assert res[5][2] == 300_000 and res[6][2:] == (2, 0, 6, 5, 6)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_overlaps(d, empty).count() == 0 and decontam.clean(d, empty).count() == len(docs)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert decontam.find_overlaps(none, i).count() == 0 and decontam.clean(d, i).columns == d.columns


def test_substituted_items(spark):
    """Whole items with substituted tokens, as many as 80 % equal allows, and one more."""
    rng = np.random.default_rng(1)
    sizes = (5, 6, 7, 9, 12, 13, 15, 20, 25, 40)
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in sizes]
    docs, tainted = [], set()
    for n in sizes:
        for gone in [(), (1,), (3,), *({2: [(0, 1)], 3: [(3, 6, 12)]}.get(n // 5, [])), *((3, 6, 17), (2, 7, 12, 17))[:2 * (n == 20)],
                     *(tuple(rng.choice(n, n // 5 + extra, replace=False).tolist()) for extra in (0, 0, 0, 1))]:
            body = items[sizes.index(n)][1].split()
            for k in gone:
                body[k] = "sub"
            docs.append((len(docs), "before it " + " ".join(body) + " behind it"))
            if n - len(gone) >= max(5, .8 * n):
                tainted.add(docs[-1][0])
    d = spark.createDataFrame(docs, "doc_id long, text string")
    want = by_rule(docs, items)
    assert tainted <= {int(w[0]) for w in want}
    assert got(decontam.find_overlaps(d, spark.createDataFrame(items, "item_id long, text string"))) == want


def test_short_seeds_meet_short_items():
    for n in range(5, 13):
        seeds = decontam.SEEDS + (decontam.SHORT_SEEDS if n in (6, 7) else ())
        for k in range(n - 4):
            for gone in itertools.combinations(range(n), k):
                assert 5 * (n - k) < 4 * n or any(all(i + o not in gone for o in s) for s in seeds for i in range(n - s[-1])), (n, gone)


def test_repeated_tokens(spark):
    """Few tokens, often repeated, in texts and items: as the rule says, and at a cost that does not grow with the pairs of places."""
    items = [(1, "na " * 40), (2, "x y " + "na " * 30 + "z"), (3, "a b " * 25), (4, "na na na na na q"), (5, "a b c d e " + "a b " * 9)]
    docs = [(1, "na " * 70), (2, "a b " * 40 + "c"), (3, "b a " * 20 + "x " + "na " * 20), (4, "na " * 12 + "x y " + "na " * 25), (5, "na na na na q " * 9)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = by_rule(docs, items)
    assert len(want) > 10 and got(decontam.find_overlaps(d, i)) == want and got(decontam.find_overlaps(d, i, tokens_at_once=23)) == want
    long = [(1, "na " * 10_000_000), (2, "a b " * 500_000 + "x y" + " na" * 40)]
    res = got(decontam.find_overlaps(spark.createDataFrame(long, "doc_id long, text string"), i))
    assert ("1", "1", 0, 0, 40, 40, 40) in res and ("2", "3", 0, 0, 50, 50, 50) in res and ("2", "2", 1_000_000, 0, 33, 32, 33) in res


def test_many_equal_items_are_spread(spark):
    items = [(k, "one two three four five six seven") for k in range(60)]
    d = spark.createDataFrame([(1, "zero one two three four five six seven eight")], "doc_id long, text string")
    res = got(decontam.find_overlaps(d, spark.createDataFrame(items, "item_id long, text string"), block_bytes=500))
    assert sorted(int(r[1]) for r in res) == list(range(60))
