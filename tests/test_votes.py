"""Voting (B8-B12): tie rules, the AND/OR identity of the golden prediction files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.operators import ensemble as ens
from scorekit.operators.order import bucket_rows


def test_two_two_tie_goes_to_first_listed(spark):
    wide = spark.createDataFrame([(1, 1, 0, 0, 1), (2, 0, 1, 1, 0)], "id long, a int, b int, c int, d int")
    lv = ens.long_votes(wide, "id", ["a", "b", "c", "d"])
    got = {r["id"]: r["label"] for r in ens.majority_vote(lv).collect()}
    assert got == {1: 1, 2: 0}
    lv2 = ens.long_votes(wide, "id", ["b", "a", "c", "d"])
    got2 = {r["id"]: r["label"] for r in ens.majority_vote(lv2).collect()}
    assert got2 == {1: 0, 2: 1}


def test_and_or_identity(spark):
    rows = [(i, (i * 7) % 3 == 0, (i * 5) % 4 == 0) for i in range(500)]
    df = spark.createDataFrame([(i, int(a), int(b)) for i, a, b in rows], "id long, a int, b int")
    a = df.select("id", "a")
    b = df.select("id", "b")
    and_ = ens.agree_or(a, b, "id", "a", "b", 0).agg(F.sum("label")).first()[0]
    or_ = ens.agree_or(a, b, "id", "a", "b", 1).agg(F.sum("label")).first()[0]
    pa = df.agg(F.sum("a")).first()[0]
    pb = df.agg(F.sum("b")).first()[0]
    assert pa + pb - and_ == or_
    assert and_ <= min(pa, pb) and or_ >= max(pa, pb)


def test_vote_summary_counts(spark):
    wide = spark.createDataFrame([(1, 1, 1, 1), (2, 1, 0, 1), (3, 0, 0, 0)], "id long, a int, b int, c int")
    s = ens.vote_summary(ens.long_votes(wide, "id", ["a", "b", "c"])).first()
    assert (s["n"], s["unanimous"], s["disagreements"], s["positives"]) == (3, 2, 1, 2)


def _auc(pairs):
    pos, neg = [p for p, y in pairs if y], [p for p, y in pairs if not y]
    key = lambda p: float("inf") if p != p else p  # noqa: E731  NaN is the largest score
    return sum((key(p) > key(n)) + 0.5 * (key(p) == key(n)) for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("at_once, rows", [(1 << 28, 2_000_000), (900, 40)])
def test_weight_search_in_ranges_and_waves(spark, monkeypatch, at_once, rows):
    """Packed blocks dealt to value ranges, candidates in waves: the AUC of every candidate by hand, whatever the sizes."""
    rng = np.random.default_rng(5)
    data = [(int(rng.integers(2)), float(rng.integers(9)) / 8, float(rng.random()), float(rng.integers(2))) for _ in range(300)]
    data += [(1, None, 0.5, 0.5), (None, 0.5, 0.5, 0.5), (0, float("nan"), 0.1, 0.0), (1, float("nan"), 0.2, 0.0), (1, -0.0, 0.0, 0.0), *data[:40]]
    monkeypatch.setattr(ens, "_SCORES_AT_ONCE", at_once)
    df = spark.createDataFrame(data, "y int, a double, `b c` double, d double")
    with bucket_rows(rows):
        got = ens.search_weights(df, "y", ["a", "b c", "d"], step=0.25).collect()
    want = {r["cand"]: _auc([(r["w"][0] * a + r["w"][1] * b + r["w"][2] * d, y) for y, a, b, d in data if None not in (y, a, b, d)]) for r in got}
    assert len(got) == 15 and all(abs(r["auc"] - want[r["cand"]]) < 1e-12 for r in got)
    assert [(-r["auc"], r["cand"]) for r in got] == sorted((-r["auc"], r["cand"]) for r in got)


def test_weight_search_of_one_class_and_of_nothing(spark):
    df = spark.createDataFrame([(1, 0.5, 0.25), (1, 0.25, 0.5)], "y int, a double, b double")
    assert [r["auc"] for r in ens.search_weights(df, "y", ["a", "b"], step=0.5).collect()] == [None] * 3
    assert ens.search_weights(df.limit(0), "y", ["a", "b"], step=0.5).count() == 0


def test_weight_search_moves_packed_scores(spark, monkeypatch):
    """A row for each candidate, range and task is dealt, not one for each candidate and score."""
    seen = []
    real = ens._range_sums
    monkeypatch.setattr(ens, "_range_sums", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    df = spark.range(4000).selectExpr("cast(id % 3 = 0 as int) as y", "(id * 37 % 4001) / 4001.0D as a", "(id * 91 % 3989) / 3989.0D as b")
    ens.search_weights(df, "y", ["a", "b"], step=0.1)
    assert [s.count() for s in seen] == [11]
