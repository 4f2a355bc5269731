"""Nulls, odd ids, many groups and large counts: nothing is lost, nothing overflows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.operators import cardio as cd
from scorekit.operators import crossfit as cf
from scorekit.operators import ensemble as ens
from scorekit.operators import features as fe
from scorekit.operators import metrics as met
from scorekit.operators import models as mdl
from scorekit.operators import order
from scorekit.operators import profile as pr
from scorekit.operators.formulas import Prefer, WeightedSum, clipped, derive, holds, last_true
from scorekit.plans.q_contracts import FixedScorer

COLS = ["a", "b"]


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(1)
    rows = [(i, None if i % 5 == 0 else float(rng.normal(i % 3 * 10)), float("nan") if i % 7 == 0 else float(rng.normal())) for i in range(300)]
    return spark.createDataFrame(rows, "id long, a double, b double").cache()


def test_every_row_is_scored(gappy):
    n = gappy.count()
    km = fe.ClusterLabel(COLS, 3).fit(gappy).transform(gappy)
    assert km.count() == n and km.where("kmeans_3 is null").count() == 0 and set(km.columns) == {*gappy.columns, "kmeans_3"}
    cl = fe.ClusterDistances(COLS, 3)
    assert cl.transform(gappy, cl.fit(gappy)).where("cluster is not null and dist_c2 is not null").count() == n
    for op, out in ((fe.CenteredPCA(COLS, 2), "pca_1"), (fe.IndependentComponents(COLS, 2, max_iter=20), "ica_1")):
        s = op.transform(gappy, op.fit(gappy))
        assert s.where(F.col(out).isNotNull() & ~F.isnan(out)).count() == n


def test_a_gap_without_fill_has_no_cluster(gappy):
    out = fe.centroid_distances(gappy, [[0.0, 0.0], [10.0, 0.0]], COLS)
    assert out.where("a is null and cluster is not null").count() == 0
    assert out.where("a is not null and not isnan(b) and cluster is null").count() == 0


def test_adversarial_weights_keep_ids_with_colons(spark):
    df = spark.createDataFrame([(f"a:{i}:x", float(i % 9)) for i in range(60)], "id string, ap_lo double")
    w, _ = cf.adversarial_weights(df.where("ap_lo < 6"), df.where("ap_lo >= 6"), lambda: FixedScorer("origin"), "id", ["ap_lo"], k=2)
    want = {r.id for r in df.where("ap_lo < 6").collect()}
    assert {r.id for r in w.collect()} == want and w.count() == len(want)


def test_categories_of_any_number_are_encoded(spark):
    rows = [(i, f"c{i % 100}", None if i % 11 == 0 else float(i % 10), int(i % 100 < 50)) for i in range(1200)] + [(5000, None, 1.0, 0)]
    df = spark.createDataFrame(rows, "id long, c string, x double, label int")
    m = mdl.CategoricalBoosting(["c"], ["x"], max_iter=3, max_depth=2).fit(df)
    new = df.union(spark.createDataFrame([(6000, "unseen", None, 0)], df.schema))
    out = cf.positive_prob(m.transform(new))
    assert out.count() == 1202
    assert met.auc_exact(out, "label", "prob").first()["auc"] > 0.95


def test_large_counts_do_not_overflow(spark, monkeypatch):
    big = spark.createDataFrame([(0.1, 0, 5 * 10 ** 10), (0.4, 6 * 10 ** 10, 10 ** 10), (0.9, 4 * 10 ** 10, 0)], "score double, pos long, neg long")
    monkeypatch.setattr(met, "score_counts", lambda *a, **k: big)
    r = met.auc_exact(big, "y", "p").first()
    assert r["auc"] == pytest.approx((4 * 6 + 6 * (5 + 0.5)) / (10 * 6)) and r["positives"] == 10 ** 11


@pytest.mark.parametrize("groups", [3, 400])
def test_cuts_of_many_groups(spark, groups):
    rng = np.random.default_rng(groups)
    rows = [(int(g), float(rng.normal(g * 1000, 1 + g % 5)), int(rng.integers(0, 4))) for g in rng.integers(0, groups, 6000)] + [(None, 5.0, 1), (None, 6.0, 2)]
    df = spark.createDataFrame(rows, "g int, x double, n int").groupBy("g", "x").agg(F.sum("n").alias("n"))
    plain = {(r.g, r.x): r.cum_n for r in order.prefix_sum(df, "x", ["n"], ["g"], rows_per_bucket=10 ** 6).collect()}
    cut = order.prefix_sum(df, "x", ["n"], ["g"], rows_per_bucket=4)
    assert {(r.g, r.x): r.cum_n for r in cut.collect()} == plain
    bucketed, most = order.add_group_value_bucket(df, "x", "_b", ["g"], 4)
    assert most > 1 and bucketed.groupBy("g", "_b").count().agg(F.max("count")).first()[0] <= 40


def test_bisection(spark):
    cuts = [0.0, 1.0, 2.5, 7.0, 7.5]
    keys = [-1.0, 0.0, 0.5, 1.0, 2.4, 2.5, 7.2, 7.5, 99.0, None]
    df = spark.createDataFrame([(k, cuts) for k in keys] + [(3.0, None)], "k double, cuts array<double>")
    got = [r.b for r in df.select(order._bisect(F.col("cuts"), F.col("k"), 6).alias("b")).collect()]
    assert got == [0, 1, 1, 2, 2, 3, 4, 5, 5, 5, 0]


def test_wide_statistics_match_narrow(spark):
    rng = np.random.default_rng(2)
    names = [f"c{i}" for i in range(20)]
    x = rng.normal(size=(400, 20)).round(1)
    df = spark.createDataFrame([tuple(None if rng.random() < .1 else float(v) for v in row) for row in x], ", ".join(f"{c} double" for c in names))
    wide = {r.feature: tuple(r) for r in pr.moments(df, names).collect()}
    narrow = {r.feature: tuple(r) for c in names for r in pr.moments(df, [c]).collect()}
    assert wide.keys() == narrow.keys()
    for c in names:
        assert wide[c][1:] == pytest.approx(narrow[c][1:])
    pdf = df.toPandas()
    corr = pdf.corr()
    got = pr.corr_pairs(df, names, -1.0).collect()
    assert len(got) == 190 and all(r["corr"] == pytest.approx(corr.loc[r.feature_a, r.feature_b]) for r in got)


def test_formula_packs(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, 3.0, 4.0)], "id int, a double, b double")
    pack = {"s": "{@a} + {@b}", "twice": "2 * {s}", "gone": "{absent} + 1", "built_on_gone": "{gone} + {a}", "a": "{a} * 0.5",
            "flag": holds("{@b} > 3"), "sum": WeightedSum(((2, "{@a}"), (1, "{absent}"), (3, "{flag}"))), "stage": last_true([("{@a} > 2", 1), ("{@a} > 5", 2)]),
            "b2": clipped("{@b}", 0, 3), "b": Prefer("7", 0.0), "c": Prefer("{absent}", 1, 5, "int", ("{@b}", "9"))}
    out = derive(df, pack, keep=["id"])
    assert out.columns == ["id", "s", "twice", "a", "flag", "sum", "stage", "b2", "b", "c"]
    assert [tuple(r) for r in out.collect()] == [(1, None, None, 5.0, 0, 20.0, 2, None, 0.0, 5), (2, 7.0, 14.0, 1.5, 1, 9.0, 1, 3.0, 4.0, 4)]
    with pytest.raises(ValueError):
        derive(df, {"x": "{y}", "y": "{x}"})


def test_median_fill_reaches_nulls_of_another_frame(spark):
    train = spark.createDataFrame([(1.0, 2.0), (3.0, None), (5.0, 8.0)], "x double, y double")
    fill = cd.MedianFill(["x", "y"]).fit(train)
    out = fill.transform(spark.createDataFrame([(None, None, 1)], "x double, y double, z int")).first()
    assert tuple(out) == (3.0, 5.0, 1)


def test_first_listed_model_wins_a_tie(spark):
    auc = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.5)], "model string, auc double")
    assert mdl.pick_best(auc, ["c", "b", "a"]) == "b" and mdl.pick_best(auc) == "a"


def test_patterns_without_a_global_sort(spark):
    rows = [(i, f"m{j}", j, (i >> j) & 1) for i in range(32) for j in range(5)]
    lv = spark.createDataFrame(rows, "id int, model string, ordinal int, label int")
    out = ens.vote_patterns(lv, top=3)
    assert out.count() == 3 and {r.distinct_patterns for r in out.collect()} == {30}
