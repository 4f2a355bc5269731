"""Properties of learned operators that have no exact oracle."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.operators import crossfit as cf
from scorekit.operators import features as fe
from scorekit.operators import models as mdl
from scorekit.plans import frames as fr

from .conftest import SF_SMALL

COLS = ["ap_hi", "ap_lo", "weight", "height"]


@pytest.fixture(scope="module")
def cardio(spark):
    return fr.cardio(spark, SF_SMALL).cache()


def test_kmeans_labels_in_range(cardio):
    m = fe.ClusterLabel(COLS, 4, scale=True).fit(cardio)
    labs = {r[0] for r in fe.ClusterLabel.transform(m, cardio).select("kmeans_4").distinct().collect()}
    assert labs <= {0, 1, 2, 3} and len(labs) > 1


def test_pca_scores_decorrelated(cardio):
    p = fe.CenteredPCA(COLS, 2)
    out = p.transform(cardio, p.fit(cardio)).select("pca_0", "pca_1").toPandas()
    assert abs(np.corrcoef(out["pca_0"], out["pca_1"])[0, 1]) < 1e-6
    assert out["pca_0"].var() >= out["pca_1"].var()
    assert abs(out["pca_0"].mean()) < 1e-6


def test_ica_components_white(cardio):
    ica = fe.IndependentComponents(COLS, 2, max_iter=100)
    out = ica.transform(cardio, ica.fit(cardio)).select("ica_0", "ica_1").toPandas()
    assert abs(np.corrcoef(out["ica_0"], out["ica_1"])[0, 1]) < 1e-3
    assert out["ica_0"].var(ddof=0) == pytest.approx(1.0, abs=1e-3)


def test_isotonic_is_monotone(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.random(), 0) for i in range(300)]
    rows = [(i, p, int(rnd.random() < p)) for i, p, _ in rows]
    df = spark.createDataFrame(rows, "id long, prob double, label int")
    model = mdl.calibrate_isotonic(df)
    out = mdl.apply_calibration(model, df).orderBy("prob").select("calibrated").toPandas()["calibrated"].to_numpy()
    assert np.all(np.diff(out) >= -1e-12)
    assert out.min() >= 0 and out.max() <= 1


def isotonic_by_hand(points):
    """(score, label) pairs: pooled scores, then adjacent violators."""
    pooled = {}
    for x, y in points:
        s, n = pooled.get(x, (0.0, 0))
        pooled[x] = (s + y, n + 1)
    blocks = []
    for x in sorted(pooled):
        s, n = pooled[x]
        blocks.append([s, n, [x]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, xs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + xs]
    return {x: s / n for s, n, xs in blocks for x in xs}


@pytest.mark.parametrize("kind", ["rising", "falling", "sawtooth", "noise"])
def test_isotonic_of_many_buckets(spark, kind):
    rnd = random.Random(8)
    value = {"rising": lambda k: k, "falling": lambda k: -k, "sawtooth": lambda k: k % 13, "noise": lambda k: rnd.random() < k / 200}[kind]
    points = [(k / 7, float(value(k))) for k in range(200)] + [(3 / 7, 1.0)] * 5
    df = spark.createDataFrame([*points, (None, 1.0), (float("nan"), 1.0), (2.0, None)], "prob double, label double")
    want = isotonic_by_hand(points)
    for rows in (9, 40, 10_000):
        model = mdl.calibrate_isotonic(df, rows_per_bucket=rows)
        got = {r.prob: r.calibrated for r in mdl.apply_calibration(model, df.where("prob < 1e6"), rows_per_bucket=rows).collect()}
        assert {x: got[x] for x in want} == pytest.approx(want), rows
    ask = spark.createDataFrame([(-5.0,), (99.0,), (0.5 / 7,), (None,), (float("nan"),)], "prob double")
    out = [r.calibrated for r in mdl.apply_calibration(model, ask, rows_per_bucket=9).select("prob", "calibrated").collect()]
    by = dict(zip([-5.0, 99.0, 0.5 / 7], sorted([v for v in out if v is not None])))
    assert out.count(None) == 2 and len(by) == 3 and min(want.values()) == pytest.approx(min(v for v in out if v is not None))


def test_isotonic_of_nothing(spark):
    none = spark.createDataFrame([], "prob double, label int")
    model = mdl.calibrate_isotonic(none)
    assert model.n_steps == 0
    got = mdl.apply_calibration(model, spark.createDataFrame([(0.5,)], "prob double")).collect()
    assert got[0].calibrated is None


def test_stacking_probabilities(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.random(), rnd.random()) for i in range(400)]
    base = spark.createDataFrame([(i, a, b, int(a > 0.5)) for i, a, b in rows], "id long, a double, b double, label int")
    df = fe.assemble(cf.stratified_folds(base, "id", "label", 3, seed=2), ["a", "b"])
    oofs = [cf.cross_fit(df, m, "id", "label", "fold", n)[0]
            for n, m in (("tree", mdl.tree(max_depth=3)), ("lr", mdl.logistic(standardization=True)))]
    from functools import reduce
    from pyspark.sql import DataFrame
    _, out, _ = mdl.stack(reduce(DataFrame.unionByName, oofs), None)
    got = out.agg(F.count(F.lit(1)), F.countDistinct("id"), F.min("prob"), F.max("prob")).first()
    assert got[0] == 400 and got[1] == 400 and 0 <= got[2] <= got[3] <= 1


def test_routed_model_scores_every_row(spark):
    s = fr.sentinel(spark, SF_SMALL).withColumnRenamed("y", "label")
    rm = mdl.RoutedModel(fr.SENTINEL_COLS, ["meta"], mdl.tree(max_depth=3), mdl.tree(max_depth=2))
    out = rm.transform(rm.fit(s), s, "id")
    assert out.count() == s.count() and out.select("id").distinct().count() == s.count()
    routes = {r[0] for r in out.select("_route").distinct().collect()}
    assert "all" in routes


def test_routed_model_scores_all_sentinel_rows_it_never_saw(spark):
    s = fr.sentinel(spark, SF_SMALL).withColumnRenamed("y", "label")
    rm = mdl.RoutedModel(fr.SENTINEL_COLS, ["meta"], mdl.tree(max_depth=3), mdl.tree(max_depth=2))
    models = rm.fit(rm._route(s).where("_route <> 'all'").drop("_route"))
    assert models[1] is None
    out = rm.transform(models, s, "id").collect()
    assert sorted(r.id for r in out) == sorted(r.id for r in s.select("id").collect())
    assert any(r._route == "all" for r in out) and all(0 <= r.prob <= 1 for r in out)
