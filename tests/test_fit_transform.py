"""Fitted stages: the same parameters whatever the partitioning and row order, the row count is
never changed by a transform, and scoring frames are never filtered."""

import random

import pytest
from pyspark.sql import functions as F

from scorekit.operators import cardio as cd
from scorekit.operators import clean as cl
from scorekit.operators import features as fe
from scorekit.plans import frames as fr

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def cardio(spark):
    return fr.cardio(spark, SF_SMALL).cache()


@pytest.mark.parametrize("make", [
    lambda: cl.MedianImputer(["weight", "ap_hi"]),
    lambda: cl.Winsorizer(["weight", "ap_hi"]),
    lambda: cl.ZScaler(["weight", "ap_hi"]),
    lambda: cl.IqrScaler(["weight", "ap_hi"]),
])
def test_fit_partition_invariant(cardio, make):
    a = make().fit(cardio.repartition(1)).params
    b = make().fit(cardio.repartition(37).orderBy(F.rand(3))).params
    for k in a:
        va, vb = a[k], b[k]
        va = va if isinstance(va, tuple) else (va,)
        vb = vb if isinstance(vb, tuple) else (vb,)
        assert all(x == pytest.approx(y, abs=1e-9) for x, y in zip(va, vb))


def test_transforms_keep_rows(cardio):
    n = cardio.count()
    assert cl.Winsorizer(["weight"]).fit(cardio).transform(cardio).count() == n
    assert fe.QuantileBinner(["weight"]).fit(cardio).transform(cardio, "_q").count() == n
    assert fe.DummyEncoder(["cholesterol"], max_levels=10).fit(cardio).transform(cardio).count() == n
    assert fe.GroupDeviation(["gender"], ["weight"]).fit(cardio).transform(cardio).count() == n
    assert cd.harmonise(cardio, "train").count() == n
    assert cl.flag_outliers(cardio).count() == n


def test_dummy_encoder_refuses_unbounded_levels(cardio):
    with pytest.raises(ValueError):
        fe.DummyEncoder(["id"], max_levels=10).fit(cardio)


def test_group_deviation_unseen_group_is_null(spark):
    train = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 5.0)], "g int, x double")
    score = spark.createDataFrame([(1, 16.0), (3, 1.0)], "g int, x double")
    gm = fe.GroupDeviation(["g"], ["x"]).fit(train)
    got = {r["g"]: r["x_deviation"] for r in gm.transform(score).collect()}
    assert got == {1: 1.0, 3: None}


def test_target_encoder_unseen_and_oof(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice("abc"), int(rnd.random() < 0.5), i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, c string, y int, fold int")
    full = fe.TargetStatEncoder(["c"], "y").fit(df)
    unseen = spark.createDataFrame([(999, "zzz")], "id long, c string")
    got = full.transform(unseen).first()
    assert got["c_target_mean"] == pytest.approx(sum(r[2] for r in rows) / 300)
    oof = fe.TargetStatEncoder(["c"], "y", fold_col="fold").fit_transform(df).collect()
    # out-of-fold mean of a row never uses rows of its own fold
    for r in oof[:20]:
        others = [x[2] for x in rows if x[1] == r["c"] and x[3] != r["fold"]]
        assert r["c_target_mean"] == pytest.approx(sum(others) / len(others))
