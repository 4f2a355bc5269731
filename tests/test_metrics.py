"""Metric properties and edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from scorekit.operators import ensemble as ens
from scorekit.operators import metrics as met


def _auc_brute(rows):
    pos = [p for p, y in rows if y == 1]
    neg = [p for p, y in rows if y == 0]
    s = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(3)
    rows = [(i, round(rnd.random(), 2), int(rnd.random() < 0.4)) for i in range(400)]
    return rows, spark.createDataFrame(rows, "id long, p double, y int").repartition(5)


def test_auc_exact_with_ties(scored):
    rows, df = scored
    got = met.auc_exact(df, "y", "p").first()["auc"]
    assert got == pytest.approx(_auc_brute([(p, y) for _, p, y in rows]), abs=1e-12)


def test_auc_symmetry_and_monotone(scored):
    _, df = scored
    a = met.auc_exact(df, "y", "p").first()["auc"]
    b = met.auc_exact(df.withColumn("p", 1 - F.col("p")), "y", "p").first()["auc"]
    c = met.auc_exact(df.withColumn("p", F.exp(F.col("p") * 3)), "y", "p").first()["auc"]
    assert a + b == pytest.approx(1.0, abs=1e-12)
    assert c == pytest.approx(a, abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2, 1), (2, 0.3, 1)], "id long, p double, y int")
    assert met.auc_exact(df, "y", "p").first()["auc"] is None


def test_confusion_zero_denominators(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 0)], "id long, y int, pred int")
    r = met.confusion_metrics(df, "y", "pred").first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0 and r["mcc"] == 0.0
    assert r["accuracy"] == 1.0


def test_average_precision_brute(scored):
    rows, df = scored
    pts = sorted(set(p for _, p, _ in rows), reverse=True)
    P = sum(y for _, _, y in rows)
    ap = 0.0
    for t in pts:
        tp = sum(1 for _, p, y in rows if p >= t and y == 1)
        fp = sum(1 for _, p, y in rows if p >= t and y == 0)
        gain = sum(1 for _, p, y in rows if p == t and y == 1) / P
        ap += gain * tp / (tp + fp)
    assert met.average_precision(df, "y", "p").first()["average_precision"] == pytest.approx(ap, abs=1e-12)


def test_threshold_grid_lengths():
    assert len(ens.arange_grid(0.35, 0.65, 0.01)) == 31
    assert len(ens.arange_grid(0.30, 0.70, 0.01)) == 40
    assert len(ens.arange_grid(0.30, 0.70, 0.005)) == 80
    assert len(ens.arange_grid(0.05, 0.95, 0.01)) == 90
    assert len(ens.arange_grid(0.1, 0.9, 0.01)) == 80
    assert ens.arange_grid(0.35, 0.65, 0.01)[15] == 0.5000000000000001


def test_threshold_sweep_brute(scored):
    rows, df = scored
    grid = ens.arange_grid(0.3, 0.7, 0.05)
    sw = {r["j"]: r for r in ens.threshold_sweep(df, "y", "p", grid, ">").collect()}
    for j, t in enumerate(grid):
        tp = sum(1 for _, p, y in rows if p > t and y == 1)
        fn = sum(1 for _, p, y in rows if not p > t and y == 1)
        assert sw[j]["tp"] == tp and sw[j]["fn"] == fn


def test_youden_all_wrong_clips_high(spark):
    df = spark.createDataFrame([(1, 0.9, 0), (2, 0.1, 1)], "id long, p double, y int")
    assert ens.youden_threshold(df, "y", "p").first()["threshold"] == 0.95
