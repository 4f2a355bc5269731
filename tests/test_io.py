"""Sources and sinks (IO1-IO9), threshold publishing (B22) and driver-side helpers."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from scorekit.operators import clean as cl
from scorekit.operators import ensemble as ens
from scorekit.operators.order import unique_in_order
from scorekit.operators.select import selection_report
from scorekit.sources import io
from scorekit.spec import TableSpec


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="io-", dir="/tmp")


def test_prediction_roundtrip_and_loading(spark, scratch):
    a = spark.createDataFrame([(i, i % 2, i) for i in range(20)], "id long, label int, row_no int")
    b = a.withColumn("label", 1 - F.col("label"))
    pa, pb = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    io.write_predictions(a, pa, order_col="row_no")
    io.write_predictions(b, pb)
    back = io.read_table(spark, pa, TableSpec("id", "label"), schema="id long, label int", fmt="csv")
    assert [r["id"] for r in back.collect()] == list(range(20))  # file order kept
    lv = io.load_prediction_sets(spark, [(pa, "a"), (os.path.join(scratch, "missing"), "x"), (pb, "b")])
    assert lv.count() == 40 and sorted(r["ordinal"] for r in lv.select("ordinal").distinct().collect()) == [1, 3]
    with pytest.raises(ValueError):
        io.load_prediction_sets(spark, [(pa, "a")])


def test_probabilities_oof_run_params(spark, scratch):
    p = spark.createDataFrame([(1, 0.2), (2, 0.9)], "id long, prob double")
    io.write_probabilities(p, os.path.join(scratch, "p"))
    assert spark.read.parquet(os.path.join(scratch, "p")).count() == 2
    oof = spark.createDataFrame([(1, 0, "m1", 1, 0.3), (1, 0, "m2", 1, 0.4)], "id long, fold int, model string, label int, prob double")
    io.write_oof(oof, os.path.join(scratch, "oof"))
    assert {"model=m1", "model=m2"} <= set(os.listdir(os.path.join(scratch, "oof")))
    io.write_run(spark, {"params": {"depth": 3}, "auc": 0.9}, os.path.join(scratch, "run"))
    got = io.load_params(spark, os.path.join(scratch, "run"), {"auc": 0.0, "other": 1})
    assert got["auc"] == 0.9 and got["other"] == 1
    assert io.load_params(spark, os.path.join(scratch, "nope"), {"x": 1}) == {"x": 1}


def test_model_save_load(spark, scratch):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(float(i), i % 2) for i in range(40)], "x double, label int")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression()]).fit(df)
    path = io.save_model(model, os.path.join(scratch, "m"))
    again = io.load_model(path)
    assert again.transform(df).count() == 40


def test_publish_thresholds(spark, scratch):
    df = spark.createDataFrame([(1, 0.3), (2, 0.6)], "id long, prob double")
    ens.publish_thresholds(df, "id", "prob", [0.4, 0.5], os.path.join(scratch, "thr"))
    back = spark.read.parquet(os.path.join(scratch, "thr"))
    assert back.count() == 4 and back.where(F.col("label") == 1).count() == 2


def test_driver_helpers(spark):
    assert unique_in_order(["a", "b", "a", "c", "b"], cap=2) == ["a", "b"]
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        cl.require(df, ["a", "z"])
    rep = selection_report(["x_is_999", "a_x_b", "meta"], {"flags": lambda n: n.endswith("_is_999"),
                                                           "interactions": lambda n: "_x_" in n})
    assert rep == {"flags": ["x_is_999"], "interactions": ["a_x_b"]}
