"""Folds and cross-fitting properties (K1-K4, M-checks): every id once, balanced classes,
planted signal learned, same seed same result."""

import random

from pyspark.sql import functions as F

from scorekit.operators import crossfit as cf
from scorekit.operators import metrics as met
from scorekit.operators import models as mdl
from scorekit.operators.features import assemble


def _planted(spark, n=1200):
    rnd = random.Random(9)
    rows = []
    for i in range(n):
        a, b = rnd.random(), rnd.random()
        rows.append((i, a, b, int(a + 0.3 * rnd.random() > 0.65)))
    return spark.createDataFrame(rows, "id long, a double, b double, label int").repartition(5)


def test_folds_balanced_and_cover(spark):
    df = _planted(spark)
    f = cf.stratified_folds(df, "id", "label", 5, seed=3)
    assert f.count() == 1200 and f.select("id").distinct().count() == 1200
    per = f.groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        sizes = [r["count"] for r in per if r["label"] == lab]
        assert max(sizes) - min(sizes) <= 1


def test_cross_fit_oof_once_and_learns(spark):
    df = assemble(cf.stratified_folds(_planted(spark), "id", "label", 3, seed=1), ["a", "b"])
    oof, _ = cf.cross_fit(df, mdl.logistic(standardization=True), "id", "label")
    assert oof.count() == 1200 and oof.select("id").distinct().count() == 1200
    assert met.auc_exact(oof, "label", "prob").first()["auc"] > 0.9
    oof2, _ = cf.cross_fit(df, mdl.logistic(standardization=True), "id", "label")
    a = {r["id"]: r["prob"] for r in oof.collect()}
    b = {r["id"]: r["prob"] for r in oof2.collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_adversarial_weights_mean_one(spark):
    df = _planted(spark, 600)
    train = df.where(F.col("id") % 3 != 0)
    score = df.where(F.col("id") % 3 == 0).withColumn("a", F.col("a") + 0.5)
    w, auc = cf.adversarial_weights(train, score, mdl.tree(max_depth=3, label_col="origin"), "id", ["a", "b"], k=3)
    assert abs(w.agg(F.avg("weight")).first()[0] - 1.0) < 1e-9
    assert auc > 0.7


def test_adaboost_learns(spark):
    df = assemble(_planted(spark, 600), ["a", "b"])
    model = mdl.AdaBoost(depth=2, rounds=6, rate=0.5).fit(df)
    scored = model.transform(df)
    assert met.auc_exact(scored, "label", "prob").first()["auc"] > 0.85


def test_hash_sample_large_n_path_matches_small(spark):
    df = _planted(spark, 500)
    a = {r["id"] for r in cf.hash_sample(df, "id", 120, seed=5).collect()}
    b = {r["id"] for r in cf.hash_sample(df, "id", 120, seed=5, small_n=10).collect()}
    assert a == b and len(a) == 120


def _accumulating(spark, df):
    """``df`` through a function that counts how many rows were ever made."""
    made = spark.sparkContext.accumulator(0)

    def kernel(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b
    return df.mapInArrow(kernel, df.schema), made


def test_searches_and_stacks_compute_their_input_once(spark):
    """Folds, checks and passes of a fit read kept rows."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = [(i, i % 3, i % 2, float(i % 2 + i % 5), float(i % 7)) for i in range(300)]
    raw, made = _accumulating(spark, spark.createDataFrame(rows, "id long, fold int, label int, a double, b double").repartition(2))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(raw)
    _, res = cf.random_search(df, lambda: DecisionTreeClassifier(labelCol="label"), {"maxDepth": [1, 2]}, 2, "label")
    assert len(res) == 2 and made.value == 300
    oof = [(i, m, i % 2, (i % 2 * 0.3 + i * k % 10 / 20)) for k, m in ((3, "x"), (7, "y")) for i in range(300)]
    raw, made = _accumulating(spark, spark.createDataFrame(oof, "id long, model string, label int, prob double").repartition(2))
    _, out, _ = mdl.stack(raw, None)
    assert out.count() == 300 and made.value == 600


def test_rows_of_two_classes_are_not_left_to_two_tasks(spark):
    """Models are fitted on the folded rows as they lie; the folds are those of one sort."""
    df = spark.range(400_000).select("id", (F.col("id") % 2).cast("int").alias("label"))
    folded = cf.stratified_folds(df, "id", "label", 3, 42).persist()
    most = folded.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert most < 200_000
    counts = {(r["label"], r["fold"]): r["count"] for r in folded.groupBy("label", "fold").count().collect()}
    assert len(counts) == 6 and max(counts.values()) - min(counts.values()) <= 1
    folded.unpersist()


def test_search_reads_folds_from_one_kept_frame(spark, monkeypatch):
    """Spark's scores and best model, without a copy of each fold's rows beside the kept ones; nothing is left kept after it."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from scorekit.session import release_cached
    release_cached()
    df = assemble(cf.stratified_folds(_planted(spark), "id", "label", 3, seed=1), ["a", "b"]).select("label", "fold", "features")
    est, ev = DecisionTreeClassifier(labelCol="label"), BinaryClassificationEvaluator(labelCol="label")
    want = CrossValidator(estimator=est, estimatorParamMaps=ParamGridBuilder().addGrid(est.maxDepth, [1, 2, 3]).build(), evaluator=ev, foldCol="fold").fit(df)
    release_cached()
    stored, seen, evaluate = spark.sparkContext._jsc.getPersistentRDDs, [], BinaryClassificationEvaluator.evaluate
    before = len(stored())
    monkeypatch.setattr(BinaryClassificationEvaluator, "evaluate", lambda *a: (seen.append(len(stored()) - before), evaluate(*a))[1])
    df = df.persist()
    df.count()
    model, res = cf.random_search(df, lambda: DecisionTreeClassifier(labelCol="label"), {"maxDepth": [1, 2, 3]}, 3, "label", parallelism=1)
    assert len(seen) == 9 and max(seen) == 1 and len(stored()) == before + 1
    assert {p["maxDepth"]: s for p, s in res} == dict(zip([1, 2, 3], want.avgMetrics))
    assert model.bestModel.toDebugString.split("\n", 1)[1] == want.bestModel.toDebugString.split("\n", 1)[1]
    df.unpersist()


def test_class_weight_choice_keeps_nothing(spark):
    from scorekit.session import release_cached
    release_cached()
    df = assemble(cf.stratified_folds(_planted(spark), "id", "label", 3, seed=1), ["a", "b"]).persist()
    df.count()
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    best, tried = mdl.choose_class_weight(df, mdl.tree(max_depth=2, weight_col="weight"), {"none": 1.0, "up": 2.0}, "id", "label")
    assert len(tried) == 2 and len(spark.sparkContext._jsc.getPersistentRDDs()) <= before
    df.unpersist()


def test_frames_kept_for_another_are_freed(spark):
    from scorekit.session import keep, keep_alone, kept_frames, release_cached
    release_cached()
    first = keep(spark.range(100).withColumn("a", F.col("id") % 7))
    since = kept_frames()
    inner = keep(spark.range(50).withColumn("b", F.col("id") % 3))
    inner.count()
    out = keep_alone(inner.groupBy("b").count(), since)
    assert out.storageLevel.useMemory and first.storageLevel.useMemory and not inner.storageLevel.useMemory and kept_frames() == since + 1
    release_cached()
    assert not out.storageLevel.useMemory and not first.storageLevel.useMemory
