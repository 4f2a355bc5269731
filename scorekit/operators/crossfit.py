"""Splits, folds, cross-fitting and tuning.

Folds are assigned without a single-partition window: rows are ranked inside their class by
``md5(seed:id)`` with the bucketed prefix sum (``order.hash_rank``), then ``fold = (rank-1) % k``.
Class counts per fold therefore differ by at most one, and the assignment is the same for the same
data in any partitioning. Out-of-fold predictions are a long table ``(id, fold, model, prob)``.
"""

from __future__ import annotations

import random
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, guard_union_partitioning, keep, kept_frames, release_cached
from .joins import sized_join
from .order import hash_key, hash_rank


def stratified_folds(df: DataFrame, id_col: str, label_col: str, k: int = 5, seed=42,
                     fold_col: str = "fold") -> DataFrame:
    """K2: stratified k folds by hash rank inside each class."""
    ranked = hash_rank(df, id_col, seed, by=[label_col], out_col="_rk")
    return ranked.withColumn(fold_col, ((F.col("_rk") - 1) % k).cast("int")).drop("_rk")


def stratified_holdout(df: DataFrame, id_col: str, label_col: str, test_frac: float = 0.2, seed=42,
                       out_col: str = "is_valid") -> DataFrame:
    """K1: per class the first ceil(test_frac * n_c) rows in hash order form the validation part."""
    ranked = hash_rank(df, id_col, seed, by=[label_col], out_col="_rk")
    sizes = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))  # one row per class
    j = sized_join(ranked, sizes, label_col, "inner")
    return j.withColumn(out_col, (F.col("_rk") <= F.ceil(F.col("_nc") * test_frac)).cast("int")).drop("_rk", "_nc")


def hash_sample(df: DataFrame, id_col: str, n: int, seed=42, small_n: int = 100_000) -> DataFrame:
    """K8: n rows without replacement, the n smallest ``md5(seed:id)`` (same rows in DuckDB).

    A small n is a TakeOrderedAndProject; a large n ranks all rows by the hash with the bucketed
    prefix sum and keeps rank <= n, so no single task gathers n rows."""
    if n <= small_n:
        digest, _ = hash_key(id_col, seed)
        return df.withColumn("_h", digest).orderBy("_h", id_col).limit(n).drop("_h")
    return hash_rank(df, id_col, seed, out_col="_hr").where(F.col("_hr") <= n).drop("_hr")


def positive_prob(scored: DataFrame, out_col: str = "prob") -> DataFrame:
    """P(class 1) from ``probability``; else sigmoid of the margin; else the predicted class."""
    from pyspark.ml.functions import vector_to_array
    if "probability" in scored.columns:
        return scored.withColumn(out_col, vector_to_array("probability")[1])
    if "rawPrediction" in scored.columns:
        raw = vector_to_array("rawPrediction")
        return scored.withColumn(out_col, 1 / (1 + F.exp(-(raw[1] - raw[0]))))
    return scored.withColumn(out_col, F.col("prediction").cast("double"))


def cross_fit(df: DataFrame, make_model, id_col: str, label_col: str, fold_col: str = "fold",
              model_name: str = "model", features_col: str = "features", test: DataFrame | None = None, parallelism: int = 3):
    """K3 / K4: each fold model scores its held-out rows (every row exactly once) and, optionally,
    the scoring frame; the test score is the mean over fold models.

    ``make_model()`` returns an unfitted Spark ML estimator reading ``features_col`` and
    ``label_col``. The assembled training frame is persisted once and reused by every fold; ``parallelism`` folds are
    fitted at a time, so that their jobs share the cluster.
    Returns ``(oof, test_scores)``: ``oof = (id, fold, model, label, prob)``."""
    guard_union_partitioning(df.sparkSession)
    data = keep(df)
    folds = sorted(r[0] for r in data.select(fold_col).distinct().collect())  # k values
    oof_parts, test_parts = [], []
    estimators = {f: make_model() for f in folds}

    @inheritable_thread_target(df.sparkSession)
    def fit(f):
        return estimators[f].fit(data.where(F.col(fold_col) != f))

    with ThreadPool(max(1, min(parallelism, len(folds)))) as pool:
        models = dict(zip(folds, pool.map(fit, folds)))
    for f in folds:
        m = models[f]
        held = positive_prob(m.transform(data.where(F.col(fold_col) == f)))
        oof_parts.append(held.select(F.col(id_col).alias("id"), F.lit(f).alias("fold"), F.lit(model_name).alias("model"),
                                     F.col(label_col).cast("int").alias("label"), "prob"))
        if test is not None:
            ts = positive_prob(m.transform(test))
            test_parts.append(ts.select(F.col(id_col).alias("id"), F.lit(f).alias("fold"),
                                        F.lit(model_name).alias("model"), "prob"))
    oof = reduce(DataFrame.unionByName, oof_parts)
    test_scores = mean_fold_scores(reduce(DataFrame.unionByName, test_parts)) if test_parts else None
    return oof, test_scores


def mean_fold_scores(scored: DataFrame) -> DataFrame:
    """K4: mean probability per (id, model) over fold models (or seeds)."""
    return scored.groupBy("id", "model").agg(F.avg("prob").alias("prob"))


def fold_summary(per_fold: DataFrame, metric_col: str) -> DataFrame:
    """K5: mean and population std of a per-fold metric, per model."""
    return per_fold.groupBy("model").agg(F.avg(metric_col).alias("mean"), F.stddev_pop(metric_col).alias("std"),
                                         F.count(F.lit(1)).alias("folds"))


def per_fold_auc(oof: DataFrame) -> DataFrame:
    """Exact AUC of every (model, fold) from the long OOF table (one grouped ordered pass)."""
    from .metrics import auc_exact
    return auc_exact(oof, "label", "prob", by=["model", "fold"]).select("model", "fold", "auc")


def draw_params(grid: dict, n: int | None = None, seed: int = 42) -> list:
    """K6, K7: all points of a parameter grid, or ``n`` seeded draws from it, as dicts."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    return points if n is None or n >= len(points) else random.Random(seed).sample(points, n)


def search_params(df: DataFrame, make_model, points, id_col: str, label_col: str, fold_col: str = "fold") -> list:
    """K6, K7 for any estimator that cross-fitting takes: ``[(params, mean AUC over folds)]``, best first, the first listed
    on ties. ``make_model(**params)`` gives an unfitted estimator; the exact AUCs of all points and folds are one ordered pass."""
    oofs = [cross_fit(df, lambda p=p: make_model(**p), id_col, label_col, fold_col, str(k))[0] for k, p in enumerate(points)]
    scores = per_fold_auc(reduce(DataFrame.unionByName, oofs)).groupBy("model").agg(F.avg("auc").alias("auc")).collect()  # one row for each point
    got = {int(r["model"]): r["auc"] for r in scores}
    return [(points[k], got[k]) for k in sorted(got, key=lambda k: (-got[k], k))]


def _is_kept(df: DataFrame) -> bool:
    level = df.storageLevel
    return level.useMemory or level.useDisk


class FoldValidator(CrossValidator):
    """K6: Spark's ``CrossValidator`` over a frame that is kept. Folds are read from that frame; Spark's own fitting keeps a copy of
    every fold's training and validation rows beside it, the whole table once more."""

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        est, maps, ev = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator()
        metrics = [[0.0] * len(maps) for _ in range(self.getNumFolds())]

        @inheritable_thread_target(dataset.sparkSession)
        def score(job):
            i, j, train, valid = job
            model = est.fit(train, maps[j])
            metrics[i][j] = ev.evaluate(model.transform(valid, maps[j]))

        with ThreadPool(max(1, min(self.getParallelism(), len(maps)))) as pool:
            for i, (train, valid) in enumerate(self._kFold(dataset)):
                pool.map(score, [(i, j, train, valid) for j in range(len(maps))], 1)
        mean, std = CrossValidator._gen_avg_and_std_metrics(metrics)
        best = max(range(len(mean)), key=lambda j: mean[j] if ev.isLargerBetter() else -mean[j])
        return self._copyValues(CrossValidatorModel(est.fit(dataset, maps[best]), mean, None, std))


def random_search(df: DataFrame, make_estimator, grid: dict, n: int, label_col: str, fold_col: str = "fold",
                  seed: int = 42, metric: str = "areaUnderROC", parallelism: int = 2):
    """K6: n seeded draws from a parameter grid, each scored by k-fold CV on the fold column, by ranking
    (``areaUnderROC``, ``areaUnderPR``) or by ``accuracy``."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder
    est = make_estimator()
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    maps = builder.build()
    rng = random.Random(seed)
    draws = rng.sample(maps, min(n, len(maps)))
    ev = (MulticlassClassificationEvaluator(labelCol=label_col, metricName="accuracy") if metric == "accuracy"
          else BinaryClassificationEvaluator(labelCol=label_col, metricName=metric))
    cv = FoldValidator(estimator=est, estimatorParamMaps=draws, evaluator=ev, foldCol=fold_col,
                       parallelism=parallelism, seed=seed)
    used = {est.getOrDefault(p) for p in est.params if p.name.endswith("Col") and est.hasDefault(p) | est.isSet(p)} | {label_col, fold_col}
    since = kept_frames()
    # read by every fold, every check and the last fit: ordered folds are computed once
    own = df if _is_kept(df) else keep(df.select(*[c for c in df.columns if c in used]) if "features" in used else df)
    model = cv.fit(own)
    release_cached(since)
    return model, [({p.name: v for p, v in m.items()}, s) for m, s in zip(draws, model.avgMetrics)]


def grid_search(df: DataFrame, make_estimator, grid: dict, label_col: str, id_col: str, sample_n: int = 10_000,
                k: int = 3, seed: int = 42, metric: str = "areaUnderROC"):
    """K7: full grid on a hash sample of at most ``sample_n`` rows, stratified folds on it."""
    sample = stratified_folds(hash_sample(df, id_col, sample_n, seed), id_col, label_col, k, seed)
    n_all = 1
    for v in grid.values():
        n_all *= len(v)
    return random_search(sample, make_estimator, grid, n_all, label_col, "fold", seed, metric)


def adversarial_weights(train: DataFrame, score: DataFrame, make_model, id_col: str, feature_cols,
                        k: int = 5, seed: int = 42):
    """Classifier of training vs scoring rows (cross-fitted); training weight is
    1 - P(scoring) rescaled to mean 1. Returns ``(weights(id, weight), drift_auc)``."""
    from .joins import union_with_origin
    from .metrics import auc_exact
    from .features import assemble, fit_fill
    both = union_with_origin(train.select(id_col, *feature_cols), score.select(id_col, *feature_cols), "origin")
    both = both.withColumn("_key", F.concat_ws(":", F.col("origin").cast("string"), F.col(id_col).cast("string")))
    both = stratified_folds(both, "_key", "origin", k, seed)
    both = assemble(both, feature_cols, fill=fit_fill(train, feature_cols))
    oof, _ = cross_fit(both, make_model, "_key", "origin", "fold", "adversarial")
    auc = auc_exact(oof, "label", "prob").first()["auc"]
    tr = (oof.where(F.col("label") == 0)
          .select(F.expr("substring(id, 3)").alias("_id"), (1 - F.col("prob")).alias("w")))  # behind "0:"
    mean_w = tr.agg(F.avg("w")).first()[0]
    weights = tr.select(F.col("_id").cast(train.schema[id_col].dataType).alias(id_col),
                        (F.col("w") / F.lit(mean_w)).alias("weight"))
    return weights, auc


def pseudo_label(train: DataFrame, score: DataFrame, preds: DataFrame, id_col: str, label_col: str,
                 prob_col: str | None = None, hi: float = 0.9, lo: float = 0.1) -> DataFrame:
    """Scoring rows with their predicted label appended to training; optionally only
    confident ones (prob > hi or < lo)."""
    from .joins import append, attach_labels
    p = preds
    if prob_col:
        p = p.where((F.col(prob_col) > hi) | (F.col(prob_col) < lo))
    labelled = attach_labels(score, p, id_col, label_col).where(F.col(label_col).isNotNull())
    return append([train, labelled.select(*train.columns)])


def repeat_cross_fit(df: DataFrame, make_model, id_col: str, label_col: str, seeds, k: int = 5,
                     model_name: str = "model", test: DataFrame | None = None):
    """K2 + K3 per seed; OOF and test scores averaged per (id, model) over seeds."""
    oofs, tests = [], []
    for s in seeds:
        folded = cut_lineage(stratified_folds(df, id_col, label_col, k, s))
        oof, ts = cross_fit(folded, make_model, id_col, label_col, "fold", model_name, test=test)
        oofs.append(oof)
        if ts is not None:
            tests.append(ts)
    oof_all = reduce(DataFrame.unionByName, oofs).groupBy("id", "model").agg(
        F.first("label").alias("label"), F.avg("prob").alias("prob"))
    test_all = mean_fold_scores(reduce(DataFrame.unionByName, tests)) if tests else None
    return oof_all, test_all
