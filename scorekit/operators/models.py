"""Models (M1-M15) as Spark ML estimators, plus stacking and calibration.

Every constructor returns a zero-argument factory of an unfitted estimator reading ``features``
and ``label`` so that cross-fitting can build one per fold. Training is distributed by Spark ML
(tree aggregation over partitions); nothing is collected except model parameters.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, keep, kept_frames, release_cached
from .calibration import apply_calibration, calibrate_isotonic  # noqa: F401  (B15)
from .crossfit import positive_prob
from .features import assemble
from .order import argmax_row
from .trees import feature_matrix, from_spark, score_column


def boosted(max_iter=100, max_depth=5, step_size=0.1, subsampling=1.0, feature_subset="all", min_instances=1,
            min_info_gain=0.0, weight_col=None, validation_col=None, seed=42, label_col="label", max_bins=32):
    """M1: gradient-boosted trees (L1/L2 leaf penalties have no Spark counterpart)."""
    def make():
        kw = dict(maxIter=max_iter, maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsampling,
                  featureSubsetStrategy=feature_subset, minInstancesPerNode=min_instances, minInfoGain=min_info_gain,
                  seed=seed, labelCol=label_col, featuresCol="features", maxBins=max_bins)
        if weight_col:
            kw["weightCol"] = weight_col
        if validation_col:
            kw["validationIndicatorCol"] = validation_col
        return GBTClassifier(**kw)
    return make


def forest(num_trees=100, max_depth=10, seed=42, weight_col=None, label_col="label", bootstrap=True,
           feature_subset="auto", max_bins=32):
    """M2 (M3 with ``bootstrap=False``: extra-trees are approximated by unbagged random-subset trees)."""
    def make():
        kw = dict(numTrees=num_trees, maxDepth=max_depth, seed=seed, labelCol=label_col, featuresCol="features",
                  bootstrap=bootstrap, featureSubsetStrategy=feature_subset, maxBins=max_bins)
        if weight_col:
            kw["weightCol"] = weight_col
        return RandomForestClassifier(**kw)
    return make


def extra_trees(num_trees=100, max_depth=10, seed=42, label_col="label"):
    """M3: documented approximation (no bagging, sqrt feature subsets, coarse split bins)."""
    return forest(num_trees, max_depth, seed, label_col=label_col, bootstrap=False, feature_subset="sqrt", max_bins=16)


def tree(max_depth=5, min_instances=1, weight_col=None, label_col="label", seed=42):
    """M5: single decision tree."""
    def make():
        kw = dict(maxDepth=max_depth, minInstancesPerNode=min_instances, labelCol=label_col, featuresCol="features",
                  seed=seed)
        if weight_col:
            kw["weightCol"] = weight_col
        return DecisionTreeClassifier(**kw)
    return make


def logistic(C=1.0, n_rows=None, max_iter=100, standardization=False, label_col="label", weight_col=None):
    """M6: L2 logistic regression; C of the reference maps to regParam = 1 / (C n)."""
    reg = 0.0 if not n_rows else 1.0 / (C * n_rows)

    def make():
        kw = dict(regParam=reg, elasticNetParam=0.0, maxIter=max_iter, standardization=standardization,
                  labelCol=label_col, featuresCol="features")
        if weight_col:
            kw["weightCol"] = weight_col
        return LogisticRegression(**kw)
    return make


def linear_svc(C=1.0, n_rows=None, max_iter=100, label_col="label", weight_col=None, degree=1):
    """M7: linear max-margin classifier; probability by sigmoid of the margin (M11). ``degree`` above 1
    expands the features to their polynomials first (the polynomial kernel's feature space)."""
    reg = 0.0 if not n_rows else 1.0 / (C * n_rows)

    def make():
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import PolynomialExpansion, StandardScaler
        kw = dict(regParam=reg, maxIter=max_iter, labelCol=label_col, featuresCol="features" if degree == 1 else "_poly")
        if weight_col:
            kw["weightCol"] = weight_col
        if degree == 1:
            return LinearSVC(**kw)
        return Pipeline(stages=[StandardScaler(inputCol="features", outputCol="_scaled", withMean=True),
                                PolynomialExpansion(degree=degree, inputCol="_scaled", outputCol="_poly"), LinearSVC(**kw)])
    return make


def perceptron(layers, max_iter=100, seed=42, label_col="label", block_size=128):
    """M8: multilayer perceptron (no dropout or batch normalisation in Spark ML) on standardised
    features; without that, columns of large units saturate the hidden layer and nothing is learned."""
    def make():
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import StandardScaler
        return Pipeline(stages=[
            StandardScaler(inputCol="features", outputCol="_unit", withMean=True),
            MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter, seed=seed, labelCol=label_col,
                                           featuresCol="_unit", blockSize=block_size)])
    return make


class CategoricalBoosting:
    """Categorical-aware boosting. Every category column becomes its ordered target statistics (the label's mean over
    earlier rows of the category, in a seeded hash order of the id), so no row sees its own label, however many levels there are;
    scoring rows get the mean over all training rows. Numeric gaps are missing values of the trees. Trees are of second order."""

    def __init__(self, cat_cols, num_cols, max_iter=100, max_depth=5, label_col="label", seed=42, id_col="id", smoothing: float = 1.0, **boosting):
        self.cat_cols, self.num_cols, self.label_col, self.id_col, self.seed, self.smoothing = list(cat_cols), list(num_cols), label_col, id_col, seed, smoothing
        self.boosting = dict(rounds=max_iter, depth=max_depth, label_col=label_col, id_col=id_col, seed=seed, **boosting)

    def fit(self, df: DataFrame) -> "FittedCategorical":
        from .boosting import GradientBoosting
        from .features import OrderedTargetEncoder
        encoder = OrderedTargetEncoder(self.cat_cols, self.label_col, self.id_col, self.seed, self.smoothing)
        cols = [*self.num_cols, *(f"{c}_ordered_mean" for c in self.cat_cols)]
        return FittedCategorical(encoder.fit(df), GradientBoosting(feature_cols=cols, **self.boosting).fit(encoder.fit_transform(df)))


class FittedCategorical:
    def __init__(self, encoder, model):
        self.encoder, self.model = encoder, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.encoder.transform(df))


def boosted_categorical(cat_cols, max_iter=100, max_depth=5, label_col="label", seed=42, **more):
    """M15 factory: ``make(num_cols)`` gives an estimator over raw columns."""
    return lambda num_cols: CategoricalBoosting(cat_cols, num_cols, max_iter, max_depth, label_col, seed, **more)


# --- M4: adaptive boosting (SAMME with a weight column) ------------------------------------

class AdaBoost:
    """M4: rounds of weighted depth-d trees; row weights live in a column and are updated by one
    projection per round; the lineage is cut with a reliable checkpoint every few rounds."""

    def __init__(self, depth=3, rounds=100, rate=0.1, label_col="label", checkpoint_every=5, seed=42):
        self.depth, self.rounds, self.rate, self.label_col = depth, rounds, rate, label_col
        self.checkpoint_every, self.seed = checkpoint_every, seed

    def fit(self, df: DataFrame):
        y = F.col(self.label_col).cast("double")
        n = df.count()
        data = df.select("features", y.alias("_y")).withColumn("_w", F.lit(1.0 / n)).persist()
        learners = []
        for r in range(self.rounds):
            m = DecisionTreeClassifier(maxDepth=self.depth, labelCol="_y", weightCol="_w", seed=self.seed + r).fit(data)
            pred = m.transform(data).select("_y", "_w", "features", F.col("prediction"))
            st = pred.agg(F.sum(F.when(F.col("prediction") != F.col("_y"), F.col("_w"))).alias("err"),
                          F.sum("_w").alias("tot")).first()
            err = (st["err"] or 0.0) / st["tot"]
            if err <= 0:
                learners.append((m, 10.0))
                break
            if err >= 0.5:
                break
            alpha = self.rate * math.log((1 - err) / err)
            learners.append((m, alpha))
            upd = pred.select("features", "_y", (F.col("_w") * F.when(F.col("prediction") != F.col("_y"),
                                                                     F.lit(math.exp(alpha))).otherwise(1.0)).alias("_w"))
            tot = upd.agg(F.sum("_w")).first()[0]
            nxt = upd.select("features", "_y", (F.col("_w") / tot).alias("_w"))
            if (r + 1) % self.checkpoint_every == 0:
                nxt = cut_lineage(nxt)  # written weights: nothing before this round is needed again
            nxt = nxt.persist()
            nxt.count()  # build the new weights from the cached old ones before those are freed
            data.unpersist()
            data = nxt
        data.unpersist()
        return AdaBoostModel(learners)


class AdaBoostModel:
    def __init__(self, learners):
        self.learners = learners

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prob``. All trees are packed and scored in one projection, so the plan does not grow with the rounds; trees that
        split on sets of categories are applied one after the other."""
        trees = from_spark([m for m, _ in self.learners], lambda t, label: self.learners[t][1] * (2 * label - 1))
        if trees is None:
            return self._chained(df)
        total = score_column(feature_matrix(), trees) if trees.roots else F.lit(0.0)
        return df.withColumn("prob", 1 / (1 + F.exp(-total / F.lit(sum(a for _, a in self.learners) or 1.0))))

    def _chained(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("_score", F.lit(0.0)).withColumn("_asum", F.lit(sum(a for _, a in self.learners) or 1.0))
        for i, (m, a) in enumerate(self.learners):
            m.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}")
            out = m.transform(out).withColumn("_score", F.col("_score") + F.lit(a) * (2 * F.col(f"_p{i}") - 1)) \
                .drop(f"_p{i}", f"_r{i}", f"_q{i}")
        # binary SAMME: P(1) = sigmoid(sum_m alpha_m (2 pred_m - 1) / sum_m alpha_m)
        return out.withColumn("prob", 1 / (1 + F.exp(-F.col("_score") / F.col("_asum")))).drop("_score", "_asum")


# --- M10, M12-M14 ---------------------------------------------------------------------------

def pick_best(per_model_auc: DataFrame, listed=None) -> str:
    """The model with the highest validation AUC; on ties the first of ``listed`` (the order in
    which the models were given), by name where no order is known."""
    rank = F.lit(0)
    for k, name in enumerate(listed or ()):
        rank = F.when(F.col("model") == name, F.lit(k)).otherwise(rank)
    best = per_model_auc.withColumn("_rank", rank)
    return argmax_row(best, "auc", "_rank", "model").first()["model"]


def class_weights(df: DataFrame, label_col: str, mode: str = "balanced", ratio: float | None = None) -> DataFrame:
    """Weight column from one count aggregate: balanced n / (2 n_c), or neg/pos on positives."""
    counts = {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}  # one row per class
    n = sum(counts.values())
    if mode == "balanced":
        w = {c: n / (len(counts) * k) for c, k in counts.items()}
    elif mode == "neg_pos":
        w = {0: 1.0, 1: (ratio if ratio is not None else counts.get(0, 0) / max(counts.get(1, 1), 1))}
    else:
        raise ValueError(mode)
    expr = reduce(lambda acc, kv: acc.when(F.col(label_col) == kv[0], F.lit(float(kv[1]))),
                  list(w.items())[1:], F.when(F.col(label_col) == list(w)[0], F.lit(float(list(w.values())[0]))))
    return df.withColumn("weight", expr.otherwise(F.lit(1.0)))


def choose_class_weight(df: DataFrame, make_model, options: dict, id_col: str, label_col: str, fold_col: str = "fold"):
    """The class weights with the highest cross-fitted accuracy, the first listed on ties.

    ``options``: name -> weight of class 1 (class 0 weighs 1), or "balanced"; ``make_model()`` reads the
    column ``weight``. Returns ``(name, [(name, accuracy)])``; accuracy is the mean over folds."""
    from .crossfit import cross_fit
    scored = []
    for name, option in options.items():
        weighted = class_weights(df, label_col) if option == "balanced" else class_weights(df, label_col, "neg_pos", float(option))
        since = kept_frames()
        oof, _ = cross_fit(weighted, make_model, id_col, label_col, fold_col, name)
        right = ((F.col("prob") >= 0.5).cast("int") == F.col("label")).cast("double")
        scored.append((name, oof.groupBy("fold").agg(F.avg(right).alias("a")).agg(F.avg("a")).first()[0]))
        release_cached(since)  # the weighted rows are not read again
    return max(scored, key=lambda x: x[1])[0], scored


def seed_bag(df: DataFrame, make_model_for_seed, id_col: str, label_col: str, seeds, fold_col="fold",
             model_name="bag", test: DataFrame | None = None):
    """Cross-fit one model per seed; OOF and test probabilities averaged over seeds."""
    from .crossfit import cross_fit, mean_fold_scores
    oofs, tests = [], []
    for s in seeds:
        oof, ts = cross_fit(df, lambda s=s: make_model_for_seed(s), id_col, label_col, fold_col, model_name, test=test)
        oofs.append(oof)
        if ts is not None:
            tests.append(ts)
    oof = reduce(DataFrame.unionByName, oofs).groupBy("id", "model").agg(F.first("label").alias("label"),
                                                                         F.avg("prob").alias("prob"))
    return oof, (mean_fold_scores(reduce(DataFrame.unionByName, tests)) if tests else None)


class RoutedModel:
    """A main model for rows with any observed behaviour value (none/partial sentinel) and a
    metadata-only model for all-sentinel rows; scores are the union of both routes. Where the training
    rows held no all-sentinel row there is no second model, and the main model scores those rows too."""

    def __init__(self, behaviour_cols, meta_cols, make_main, make_meta, label_col="label", sentinel=999):
        self.behaviour_cols, self.meta_cols = list(behaviour_cols), list(meta_cols)
        self.make_main, self.make_meta = make_main, make_meta
        self.label_col, self.sentinel = label_col, sentinel

    def _route(self, df):
        from .profile import sentinel_row_type
        return df.withColumn("_route", sentinel_row_type(self.behaviour_cols, self.sentinel))

    def fit(self, df: DataFrame):
        r = self._route(df)
        main = self.make_main().fit(assemble(r.where(F.col("_route") != "all"), self.behaviour_cols + self.meta_cols))
        meta_rows = r.where(F.col("_route") == "all")
        meta = self.make_meta().fit(assemble(meta_rows, self.meta_cols)) if meta_rows.limit(1).count() else None
        return main, meta

    def transform(self, models, df: DataFrame, id_col: str) -> DataFrame:
        main, meta = models
        r = self._route(df)
        own = r if meta is None else r.where(F.col("_route") != "all")
        a = positive_prob(main.transform(assemble(own, self.behaviour_cols + self.meta_cols)))
        parts = [a.select(id_col, "_route", "prob")]
        if meta is not None:
            b = positive_prob(meta.transform(assemble(r.where(F.col("_route") == "all"), self.meta_cols)))
            parts.append(b.select(id_col, "_route", "prob"))
        return reduce(DataFrame.unionByName, parts)


# --- B13-B15: stacking and calibration ---------------------------------------------------------

def stack(oof_long: DataFrame, test_long: DataFrame | None, C: float = 1.0):
    """Logistic meta-model on pivoted OOF columns (one per model), applied to test means."""
    oof_long = keep(oof_long.select("id", "model", "label", "prob"))  # scored once for the names, the columns, the labels and the fit
    models = sorted(r[0] for r in oof_long.select("model").distinct().collect())  # few models
    wide = oof_long.groupBy("id").pivot("model", models).agg(F.first("prob")).join(
        oof_long.groupBy("id").agg(F.first("label").alias("label")), "id")
    n = wide.count()
    meta = logistic(C=C, n_rows=n)().fit(assemble(wide, models))
    out = positive_prob(meta.transform(assemble(wide, models))).select("id", "label", "prob")
    if test_long is None:
        return meta, out, None
    tw = test_long.groupBy("id").pivot("model", models).agg(F.avg("prob"))
    return meta, out, positive_prob(meta.transform(assemble(tw, models))).select("id", "prob")


def stack_cv(oof_long: DataFrame, grid=(0.001, 0.01, 0.1, 1.0), k: int = 3, seed: int = 42):
    """Meta-model penalty chosen by k-fold CV."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    models = sorted(r[0] for r in oof_long.select("model").distinct().collect())
    wide = oof_long.groupBy("id").pivot("model", models).agg(F.first("prob")).join(
        oof_long.groupBy("id").agg(F.first("label").alias("label")), "id")
    lr = LogisticRegression(featuresCol="features", labelCol="label")
    pg = ParamGridBuilder().addGrid(lr.regParam, list(grid)).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=pg, numFolds=k, seed=seed,
                        evaluator=BinaryClassificationEvaluator(labelCol="label"))
    m = cv.fit(assemble(wide, models))
    return m.bestModel, list(zip(grid, m.avgMetrics))
