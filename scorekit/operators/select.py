"""Feature selection (X1-X8). Scores are small per-feature tables; the ranking is a top-n sort
of at most a few hundred rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import merge_scores
from .profile import anova_f, corr_pairs, fused_stats, target_corr


def select_by_mi(df: DataFrame, cols, label_col: str, n: int, k: int = 3) -> DataFrame:
    """Top-n by k-NN mutual information (ties by name)."""
    from .knn import mutual_info_knn
    return mutual_info_knn(df, cols, label_col, k).orderBy(F.col("mi").desc(), "feature").limit(n)


def select_by_corr(df: DataFrame, cols, label_col: str, n: int) -> DataFrame:
    """Top-n by absolute correlation with the label."""
    return target_corr(df, cols, label_col).orderBy(F.col("abs_corr").desc_nulls_last(), "feature").limit(n)


def importance_table(model, feature_names) -> list[tuple[str, float]]:
    """(feature, importance) of a fitted tree ensemble: shares of the gain, of Spark's trees or our own."""
    if callable(getattr(model, "importance", None)):
        own = dict(model.importance())
        return [(f, float(own.get(f, 0.0))) for f in feature_names]
    imp = model.featureImportances.toArray()
    return [(f, float(v)) for f, v in zip(feature_names, imp)]


def select_by_importance(spark, model, feature_names, n: int) -> DataFrame:
    rows = importance_table(model, feature_names)
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature").limit(n)


def blend_scores(scores: dict, weights: dict, n: int) -> DataFrame:
    """Min-max normalise each method's score over features (equal min and max -> 0), weighted
    sum, top n. ``scores``: method -> (feature, score) frame."""
    merged = merge_scores(scores)
    methods = list(scores)
    bounds = merged.agg(*[F.min(m).alias(f"lo_{m}") for m in methods], *[F.max(m).alias(f"hi_{m}") for m in methods]).first()
    parts = []
    for m in methods:
        lo, hi = bounds[f"lo_{m}"], bounds[f"hi_{m}"]
        norm = F.lit(0.0) if hi == lo else (F.col(m) - F.lit(lo)) / F.lit(hi - lo)
        parts.append(norm * F.lit(float(weights[m])))
    total = reduce(lambda a, b: a + b, parts)
    return merged.withColumn("combined", total).orderBy(F.col("combined").desc(), "feature").limit(n)


def prune_correlated(df: DataFrame, cols, threshold: float = 0.95) -> list[str]:
    """Drop column j when an earlier column i < j has |r| > threshold (column order decides).
    The p x p matrix comes from one aggregate; the rule runs on that small table."""
    cols = list(cols)
    pairs = corr_pairs(df, cols, threshold).collect()  # only the pairs above the threshold
    pos = {c: i for i, c in enumerate(cols)}
    drop = set()
    for r in pairs:
        a, b = r["feature_a"], r["feature_b"]
        later = a if pos[a] > pos[b] else b
        drop.add(later)
    return [c for c in cols if c in drop]


def prune_least_important(importances: DataFrame, frac: float = 0.2) -> list[str]:
    """Mean importance over folds; drop the max(1, round(frac * n)) least important."""
    mean = importances.groupBy("feature").agg(F.avg("importance").alias("imp"))
    n = mean.count()
    k = max(1, int(round(frac * n)))
    return [r["feature"] for r in mean.orderBy("imp", "feature").limit(k).collect()]


def refit_pruned(df: DataFrame, make_model, cols, importances: DataFrame, id_col: str, label_col: str, frac: float = 0.2,
                 fold_col: str = "fold") -> tuple:
    """Drop the least important columns and cross-fit again on the others: ``(kept columns, oof)``."""
    from .crossfit import cross_fit
    from .features import assemble, fit_fill
    gone = set(prune_least_important(importances, frac))
    kept = [c for c in cols if c not in gone]
    data = assemble(df.drop("features"), kept, fill=fit_fill(df, kept))
    return kept, cross_fit(data, make_model, id_col, label_col, fold_col, "pruned")[0]


def selection_report(names, groups: dict) -> dict:
    """How many selected names fall in each named group (flags, interactions, metadata)."""
    out = {}
    for g, pred in groups.items():
        out[g] = [n for n in names if pred(n)]
    return out


def select_by_variance(df: DataFrame, cols, n: int) -> DataFrame:
    """Top-n by sample variance."""
    return fused_stats(df, cols, {"var": F.var_samp}).orderBy(F.col("var").desc_nulls_last(), "feature").limit(n)


def select_by_anova(df: DataFrame, cols, label_col: str, n: int) -> DataFrame:
    return anova_f(df, cols, label_col).orderBy(F.col("f_score").desc_nulls_last(), "feature").limit(n)
