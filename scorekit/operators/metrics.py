"""Exact distributed metrics.

Threshold-free metrics (AUC, average precision, ROC points) first aggregate equal scores, so the
ordered pass sees distinct scores only, then run the two-stage prefix sum of ``order.prefix_sum``.
Confusion-based metrics are a single aggregate of four counts. All counts are doubles before any
product so nothing overflows at very large row counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import prefix_sum


def _div(a: Column, b: Column) -> Column:
    """a / b with 0 for a zero (or null) denominator."""
    return F.when(b.isNull() | (b == 0), F.lit(0.0)).otherwise(a / b)


def _pred(pred_col: str) -> Column:
    return F.col(pred_col).cast("int")


def confusion_counts(df: DataFrame, label_col: str, pred_col: str, by=()) -> DataFrame:
    y, p = F.col(label_col).cast("int"), _pred(pred_col)
    aggs = [F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def confusion_metrics(df: DataFrame, label_col: str, pred_col: str, by=()) -> DataFrame:
    """Counts plus accuracy, precision, recall, F1, specificity, NPV, Matthews, Cohen's kappa;
    one row per ``by`` group (e.g. per model) from a single aggregate."""
    c = confusion_counts(df, label_col, pred_col, by)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    precision = _div(tp, tp + fp)
    recall = _div(tp, tp + fn)
    mcc_den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    pe = _div((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), n * n)
    acc = _div(tp + tn, n)
    return c.select(
        *by, "tp", "fp", "tn", "fn",
        acc.alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _div(2 * precision * recall, precision + recall).alias("f1"),
        _div(tn, tn + fp).alias("specificity"),
        _div(tn, tn + fn).alias("npv"),
        _div(tp * tn - fp * fn, mcc_den).alias("mcc"),
        F.when(pe >= 1.0, F.lit(0.0)).otherwise((acc - pe) / (F.lit(1.0) - pe)).alias("kappa"),
    )


def error_counts(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """False positive / false negative counts and their shares of all rows."""
    c = confusion_counts(df, label_col, pred_col)
    n = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return c.select(
        n.alias("n"), (F.col("fp") + F.col("fn")).alias("errors"), "fp", "fn",
        _div((F.col("fp") + F.col("fn")).cast("double"), n).alias("error_rate"),
        _div(F.col("fp").cast("double"), n).alias("fp_rate"),
        _div(F.col("fn").cast("double"), n).alias("fn_rate"),
    )


def score_counts(df: DataFrame, label_col: str, prob_col: str, by=()) -> DataFrame:
    """Positives and negatives per distinct score (nulls dropped). Map-side combined."""
    y = F.col(label_col).cast("long")
    return (df.where(F.col(prob_col).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(*by, F.col(prob_col).cast("double").alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))


def roc_points(df: DataFrame, label_col: str, prob_col: str) -> DataFrame:
    """One row per distinct score s: cumulative tp/fp for the rule ``p >= s``, tpr and fpr."""
    sc = score_counts(df, label_col, prob_col)
    cum = prefix_sum(sc, "score", ["pos", "neg"], descending=True)
    P, N = scalar_totals(sc, "pos", "neg")
    return cum.select(
        F.col("score").alias("threshold"),
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        _div(F.col("cum_pos").cast("double"), F.lit(float(P))).alias("tpr"),
        _div(F.col("cum_neg").cast("double"), F.lit(float(N))).alias("fpr"),
    )


def scalar_totals(df: DataFrame, *cols) -> tuple:
    """Column totals as driver scalars (one small job, one row back)."""
    row = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols]).first()
    return tuple(row[c] for c in cols)


def auc_exact(df: DataFrame, label_col: str, prob_col: str, by=()) -> DataFrame:
    """ROC AUC with ties counted half, one row for each ``by`` group; null when only one class is
    present. Products of counts are doubles: two long totals would overflow at scale."""
    by = list(by)
    sc = score_counts(df, label_col, prob_col, by)
    cum = prefix_sum(sc, "score", ["neg"], part_cols=by, inclusive=False)  # negatives strictly below
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    agg = cum.groupBy(*by).agg(F.sum(pos * (F.col("cum_neg") + 0.5 * neg)).alias("num"),
                               F.sum(pos).alias("P"), F.sum(neg).alias("N"))
    return agg.select(
        *by, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / (F.col("P") * F.col("N"))).alias("auc"),
        F.col("P").cast("long").alias("positives"), F.col("N").cast("long").alias("negatives"))


def average_precision(df: DataFrame, label_col: str, prob_col: str) -> DataFrame:
    """Step-wise average precision (sum over distinct thresholds of recall gain x precision)."""
    sc = score_counts(df, label_col, prob_col)
    cum = prefix_sum(sc, "score", ["pos", "neg"], descending=True)
    prec = F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg"))
    agg = cum.agg(F.sum(F.col("pos") * prec).alias("num"), F.sum("pos").alias("P"))
    return agg.select(F.when(F.col("P") > 0, F.col("num") / F.col("P")).alias("average_precision"))


def class_report(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """E5: per-class precision, recall, F1, support, plus macro and weighted averages."""
    y, p = F.col(label_col).cast("int"), _pred(pred_col)
    c = df.agg(*[F.count_if(cond).alias(name) for name, cond in (
        ("tp", (y == 1) & (p == 1)), ("fp", (y == 0) & (p == 1)),
        ("tn", (y == 0) & (p == 0)), ("fn", (y == 1) & (p == 0)))])
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))

    def per_class(cls, hit, false_pos, false_neg):
        pr, rc = _div(hit, hit + false_pos), _div(hit, hit + false_neg)
        return F.struct(F.lit(cls).alias("class"), pr.alias("precision"), rc.alias("recall"),
                        _div(2 * pr * rc, pr + rc).alias("f1"), (hit + false_neg).alias("support"))

    rows = c.select(per_class("0", tn, fn, fp).alias("c0"), per_class("1", tp, fp, fn).alias("c1"))
    n = F.col("c0.support") + F.col("c1.support")

    def avg(name, weighted):
        if weighted:
            return _div(F.col(f"c0.{name}") * F.col("c0.support") + F.col(f"c1.{name}") * F.col("c1.support"), n)
        return (F.col(f"c0.{name}") + F.col(f"c1.{name}")) / 2.0

    macro = F.struct(F.lit("macro avg").alias("class"), avg("precision", False).alias("precision"),
                     avg("recall", False).alias("recall"), avg("f1", False).alias("f1"), n.alias("support"))
    weighted = F.struct(F.lit("weighted avg").alias("class"), avg("precision", True).alias("precision"),
                        avg("recall", True).alias("recall"), avg("f1", True).alias("f1"), n.alias("support"))
    return (rows.select(F.explode(F.array("c0", "c1", macro, weighted)).alias("r"))
            .select("r.class", "r.precision", "r.recall", "r.f1", F.col("r.support").cast("long").alias("support")))


def weighted_f1(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """E6."""
    rep = class_report(df, label_col, pred_col)
    return rep.where(F.col("class") == "weighted avg").select(F.col("f1").alias("weighted_f1"))


def class_balance(df: DataFrame, pred_col: str) -> DataFrame:
    """Rows per predicted class and share."""
    counts = df.groupBy(F.col(pred_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    (total,) = scalar_totals(counts, "n")
    return counts.withColumn("share", _div(F.col("n").cast("double"), F.lit(float(total))))


def confidence_stats(df: DataFrame, label_col: str, prob_col: str, pred_col: str) -> DataFrame:
    """mean/median of |p-0.5| for wrong and right rows; rows with 0.45 < p < 0.55.

    The median is the exact distributed quantile (no per-group value buffer)."""
    from .stats import exact_quantiles
    p = F.col(prob_col)
    wrong = (F.col(pred_col).cast("int") != F.col(label_col).cast("int"))
    base = df.select(F.when(wrong, "wrong").otherwise("right").alias("outcome"),
                     F.abs(p - 0.5).alias("conf"), p.alias("p"))
    agg = (base.groupBy("outcome")
           .agg(F.count(F.lit(1)).alias("n"), F.avg("conf").alias("mean_confidence"),
                F.count_if((F.col("p") > 0.45) & (F.col("p") < 0.55)).alias("near_boundary")))
    med = (exact_quantiles(base, ["conf"], [0.5], by=["outcome"])
           .select("outcome", F.col("value").alias("median_confidence")))
    return agg.join(med, "outcome", "left").select("outcome", "n", "mean_confidence", "median_confidence",
                                                   "near_boundary")


def reliability_bins(df: DataFrame, label_col: str, prob_col: str, pred_col: str,
                     edges=None, close_last: bool = False) -> DataFrame:
    """Rows and errors per probability bin [lo, hi). p equal to the last edge is in no bin
    unless ``close_last``. Bins without rows are omitted."""
    if edges is None:
        edges = [i / 10 for i in range(11)]
    p = F.col(prob_col)
    idx = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        last = close_last and i == len(edges) - 2
        cond = (p >= lo) & ((p <= hi) if last else (p < hi))
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    wrong = (F.col(pred_col).cast("int") != F.col(label_col).cast("int"))
    lows = F.array(*[F.lit(float(e)) for e in edges[:-1]])
    highs = F.array(*[F.lit(float(e)) for e in edges[1:]])
    return (df.select(idx.alias("bin"), wrong.alias("wrong")).where(F.col("bin").isNotNull())
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.count_if("wrong").alias("errors"))
            .select("bin", F.element_at(lows, F.col("bin") + 1).alias("lo"),
                    F.element_at(highs, F.col("bin") + 1).alias("hi"), "n", "errors",
                    (F.col("errors") / F.col("n")).alias("error_rate")))


def compare_models(metric_frames: dict) -> DataFrame:
    """Union of per-model metric rows with a ``model`` column."""
    frames = [df.select(F.lit(name).alias("model"), "*") for name, df in metric_frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
