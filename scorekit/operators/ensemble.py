"""Ensembling, voting, weights and thresholds.

Prediction sets are handled in *long* form ``(id, model, ordinal, label|prob)``: unioning K sets
and shuffling once on ``id`` replaces a K-way join. Vote statistics reuse that id partitioning.
Threshold sweeps map every score to a grid index once (one pass), count ``(index, label)`` and
accumulate over the at most a few hundred grid rows.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import guard_union_partitioning, keep
from ..spec import q
from .metrics import _div, auc_exact, confusion_metrics, roc_points, scalar_totals
from .order import global_rank, session_bucket_rows
from .stats import exact_quantiles


# --- grids (driver-side, passed as literals to both engines) -----------------------------

def arange_grid(start: float, stop: float, step: float) -> list[float]:
    """Thresholds exactly as ``numpy.arange`` produces them (floating steps included)."""
    return [float(x) for x in np.arange(start, stop, step)]


def long_votes(wide: DataFrame, id_col: str, set_cols) -> DataFrame:
    """Wide prediction sets -> long ``(id, model, ordinal, label)``; ordinal is the list position."""
    set_cols = list(set_cols)
    ordinal = F.create_map(*[x for i, c in enumerate(set_cols) for x in (F.lit(c), F.lit(i + 1))])
    return (wide.unpivot([id_col], set_cols, "model", "label")
            .withColumnRenamed(id_col, "id")
            .select("id", "model", ordinal[F.col("model")].alias("ordinal"), "label"))


# --- probability blends (B1-B7) ------------------------------------------------------------

def blend_mean(long_probs: DataFrame, prob_col: str = "prob") -> DataFrame:
    """B1: equal-weight mean per id."""
    return long_probs.groupBy("id").agg(F.avg(prob_col).alias("prob"))


def blend_weighted(long_probs: DataFrame, weights: DataFrame, prob_col: str = "prob") -> DataFrame:
    """Weighted sum per id; ``weights`` is a small (model, weight) table joined by name."""
    w = F.broadcast(weights.select("model", "weight"))  # one row per model
    return (long_probs.join(w, "model").groupBy("id")
            .agg(F.sum(F.col(prob_col) * F.col("weight")).alias("prob")))


def fixed_weights(spark, weights: dict) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "model string, weight double")


def metric_share_weights(per_model: DataFrame, metric_col: str, mode: str = "share") -> DataFrame:
    """B3-B6 from a small per-model metric table.

    share: w = m / sum(m); excess: max(0, m - 0.5) / sum, equal when all are zero;
    squared: m^2 / sum(m^2).
    """
    m = F.col(metric_col)
    if mode == "share":
        raw = m
    elif mode == "excess":
        raw = F.greatest(m - 0.5, F.lit(0.0))
    elif mode == "squared":
        raw = m * m
    else:
        raise ValueError(mode)
    w = Window.partitionBy()  # per-model table: one row per model
    tot = F.sum("_raw").over(w)
    cnt = F.count(F.lit(1)).over(w)
    return (per_model.select("model", raw.alias("_raw"))
            .select("model", F.when(tot > 0, F.col("_raw") / tot).otherwise(1.0 / cnt).alias("weight")))


def per_model_auc(long_scored: DataFrame, label_col: str = "label", prob_col: str = "prob") -> DataFrame:
    """Exact AUC of every model in one grouped ordered pass (ties counted half; null for a model
    whose rows hold one class only)."""
    return auc_exact(long_scored, label_col, prob_col, by=["model"]).select("model", "auc")


def search_weights(oof_wide: DataFrame, label_col: str, model_cols, step: float = 0.05) -> DataFrame:
    """Simplex grid of weights (step), every candidate scored by exact AUC.

    Candidates are a small driver-built table; rows x candidates is the cost, so this is for a
    handful of models. Rows of equal scores count as one with their positives and negatives. Returns candidates ordered by
    AUC desc (ties: equal weights first)."""
    model_cols = list(model_cols)
    k = len(model_cols)
    units = int(round(1 / step))
    cands = []

    def rec(prefix, left):
        if len(prefix) == k - 1:
            cands.append(prefix + [left])
            return
        for u in range(left + 1):
            rec(prefix + [u], left - u)
    rec([], units)
    weights = [[u / units for u in c] for c in cands]
    y = F.col(label_col).cast("long")
    known = oof_wide.where(reduce(lambda a, b: a & b, [F.col(q(c)).isNotNull() for c in [label_col, *model_cols]]))
    counted = (known.groupBy(*[F.col(q(c)).cast("double").alias(f"m{i}") for i, c in enumerate(model_cols)])
               .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")))
    rows = [(cand, auc, weights[cand]) for cand, auc in _blend_aucs(counted, weights)]
    return oof_wide.sparkSession.createDataFrame(rows, "cand int, auc double, w array<double>").orderBy(F.col("auc").desc(), "cand")


_SCORES_AT_ONCE = 1 << 28  # blended scores in one shuffle
_RANGE_SCORES = 500_000


def _blend_aucs(counted: DataFrame, weights: list) -> list:
    """``[(number of the weights, exact AUC of the weighted sum)]`` over ``counted(m0.., pos, neg)``, none without rows.

    Blocks of rows are blended and sorted by every candidate, equal scores merged, and dealt to value ranges of the candidate
    as packed arrays; a range is merged and counted alone and then shifted by the negatives of the ranges below it. Candidates
    come in waves, so that a shuffle holds a bounded number of scores."""
    spark, k = counted.sparkSession, len(weights[0])
    guard_union_partitioning(spark)
    counted = keep(counted)
    n = counted.count()
    if not n:
        return []
    # the work is candidates x rows, so the number of tasks is not left to the coalescing of small partitions
    blocks = keep(counted.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / 250_000))))
    ranges = math.ceil(n / min(_RANGE_SCORES, session_bucket_rows()))
    cuts = [np.empty(0)] * len(weights)
    if ranges > 1:  # cut points are estimated; any cuts give the same sums
        some = blocks.select(*[f"m{i}" for i in range(k)]).sample(fraction=min(1.0, 256 * ranges / n), seed=1).toArrow()
        m = np.stack([some.column(i).to_numpy() for i in range(k)], axis=1)
        cuts = [_even_cuts(_blend(m, w), ranges) for w in weights]
    out = []
    step = max(1, _SCORES_AT_ONCE // n)
    for at in range(0, len(weights), step):
        sums = _range_sums(blocks, list(range(at, min(at + step, len(weights)))), weights, cuts)
        found: dict = {}
        for r in sums.orderBy("cand", "part").collect():  # a row for each candidate and range
            found.setdefault(r["cand"], []).append(r)
        for cand in sorted(found):
            num, pos, neg = 0.0, 0, 0
            for r in found[cand]:
                num += r["num"] + float(r["pos"]) * float(neg)
                pos, neg = pos + r["pos"], neg + r["neg"]
            out.append((cand, num / (float(pos) * float(neg)) if pos > 0 and neg > 0 else None))
    for df in (counted, blocks):
        df.unpersist()
    return out


def _blend(m: np.ndarray, w: list) -> np.ndarray:
    """Weighted sum of the columns of ``m``, added from the left."""
    with np.errstate(all="ignore"):
        return reduce(lambda a, b: a + b, [x * m[:, i] for i, x in enumerate(w)])


def _even_cuts(p: np.ndarray, ranges: int) -> np.ndarray:
    p = np.sort(p[np.isfinite(p)])
    return np.unique(p[len(p) * np.arange(1, ranges) // ranges]) if len(p) else p


def _merged(p: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple:
    """Distinct scores in order (NaN last, as one) with the sums of their counts."""
    order = np.argsort(p)
    p = p[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) & ~(np.isnan(p[1:]) & np.isnan(p[:-1]))
    first = np.flatnonzero(new)
    return p[first], np.add.reduceat(pos[order], first), np.add.reduceat(neg[order], first)


def _packed(n: np.ndarray) -> bytes:
    """Counts as single bytes where they are small, which they mostly are."""
    return (n.astype(np.uint8) if n.min() >= 0 and n.max() < 256 else n).tobytes()


def _unpacked(blob: bytes, size: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint8 if len(blob) == size else np.int64).astype(np.int64)


def _range_sums(blocks: DataFrame, cands: list, weights: list, cuts: list, block_rows: int = 1 << 17) -> DataFrame:
    """``(cand, part, num, pos, neg)``: of each value range its positives, its negatives, and the positives' negatives below
    inside the range, ties half."""
    k = len(weights[0])
    mine = {c: (weights[c], cuts[c]) for c in cands}

    def deal(batches):
        held, size = [], 0

        def flush():
            m, (pos, neg) = np.concatenate([h[:, :k] for h, _ in held]), np.concatenate([c for _, c in held], axis=1)
            for cand, (w, cut) in mine.items():
                p, a, b = _merged(_blend(m, w), pos, neg)
                ends = [0, *np.searchsorted(p, cut).tolist(), len(p)]
                got = [(j, slice(lo, hi)) for j, (lo, hi) in enumerate(zip(ends, ends[1:])) if hi > lo]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cand] * len(got), pa.int32()), pa.array([j for j, _ in got], pa.int32()), pa.array([p[x].tobytes() for _, x in got], pa.binary()),
                     pa.array([_packed(a[x]) for _, x in got], pa.binary()), pa.array([_packed(b[x]) for _, x in got], pa.binary())],
                    names=["cand", "part", "p", "pos", "neg"])

        for b in batches:
            if b.num_rows:
                cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(k + 2)]
                held.append((np.stack(cols[:k], axis=1), np.stack(cols[k:])))
                size += b.num_rows
            if size >= block_rows:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def add(table):
        ps = [np.frombuffer(x, np.float64) for x in table["p"].to_pylist()]
        pos, neg = (np.concatenate([_unpacked(x, len(p)) for x, p in zip(table[c].to_pylist(), ps)]) for c in ("pos", "neg"))
        _, pos, neg = _merged(np.concatenate(ps), pos, neg)
        below = np.cumsum(neg) - neg
        num = float((pos.astype(np.float64) * (below + 0.5 * neg)).sum())
        return pa.table({"cand": table["cand"][:1], "part": table["part"][:1], "num": [num], "pos": [int(pos.sum())], "neg": [int(neg.sum())]})

    dealt = blocks.mapInArrow(deal, "cand int, part int, p binary, pos binary, neg binary")
    return dealt.groupBy("cand", "part").applyInArrow(add, "cand int, part int, num double, pos bigint, neg bigint")


# --- votes (B8-B12) ------------------------------------------------------------------------

def hard_vote(long_votes_df: DataFrame, min_votes: int) -> DataFrame:
    """Label 1 when at least ``min_votes`` sets say 1."""
    return (long_votes_df.groupBy("id")
            .agg((F.sum(F.col("label").cast("int")) >= min_votes).cast("int").alias("label")))


def majority_vote(long_votes_df: DataFrame) -> DataFrame:
    """Most frequent label per id; a tie goes to the label seen first in list order.

    One shuffle: hash-partition on id, then both aggregations reuse that partitioning.
    """
    by_label = (long_votes_df.repartition("id").groupBy("id", "label")
                .agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first")))
    return by_label.groupBy("id").agg(F.max_by("label", _vote_key()).alias("label"))


# more votes wins, then the smaller first ordinal; one long key keeps the aggregate hash-based
# (a struct ordering key would force a sort aggregate)
_ORD_SPAN = 1 << 20  # prediction sets per vote, far above any real list


def _vote_key():
    return F.col("n").cast("long") * _ORD_SPAN + (_ORD_SPAN - F.col("first").cast("long"))


def vote_table(long_votes_df: DataFrame) -> DataFrame:
    """Per id: majority label, number of distinct labels, the vote pattern in list order.

    One shuffle: the votes of an id (one per prediction set, so a bounded array) are gathered by a
    single aggregation and everything else is computed on that small array."""
    g = long_votes_df.groupBy("id").agg(F.collect_list(F.struct("ordinal", "label")).alias("_v"))
    labels = F.array_distinct(F.transform("_v", lambda v: v["label"]))

    def of_label(lab):
        mine = F.filter("_v", lambda v: v["label"] == lab)
        return F.struct(F.size(mine).alias("n"), (-F.array_min(F.transform(mine, lambda v: v["ordinal"]))).alias("nf"),
                        lab.alias("label"))

    best = F.array_max(F.transform(labels, of_label))  # most votes, then the smallest first ordinal
    pattern = F.array_join(F.transform(F.array_sort("_v"), lambda v: v["label"].cast("string")), ",")
    return g.select("id", best["label"].alias("majority"), F.size(labels).alias("n_labels"), pattern.alias("pattern"))


def vote_summary(long_votes_df: DataFrame) -> DataFrame:
    """Rows, unanimous, disagreeing, positives of the majority."""
    vt = vote_table(long_votes_df)
    return vt.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("n_labels") == 1).alias("unanimous"),
                  F.count_if(F.col("n_labels") > 1).alias("disagreements"),
                  F.count_if(F.col("majority") == 1).alias("positives"))


def vote_agreement(long_votes_df: DataFrame) -> DataFrame:
    """Per prediction set, rows agreeing with the majority result and their share."""
    major = majority_vote(long_votes_df).withColumnRenamed("label", "majority")
    j = long_votes_df.repartition("id").join(major, "id")
    return (j.groupBy("model", "ordinal")
            .agg(F.count_if(F.col("label") == F.col("majority")).alias("agree"),
                 F.count(F.lit(1)).alias("n"))
            .withColumn("agree_share", F.col("agree") / F.col("n")))


def vote_patterns(long_votes_df: DataFrame, top: int = 5) -> DataFrame:
    """Patterns of disagreeing ids (labels in list order), their number and the top ones."""
    vt = vote_table(long_votes_df).where(F.col("n_labels") > 1)
    counts = keep(vt.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")))
    distinct = counts.count()
    first = counts.orderBy(F.col("n").desc(), "pattern").limit(top)  # TakeOrderedAndProject: no task sorts all patterns
    w = Window.orderBy(F.col("n").desc(), F.col("pattern"))  # over the top rows only
    return first.withColumn("rank", F.row_number().over(w)).withColumn("distinct_patterns", F.lit(distinct))


def agree_or(a: DataFrame, b: DataFrame, id_col: str, a_col: str, b_col: str, fallback: int) -> DataFrame:
    """Keep the label where both sets agree, else ``fallback`` (0 = AND, 1 = OR)."""
    j = (a.select(F.col(id_col).cast("string").alias(id_col), F.col(a_col).alias("_a"))
         .join(b.select(F.col(id_col).cast("string").alias(id_col), F.col(b_col).alias("_b")), id_col, "inner"))
    return j.select(id_col, F.when(F.col("_a") == F.col("_b"), F.col("_a"))
                    .otherwise(F.lit(fallback)).alias("label"))


# --- thresholds (B16-B22) ------------------------------------------------------------------

def apply_threshold(df: DataFrame, prob_col: str, thr, op: str = ">=", out_col: str = "pred") -> DataFrame:
    """B21."""
    t = thr if isinstance(thr, Column) else F.lit(float(thr))
    cond = F.col(prob_col) >= t if op == ">=" else F.col(prob_col) > t
    return df.withColumn(out_col, cond.cast("int"))


def _grid_index(prob: Column, grid, op: str) -> Column:
    """Number of grid thresholds t for which the row is predicted positive: a sum of plain
    comparisons against literals (codegen, no lambda over an array)."""
    hits = [F.when((F.lit(float(t)) <= prob) if op == ">=" else (F.lit(float(t)) < prob), F.lit(1)).otherwise(F.lit(0))
            for t in grid]
    return reduce(lambda a, b: a + b, hits)


def _grid_counts(df: DataFrame, prob_col: str, grid, op: str, label_col: str | None = None) -> dict:
    """One pass over the rows: counts per grid index (at most len(grid)+1 rows come back)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if label_col:
        y = F.col(label_col).cast("long")
        aggs = [F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")]
    rows = (df.where(F.col(prob_col).isNotNull())
            .groupBy(_grid_index(F.col(prob_col), grid, op).alias("idx")).agg(*aggs).collect())
    return {r["idx"]: r for r in rows}


def threshold_sweep(df: DataFrame, label_col: str, prob_col: str, grid, op: str = ">=") -> DataFrame:
    """Confusion counts, accuracy and F1 for every grid threshold from one pass over the rows.

    A row with grid index i is predicted positive for thresholds j < i; the per-index counts
    (bounded by the grid) are accumulated on the driver."""
    grid = [float(t) for t in grid]
    counts = _grid_counts(df, prob_col, grid, op, label_col)
    P = sum(r["pos"] for r in counts.values())
    N = sum(r["neg"] for r in counts.values())
    rows, le_pos, le_neg = [], 0, 0
    for j, t in enumerate(grid):
        r = counts.get(j)
        if r is not None:
            le_pos += r["pos"]
            le_neg += r["neg"]
        tp, fp, tn, fn = P - le_pos, N - le_neg, le_neg, le_pos
        prec = tp / (tp + fp) if tp + fp else 0.0
        rec = tp / (tp + fn) if tp + fn else 0.0
        acc = (tp + tn) / (tp + fp + tn + fn) if tp + fp + tn + fn else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        rows.append((j, t, tp, fp, tn, fn, acc, f1))
    return df.sparkSession.createDataFrame(
        rows, "j int, threshold double, tp long, fp long, tn long, fn long, accuracy double, f1 double")


def best_threshold(sweep: DataFrame, metric: str) -> DataFrame:
    """First grid threshold (lowest index) with the best value of ``metric``."""
    return sweep.agg(F.max_by(F.struct("threshold", metric), F.struct(F.col(metric), -F.col("j"))).alias("b")) \
        .select(F.col("b.threshold").alias("threshold"), F.col(f"b.{metric}").alias(metric))


def best_accuracy_threshold(df, label_col, prob_col, grid, op=">="):
    """B17."""
    return best_threshold(threshold_sweep(df, label_col, prob_col, grid, op), "accuracy")


def best_f1_threshold(df, label_col, prob_col, grid, op=">"):
    """B18."""
    return best_threshold(threshold_sweep(df, label_col, prob_col, grid, op), "f1")


def youden_threshold(df: DataFrame, label_col: str, prob_col: str, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Threshold maximising tpr - fpr (highest threshold on ties), clipped to [lo, hi].

    The ROC curve starts at (0, 0) with an infinite threshold: when no threshold gives
    tpr - fpr > 0 that start point wins and clips to ``hi``. No scores at all gives 0.5.
    """
    roc = roc_points(df, label_col, prob_col)
    best = roc.agg(F.max_by(F.struct("threshold", (F.col("tpr") - F.col("fpr")).alias("j")),
                            F.struct(F.col("tpr") - F.col("fpr"), F.col("threshold"))).alias("b"),
                   F.count(F.lit(1)).alias("n"))
    raw = (F.when(F.col("n") == 0, F.lit(0.5))
           .when(F.col("b.j") <= 0, F.lit(float("inf"))).otherwise(F.col("b.threshold")))
    return best.select(F.least(F.greatest(raw, F.lit(lo)), F.lit(hi)).alias("threshold"),
                       F.greatest(F.coalesce(F.col("b.j"), F.lit(0.0)), F.lit(0.0)).alias("youden_j"))


def threshold_table(df: DataFrame, prob_col: str, thresholds, base: float = 0.5, min_move: float = 0.5) -> DataFrame:
    """Per threshold (rule ``p > t``) positives, share in %, agreement with ``base`` in %,
    and whether the share moves by more than ``min_move`` points (one pass over the rows)."""
    grid = sorted(set([float(t) for t in thresholds] + [float(base)]))
    counts = _grid_counts(df, prob_col, grid, ">")
    n = sum(r["n"] for r in counts.values())
    pos, le = {}, 0
    for j, t in enumerate(grid):
        le += counts[j]["n"] if j in counts else 0
        pos[t] = n - le
    bp = pos[float(base)]
    rows = []
    for t in [float(x) for x in thresholds]:
        share = pos[t] * 100.0 / n if n else None
        base_share = bp * 100.0 / n if n else None
        agree = (n - abs(pos[t] - bp)) * 100.0 / n if n else None
        rows.append((t, pos[t], share, agree, int(share is not None and abs(share - base_share) > min_move)))
    return df.sparkSession.createDataFrame(
        rows, "threshold double, positives long, share_pct double, agreement_pct double, moves int")


def guard_degenerate(df: DataFrame, id_col: str, prob_col: str, thr: float, prevalence: float,
                     op: str = ">=") -> DataFrame:
    """If the cut gives all 0 or all 1, cut at the (1 - prevalence) quantile clipped into the
    score range; if still degenerate, label the round(prevalence * n) highest scores 1."""
    cmp = (lambda p, t: p >= t) if op == ">=" else (lambda p, t: p > t)
    stats = df.agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(cmp(F.col(prob_col), F.lit(float(thr)))).alias("pos"),
                   F.min(prob_col).alias("lo"), F.max(prob_col).alias("hi")).first()
    n, pos, lo, hi = stats["n"], stats["pos"], stats["lo"], stats["hi"]
    if n == 0 or 0 < pos < n:
        return df.select(id_col, cmp(F.col(prob_col), F.lit(float(thr))).cast("int").alias("label"))
    q = max(0.05, min(0.95, 1 - prevalence))
    qv = exact_quantiles(df.select(prob_col), [prob_col], [q]).first()["value"]
    thr2 = min(max(qv, lo + 1e-06), hi - 1e-06) if hi > lo else 0.5
    pos2 = df.where(F.col(prob_col) >= thr2).count()
    if 0 < pos2 < n:
        return df.select(id_col, (F.col(prob_col) >= F.lit(thr2)).cast("int").alias("label"))
    k = max(1, min(n - 1, int(round(prevalence * n))))
    ranked = global_rank(df.select(id_col, prob_col), prob_col, id_col, descending=True)
    return ranked.select(id_col, (F.col("rank") <= k).cast("int").alias("label"))


def exact_median(df: DataFrame, c: str) -> float | None:
    row = exact_quantiles(df.select(c), [c], [0.5]).first()
    return row["value"] if row else None


def guard_flat(df: DataFrame, prob_col: str, thr: float, eps: float = 1e-6) -> float:
    """The threshold, or the exact median where all scores lie within ``eps``."""
    r = df.agg(F.min(prob_col).alias("lo"), F.max(prob_col).alias("hi")).first()
    return exact_median(df, prob_col) if r["lo"] is not None and r["hi"] - r["lo"] < eps else thr


def guard_share(df: DataFrame, id_col: str, prob_col: str, thr: float, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Labels at the threshold; at the exact median where the positive share is outside low .. high."""
    p = F.col(prob_col)
    share = df.agg(F.avg((p >= F.lit(float(thr))).cast("double"))).first()[0]
    if share is not None and not low <= share <= high:
        thr = exact_median(df, prob_col)
    return df.select(id_col, (p >= F.lit(float(thr))).cast("int").alias("label"))


def publish_thresholds(df: DataFrame, id_col: str, prob_col: str, thresholds, path: str, op: str = ">"):
    """One prediction set per threshold, written partitioned by threshold."""
    arr = F.array(*[F.lit(float(t)) for t in thresholds])
    out = df.select(id_col, prob_col, F.explode(arr).alias("threshold"))
    cond = F.col(prob_col) > F.col("threshold") if op == ">" else F.col(prob_col) >= F.col("threshold")
    (out.select(id_col, cond.cast("int").alias("label"), "threshold")
     .write.mode("overwrite").partitionBy("threshold").parquet(path))
    return path
