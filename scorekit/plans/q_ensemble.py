"""Queries: prediction-set voting, blends, thresholds (B*) and the metrics on them (E*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ensemble as ens
from ..operators import metrics as met
from . import frames as fr
from .registry import register

# fixed values: threshold grids of the reference, generated as numpy.arange/linspace generates them
ACC_GRID = ens.arange_grid(0.35, 0.65, 0.01)     # accuracy sweep, rule p >= t
F1_GRID = ens.arange_grid(0.05, 0.95, 0.01)      # F1 sweep, rule p > t
TABLE_THRESHOLDS = [0.4, 0.42, 0.44, 0.46, 0.48, 0.5, 0.52, 0.54, 0.56, 0.58, 0.6]  # rule p > t


def sql_grid(grid) -> str:
    rows = ", ".join(f"({i}, CAST('{t!r}' AS DOUBLE))" for i, t in enumerate(grid))
    return f"(VALUES {rows}) AS g(j, threshold)"


def _long_votes(spark, sf):
    return ens.long_votes(fr.votes(spark, sf), "id", fr.VOTE_SETS)


W_VOTES = f"WITH votes AS ({fr.VOTES_SQL}),\nlv AS ({fr.LONG_VOTES_SQL}),\n"
MAJ_SQL = W_VOTES + """c AS (SELECT id, label, count(*) AS n, min(ordinal) AS first_ord FROM lv GROUP BY id, label),
r AS (SELECT id, label, count(*) OVER (PARTITION BY id) AS n_labels,
             row_number() OVER (PARTITION BY id ORDER BY n DESC, first_ord ASC) AS rn FROM c),
maj AS (SELECT id, label AS majority, n_labels FROM r WHERE rn = 1)
"""


@register("vote_majority", "id bigint, label bigint",
          MAJ_SQL + "SELECT id, majority AS label FROM maj", ops=("B9",))
def q_vote_majority(spark, sf):
    return ens.majority_vote(_long_votes(spark, sf))


@register("vote_summary", "n bigint, unanimous bigint, disagreements bigint, positives bigint",
          MAJ_SQL + """SELECT count(*) AS n, count(*) FILTER (WHERE n_labels = 1) AS unanimous,
  count(*) FILTER (WHERE n_labels > 1) AS disagreements, count(*) FILTER (WHERE majority = 1) AS positives
FROM maj""", ops=("B10",))
def q_vote_summary(spark, sf):
    return ens.vote_summary(_long_votes(spark, sf))


@register("vote_agreement", "model string, ordinal bigint, agree bigint, n bigint, agree_share double",
          MAJ_SQL + """SELECT lv.model, lv.ordinal, count(*) FILTER (WHERE lv.label = maj.majority) AS agree,
  count(*) AS n, count(*) FILTER (WHERE lv.label = maj.majority) / count(*) AS agree_share
FROM lv JOIN maj ON lv.id = maj.id GROUP BY lv.model, lv.ordinal""", ops=("B10",))
def q_vote_agreement(spark, sf):
    return ens.vote_agreement(_long_votes(spark, sf))


@register("vote_patterns", "pattern string, n bigint, rank bigint, distinct_patterns bigint",
          MAJ_SQL + """, pat AS (SELECT lv.id, string_agg(CAST(lv.label AS VARCHAR), ',' ORDER BY lv.ordinal) AS pattern
  FROM lv GROUP BY lv.id),
pc AS (SELECT pattern, count(*) AS n FROM pat JOIN maj ON pat.id = maj.id WHERE maj.n_labels > 1 GROUP BY pattern),
rk AS (SELECT pattern, n, row_number() OVER (ORDER BY n DESC, pattern) AS rank,
  count(*) OVER () AS distinct_patterns FROM pc)
SELECT * FROM rk WHERE rank <= 5""", ops=("B11",))
def q_vote_patterns(spark, sf):
    return ens.vote_patterns(_long_votes(spark, sf), top=5)


@register("vote_hard_2of3", "id bigint, label bigint",
          f"WITH votes AS ({fr.VOTES_SQL}) SELECT id, CAST(v1 + v2 + v3 >= 2 AS INTEGER) AS label FROM votes",
          ops=("B8",))
def q_vote_hard(spark, sf):
    lv = _long_votes(spark, sf).where(F.col("model").isin("v1", "v2", "v3"))
    return ens.hard_vote(lv, 2)


def _agree(fallback):
    def build(spark, sf):
        v = fr.votes(spark, sf)
        return ens.agree_or(v.select("id", "v1"), v.select("id", "v3"), "id", "v1", "v3", fallback)
    return build


for _fb, _nm in ((0, "agree_or_and"), (1, "agree_or_or")):
    register(_nm, "id string, label bigint",
             f"WITH votes AS ({fr.VOTES_SQL}) SELECT CAST(id AS VARCHAR) AS id, "
             f"CASE WHEN v1 = v3 THEN v1 ELSE {_fb} END AS label FROM votes", ops=("B12", "J2", "F10"))(_agree(_fb))

# --- confusion metrics of the majority vote against the label ------------------------------

CONF_COUNTS = """SELECT count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn FROM scored"""

CONF_METRICS_SQL = """, cc AS (""" + CONF_COUNTS + """),
d AS (SELECT tp, fp, tn, fn, CAST(tp AS DOUBLE) AS dtp, CAST(fp AS DOUBLE) AS dfp, CAST(tn AS DOUBLE) AS dtn,
  CAST(fn AS DOUBLE) AS dfn FROM cc),
m AS (SELECT *, dtp + dfp + dtn + dfn AS n,
  CASE WHEN dtp + dfp = 0 THEN 0.0 ELSE dtp / (dtp + dfp) END AS prec,
  CASE WHEN dtp + dfn = 0 THEN 0.0 ELSE dtp / (dtp + dfn) END AS rec FROM d),
m2 AS (SELECT *, CASE WHEN n = 0 THEN 0.0 ELSE (dtp + dtn) / n END AS acc,
  CASE WHEN n = 0 THEN 0.0 ELSE ((dtp + dfp) * (dtp + dfn) + (dtn + dfn) * (dtn + dfp)) / (n * n) END AS pe FROM m)
SELECT tp, fp, tn, fn, acc AS accuracy, prec AS precision, rec AS recall,
  CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END AS f1,
  CASE WHEN dtn + dfp = 0 THEN 0.0 ELSE dtn / (dtn + dfp) END AS specificity,
  CASE WHEN dtn + dfn = 0 THEN 0.0 ELSE dtn / (dtn + dfn) END AS npv,
  CASE WHEN (dtp + dfp) * (dtp + dfn) * (dtn + dfp) * (dtn + dfn) = 0 THEN 0.0
       ELSE (dtp * dtn - dfp * dfn) / sqrt((dtp + dfp) * (dtp + dfn) * (dtn + dfp) * (dtn + dfn)) END AS mcc,
  CASE WHEN pe >= 1 THEN 0.0 ELSE (acc - pe) / (1 - pe) END AS kappa
FROM m2"""

MAJ_SCORED = MAJ_SQL + ", scored AS (SELECT votes.id, votes.y, maj.majority AS pred FROM votes JOIN maj ON votes.id = maj.id)\n"


def _majority_scored(spark, sf):
    v = fr.votes(spark, sf)
    maj = ens.majority_vote(ens.long_votes(v, "id", fr.VOTE_SETS)).withColumnRenamed("label", "pred")
    return v.select("id", "y").join(maj, "id")


@register("confusion_metrics", "tp bigint, fp bigint, tn bigint, fn bigint, accuracy double, precision double, "
          "recall double, f1 double, specificity double, npv double, mcc double, kappa double",
          MAJ_SCORED.rstrip() + CONF_METRICS_SQL, ops=("E1",))
def q_confusion(spark, sf):
    return met.confusion_metrics(_majority_scored(spark, sf), "y", "pred")


@register("error_counts", "n bigint, errors bigint, fp bigint, fn bigint, error_rate double, fp_rate double, fn_rate double",
          MAJ_SCORED + ", cc AS (" + CONF_COUNTS + """)
SELECT tp + fp + tn + fn AS n, fp + fn AS errors, fp, fn, (fp + fn) / (tp + fp + tn + fn) AS error_rate,
  fp / (tp + fp + tn + fn) AS fp_rate, fn / (tp + fp + tn + fn) AS fn_rate FROM cc""", ops=("E8",))
def q_error_counts(spark, sf):
    return met.error_counts(_majority_scored(spark, sf), "y", "pred")


@register("class_balance", "label bigint, n bigint, share double",
          MAJ_SQL + "SELECT majority AS label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM maj GROUP BY majority",
          ops=("E7", "A1"))
def q_class_balance(spark, sf):
    return met.class_balance(ens.majority_vote(_long_votes(spark, sf)), "label")


# --- score-based metrics on the events score ------------------------------------------------

W_SCORES = f"WITH s AS ({fr.SCORES_SQL}),\nc AS (SELECT p AS score, sum(y) AS pos, sum(1 - y) AS neg FROM s WHERE p IS NOT NULL GROUP BY p)\n"


@register("auc_exact", "auc double, positives bigint, negatives bigint",
          W_SCORES + """, w AS (SELECT score, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
  coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc,
  sum(pos) AS positives, sum(neg) AS negatives FROM w""", ops=("E2", "W1"))
def q_auc(spark, sf):
    return met.auc_exact(fr.scores(spark, sf), "y", "p")


@register("average_precision", "average_precision double",
          W_SCORES + """, w AS (SELECT score, pos, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM c)
SELECT sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / sum(pos) AS average_precision FROM w""", ops=("E3",))
def q_ap(spark, sf):
    return met.average_precision(fr.scores(spark, sf), "y", "p")


@register("roc_points", "threshold double, tp bigint, fp bigint, tpr double, fpr double",
          W_SCORES + """, w AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
  sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM c)
SELECT score AS threshold, tp, fp, CAST(tp AS DOUBLE) / P AS tpr, CAST(fp AS DOUBLE) / N AS fpr FROM w""", ops=("E4", "W1"))
def q_roc(spark, sf):
    return met.roc_points(fr.scores(spark, sf), "y", "p")


SCORED_05 = f"WITH s AS ({fr.SCORES_SQL}),\nscored AS (SELECT id, y, p, CAST(p >= 0.5 AS INTEGER) AS pred FROM s)\n"


def _scored05(spark, sf):
    return ens.apply_threshold(fr.scores(spark, sf), "p", 0.5, ">=")


@register("class_report", "class string, precision double, recall double, f1 double, support bigint",
          SCORED_05 + ", cc AS (" + CONF_COUNTS + """),
d AS (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn, CAST(fn AS DOUBLE) AS fn FROM cc),
pc AS (SELECT '0' AS class, CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS precision,
         CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS recall, tn + fp AS support FROM d
       UNION ALL
       SELECT '1', CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, tp + fn FROM d),
pf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc)
SELECT class, precision, recall, f1, support FROM pf
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM pf
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM pf""", ops=("E5",))
def q_class_report(spark, sf):
    return met.class_report(_scored05(spark, sf), "y", "pred")


@register("weighted_f1", "weighted_f1 double",
          SCORED_05 + ", cc AS (" + CONF_COUNTS + """),
d AS (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(tn AS DOUBLE) AS tn, CAST(fn AS DOUBLE) AS fn FROM cc),
pc AS (SELECT CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS pr, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS rc, tn + fp AS sup FROM d
       UNION ALL SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, tp + fn FROM d)
SELECT sum(CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END * sup) / sum(sup) AS weighted_f1 FROM pc""",
          ops=("E6",))
def q_weighted_f1(spark, sf):
    return met.weighted_f1(_scored05(spark, sf), "y", "pred")


@register("confidence_stats", "outcome string, n bigint, mean_confidence double, median_confidence double, near_boundary bigint",
          SCORED_05 + """SELECT CASE WHEN pred <> y THEN 'wrong' ELSE 'right' END AS outcome, count(*) AS n,
  avg(abs(p - 0.5)) AS mean_confidence, quantile_cont(abs(p - 0.5), 0.5) AS median_confidence,
  count(*) FILTER (WHERE p > 0.45 AND p < 0.55) AS near_boundary
FROM scored GROUP BY 1""", ops=("E9",))
def q_confidence(spark, sf):
    return met.confidence_stats(_scored05(spark, sf), "y", "p", "pred")


@register("reliability_bins", "bin bigint, lo double, hi double, n bigint, errors bigint, error_rate double",
          SCORED_05 + ", b AS (SELECT CASE " + " ".join(
              f"WHEN p >= {i / 10!r} AND p < {(i + 1) / 10!r} THEN {i}" for i in range(10)) +
          """ END AS bin, pred <> y AS wrong FROM scored)
SELECT bin, CAST(bin AS DOUBLE) / 10 AS lo, CAST(bin + 1 AS DOUBLE) / 10 AS hi, count(*) AS n, count(*) FILTER (WHERE wrong) AS errors,
  count(*) FILTER (WHERE wrong) / count(*) AS error_rate FROM b WHERE bin IS NOT NULL GROUP BY bin""", ops=("E10",))
def q_reliability(spark, sf):
    return met.reliability_bins(_scored05(spark, sf), "y", "p", "pred")


# --- thresholds ------------------------------------------------------------------------------

def _sweep_sql(grid, op):
    return f"WITH s AS ({fr.SCORES_SQL}),\ng AS (SELECT * FROM {sql_grid(grid)}),\n" + f"""cc AS (SELECT g.j, g.threshold,
  count(*) FILTER (WHERE s.p {op} g.threshold AND s.y = 1) AS tp, count(*) FILTER (WHERE s.p {op} g.threshold AND s.y = 0) AS fp,
  count(*) FILTER (WHERE NOT (s.p {op} g.threshold) AND s.y = 0) AS tn, count(*) FILTER (WHERE NOT (s.p {op} g.threshold) AND s.y = 1) AS fn
  FROM g, s WHERE s.p IS NOT NULL GROUP BY g.j, g.threshold),
m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS pr,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS rc FROM cc),
sw AS (SELECT j, threshold, tp, fp, tn, fn, CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) AS accuracy,
  CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END AS f1 FROM m)
"""


@register("threshold_sweep_accuracy", "threshold double, tp bigint, fp bigint, tn bigint, fn bigint, accuracy double, f1 double",
          _sweep_sql(ACC_GRID, ">=") + "SELECT threshold, tp, fp, tn, fn, accuracy, f1 FROM sw", ops=("B17",))
def q_sweep_acc(spark, sf):
    return ens.threshold_sweep(fr.scores(spark, sf), "y", "p", ACC_GRID, ">=")


@register("best_accuracy_threshold", "threshold double, accuracy double",
          _sweep_sql(ACC_GRID, ">=") + "SELECT threshold, accuracy FROM sw ORDER BY accuracy DESC, j LIMIT 1", ops=("B17",))
def q_best_acc(spark, sf):
    return ens.best_accuracy_threshold(fr.scores(spark, sf), "y", "p", ACC_GRID, ">=")


@register("best_f1_threshold", "threshold double, f1 double",
          _sweep_sql(F1_GRID, ">") + "SELECT threshold, f1 FROM sw ORDER BY f1 DESC, j LIMIT 1", ops=("B18",))
def q_best_f1(spark, sf):
    return ens.best_f1_threshold(fr.scores(spark, sf), "y", "p", F1_GRID, ">")


@register("youden_threshold", "threshold double, youden_j double",
          W_SCORES + """, w AS (SELECT score, CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) / sum(pos) OVER () -
  CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) / sum(neg) OVER () AS j FROM c),
b AS (SELECT score, j FROM w ORDER BY j DESC, score DESC LIMIT 1)
SELECT least(greatest(CASE WHEN j <= 0 THEN 0.95 ELSE score END, 0.05), 0.95) AS threshold, greatest(j, 0.0) AS youden_j FROM b""",
          ops=("B16",))
def q_youden(spark, sf):
    return ens.youden_threshold(fr.scores(spark, sf), "y", "p")


@register("threshold_table", "threshold double, positives bigint, share_pct double, agreement_pct double, moves bigint",
          f"WITH s AS ({fr.SCORES_SQL}),\ng AS (SELECT * FROM {sql_grid(TABLE_THRESHOLDS)}),\n" + """b AS (SELECT count(*) FILTER (WHERE p > 0.5) AS bp, count(*) AS n FROM s WHERE p IS NOT NULL),
t AS (SELECT g.threshold, count(*) FILTER (WHERE s.p > g.threshold) AS positives,
  count(*) FILTER (WHERE (s.p > g.threshold) = (s.p > 0.5)) AS agree FROM g, s WHERE s.p IS NOT NULL GROUP BY g.threshold)
SELECT t.threshold, t.positives, t.positives * 100.0 / b.n AS share_pct, t.agree * 100.0 / b.n AS agreement_pct,
  CAST(abs(t.positives * 100.0 / b.n - b.bp * 100.0 / b.n) > 0.5 AS INTEGER) AS moves FROM t, b""", ops=("B19",))
def q_threshold_table(spark, sf):
    return ens.threshold_table(fr.scores(spark, sf), "p", TABLE_THRESHOLDS)


@register("apply_threshold", "id bigint, pred bigint",
          f"WITH s AS ({fr.SCORES_SQL}) SELECT id, CAST(p > 0.3 AS INTEGER) AS pred FROM s", ops=("B21",))
def q_apply_threshold(spark, sf):
    return ens.apply_threshold(fr.scores(spark, sf), "p", 0.3, ">").select("id", "pred")
