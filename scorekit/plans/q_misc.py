"""Queries: reconciliation, joins and set operations, blends, selection, splits (R*, J*, U*, B1-B6, X*, K1, K2, K8, K10, M13)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import crossfit as cf
from ..operators import ensemble as ens
from ..operators import joins as jn
from ..operators import metrics as met
from ..operators import models as mdl
from ..operators import profile as pr
from ..operators import reconcile as rc
from ..operators import select as sel
from ..sources import io
from . import frames as fr
from .registry import register

W_VERS = f"WITH o AS ({fr.VERSIONS_OLD_SQL}), n AS ({fr.VERSIONS_NEW_SQL})\n"


@register("id_differences", "id bigint, change string",
          W_VERS + "SELECT id, 'removed' AS change FROM (SELECT DISTINCT id FROM o EXCEPT SELECT DISTINCT id FROM n) "
          "UNION ALL SELECT id, 'added' FROM (SELECT DISTINCT id FROM n EXCEPT SELECT DISTINCT id FROM o)", ops=("J6", "U3"))
def q_id_diff(spark, sf):
    old, new = fr.versions(spark, sf)
    return rc.id_differences(old, new, "id")


@register("compare_versions", "table string, old_rows bigint, old_unique bigint, new_rows bigint, new_unique bigint, "
          "removed bigint, removed_examples string, added bigint, added_examples string",
          W_VERS + """, r AS (SELECT id FROM o EXCEPT SELECT id FROM n), a AS (SELECT id FROM n EXCEPT SELECT id FROM o)
SELECT 'orders' AS "table", (SELECT count(*) FROM o) AS old_rows, (SELECT count(DISTINCT id) FROM o) AS old_unique,
  (SELECT count(*) FROM n) AS new_rows, (SELECT count(DISTINCT id) FROM n) AS new_unique,
  (SELECT count(*) FROM r) AS removed, (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM (SELECT id FROM r ORDER BY id LIMIT 5)) AS removed_examples,
  (SELECT count(*) FROM a) AS added, (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM (SELECT id FROM a ORDER BY id LIMIT 5)) AS added_examples""",
          ops=("R1",))
def q_compare_versions(spark, sf):
    old, new = fr.versions(spark, sf)
    return rc.compare_versions({"orders": old}, {"orders": new}, "id")


@register("validate_predictions", "missing bigint, missing_examples string, extra bigint, extra_examples string, "
          "duplicated bigint, verdict string",
          W_VERS + """, m AS (SELECT id FROM n EXCEPT SELECT id FROM o), e AS (SELECT id FROM o EXCEPT SELECT id FROM n),
d AS (SELECT count(*) AS duplicated FROM (SELECT id FROM o GROUP BY id HAVING count(*) > 1))
SELECT (SELECT count(*) FROM m) AS missing, (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM (SELECT id FROM m ORDER BY id LIMIT 10)) AS missing_examples,
  (SELECT count(*) FROM e) AS extra, (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM (SELECT id FROM e ORDER BY id LIMIT 10)) AS extra_examples,
  duplicated, CASE WHEN (SELECT count(*) FROM m) = 0 AND (SELECT count(*) FROM e) = 0 AND duplicated = 0 THEN 'ok' ELSE 'changed' END AS verdict
FROM d""", ops=("R2",))
def q_validate(spark, sf):
    old, new = fr.versions(spark, sf)
    return rc.validate_predictions(old, new, "id")


@register("left_attach", "id bigint, label bigint",
          W_VERS + f", v AS ({fr.VOTES_SQL}) SELECT n.id, v.v1 AS label FROM n LEFT JOIN (SELECT * FROM v WHERE id % 17 <> 0) v ON n.id = v.id",
          ops=("J1", "J9"))
def q_left_attach(spark, sf):
    old, new = fr.versions(spark, sf)
    preds = fr.votes(spark, sf).where(F.col("id") % 17 != 0).select("id", F.col("v1").alias("label"))
    return jn.left_attach(new, preds, "id")


@register("same_ids_check", "name string, rows bigint, missing bigint, extra bigint, moved bigint",
          W_VERS + """SELECT 'old' AS name, (SELECT count(*) FROM o) AS rows, 0 AS missing, 0 AS extra, 0 AS moved
UNION ALL SELECT 'new', (SELECT count(*) FROM n), (SELECT count(*) FROM (SELECT id FROM o EXCEPT SELECT id FROM n)),
  (SELECT count(*) FROM (SELECT id FROM n EXCEPT SELECT id FROM o)), 0""", ops=("U5",))
def q_same_ids(spark, sf):
    old, new = fr.versions(spark, sf)
    return jn.check_same_ids({"old": old, "new": new}, "id")


@register("union_with_origin", "origin bigint, n bigint, ids bigint",
          f"WITH c AS ({fr.CARDIO_SQL}), h AS ({fr.HEART_SQL}) SELECT origin, count(*) AS n, count(DISTINCT id) AS ids FROM "
          "(SELECT id, 0 AS origin FROM c UNION ALL SELECT id, 1 FROM h) GROUP BY origin", ops=("U1", "U2"))
def q_union_origin(spark, sf):
    u = jn.union_with_origin(fr.cardio(spark, sf), fr.heart(spark, sf))
    return u.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


@register("pseudo_label", "id bigint, y bigint, pseudo bigint",
          f"WITH votes AS ({fr.VOTES_SQL}),\nlv AS ({fr.LONG_VOTES_SQL}),\n" + """c AS (SELECT id, label, count(*) AS n, min(ordinal) AS f FROM lv GROUP BY id, label),
maj AS (SELECT id, label FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, f) AS rn FROM c) WHERE rn = 1)
SELECT id, y, 0 AS pseudo FROM votes WHERE id % 17 <> 0
UNION ALL SELECT votes.id, maj.label, 1 FROM votes JOIN maj ON votes.id = maj.id WHERE votes.id % 17 = 0""", ops=("K10", "J9", "U1"))
def q_pseudo(spark, sf):
    v = fr.votes(spark, sf)
    train = v.where(F.col("id") % 17 != 0).select("id", "y").withColumn("pseudo", F.lit(0))
    score = v.where(F.col("id") % 17 == 0).select("id")
    preds = ens.majority_vote(ens.long_votes(v, "id", fr.VOTE_SETS))
    out = cf.pseudo_label(train.drop("pseudo"), score, preds, "id", "y")
    return out.join(train.select("id", "pseudo"), "id", "left").select("id", "y", F.coalesce("pseudo", F.lit(1)).alias("pseudo"))


@register("misclassified", "id bigint, true_label bigint, predicted_label bigint, prediction_prob double",
          f"WITH s AS ({fr.SCORES_SQL}) SELECT id, y AS true_label, CAST(p > 0.5 AS INTEGER) AS predicted_label, p AS prediction_prob "
          "FROM s WHERE y <> CAST(p > 0.5 AS INTEGER)", ops=("IO9",))
def q_misclassified(spark, sf):
    s = ens.apply_threshold(fr.scores(spark, sf), "p", 0.5, ">")
    return io.misclassified(s, "id", "y", "pred", "p")


# --- folds, holdout, samples, class weights -----------------------------------------------

W_CARDIO = f"WITH t AS ({fr.CARDIO_SQL})\n"
RN = "row_number() OVER (PARTITION BY cardio ORDER BY md5('{seed}:' || CAST(id AS VARCHAR)), id)"


@register("stratified_folds", "id bigint, cardio bigint, fold bigint",
          W_CARDIO + f"SELECT id, cardio, ({RN.format(seed=42)} - 1) % 5 AS fold FROM t", ops=("K2", "W3", "W1"))
def q_folds(spark, sf):
    return cf.stratified_folds(fr.cardio(spark, sf).select("id", "cardio"), "id", "cardio", 5, seed=42)


@register("stratified_holdout", "id bigint, cardio bigint, is_valid bigint",
          W_CARDIO + f"SELECT id, cardio, CAST({RN.format(seed=42)} <= ceil(count(*) OVER (PARTITION BY cardio) * 0.2) AS INTEGER) AS is_valid FROM t",
          ops=("K1",))
def q_holdout(spark, sf):
    return cf.stratified_holdout(fr.cardio(spark, sf).select("id", "cardio"), "id", "cardio", 0.2, seed=42)


@register("hash_sample", "id bigint, cardio bigint",
          W_CARDIO + "SELECT id, cardio FROM t ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 1000", ops=("K8",))
def q_hash_sample(spark, sf):
    return cf.hash_sample(fr.cardio(spark, sf).select("id", "cardio"), "id", 1000, seed=42)


@register("class_weights", "id bigint, weight double",
          W_CARDIO + "SELECT id, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY cardio)) AS weight FROM t", ops=("M13",))
def q_class_weights(spark, sf):
    return mdl.class_weights(fr.cardio(spark, sf).select("id", "cardio"), "cardio").select("id", "weight")


@register("fold_class_balance", "fold bigint, cardio bigint, n bigint",
          W_CARDIO + f", f AS (SELECT cardio, ({RN.format(seed=42)} - 1) % 5 AS fold FROM t) SELECT fold, cardio, count(*) AS n FROM f GROUP BY 1, 2",
          ops=("K2",))
def q_fold_balance(spark, sf):
    f = cf.stratified_folds(fr.cardio(spark, sf).select("id", "cardio"), "id", "cardio", 5, seed=42)
    return f.groupBy("fold", "cardio").agg(F.count(F.lit(1)).alias("n"))


# --- blends and weights of three score columns ----------------------------------------------

PROB_MODELS = {"m1": "value / (value + 35.0)", "m2": "value / (value + 80.0)", "m3": "CAST(event_id % 97 AS DOUBLE) / 97.0"}


def long_probs(spark, sf) -> DataFrame:
    e = fr.table(spark, sf, "events")
    y = F.col("event_type").isin("purchase", "signup").cast("int")
    parts = [e.select(F.col("event_id").alias("id"), F.lit(m).alias("model"), F.expr(x).alias("prob"), y.alias("label"))
             for m, x in PROB_MODELS.items()]
    return reduce(DataFrame.unionByName, parts)


LP_SQL = "WITH lp AS (" + " UNION ALL ".join(
    f"SELECT event_id AS id, '{m}' AS model, {x} AS prob, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS label FROM events"
    for m, x in PROB_MODELS.items()) + ")\n"
AUC_BY_MODEL = """, c AS (SELECT model, prob AS score, sum(label) AS pos, sum(1 - label) AS neg FROM lp GROUP BY model, prob),
w AS (SELECT model, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
  coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
auc AS (SELECT model, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM w GROUP BY model)
"""


@register("blend_mean", "id bigint, prob double", LP_SQL + "SELECT id, avg(prob) AS prob FROM lp GROUP BY id", ops=("B1",))
def q_blend_mean(spark, sf):
    return ens.blend_mean(long_probs(spark, sf))


@register("blend_fixed", "id bigint, prob double",
          LP_SQL + "SELECT id, sum(prob * CASE model WHEN 'm1' THEN 0.33 WHEN 'm2' THEN 0.33 ELSE 0.34 END) AS prob FROM lp GROUP BY id",
          ops=("B2",))
def q_blend_fixed(spark, sf):
    return ens.blend_weighted(long_probs(spark, sf), ens.fixed_weights(spark, {"m1": 0.33, "m2": 0.33, "m3": 0.34}))


@register("model_auc", "model string, auc double", LP_SQL + AUC_BY_MODEL + "SELECT * FROM auc", ops=("E2",))
def q_model_auc(spark, sf):
    return ens.per_model_auc(long_probs(spark, sf))


@register("weights_auc_share", "model string, weight double",
          LP_SQL + AUC_BY_MODEL + "SELECT model, auc / sum(auc) OVER () AS weight FROM auc", ops=("B3",))
def q_w_share(spark, sf):
    return ens.metric_share_weights(ens.per_model_auc(long_probs(spark, sf)), "auc", "share")


@register("weights_excess_auc", "model string, weight double",
          LP_SQL + AUC_BY_MODEL + """, e AS (SELECT model, greatest(auc - 0.5, 0.0) AS x FROM auc)
SELECT model, CASE WHEN sum(x) OVER () > 0 THEN x / sum(x) OVER () ELSE 1.0 / count(*) OVER () END AS weight FROM e""", ops=("B5",))
def q_w_excess(spark, sf):
    return ens.metric_share_weights(ens.per_model_auc(long_probs(spark, sf)), "auc", "excess")


F1_BY_MODEL = """, cc AS (SELECT model, count(*) FILTER (WHERE label = 1 AND prob >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND prob >= 0.5) AS fp,
  count(*) FILTER (WHERE label = 1 AND prob < 0.5) AS fn, count(*) FILTER (WHERE label = 0 AND prob < 0.5) AS tn FROM lp GROUP BY model),
f AS (SELECT model, CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
  CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS acc FROM cc)
"""


def _per_model(spark, sf, metric):
    lp = ens.apply_threshold(long_probs(spark, sf), "prob", 0.5, ">=")
    return met.confusion_metrics(lp, "label", "pred", by=["model"]).select("model", metric)


@register("weights_squared_f1", "model string, weight double",
          LP_SQL + F1_BY_MODEL + "SELECT model, f1 * f1 / sum(f1 * f1) OVER () AS weight FROM f", ops=("B6", "E1"))
def q_w_f1(spark, sf):
    return ens.metric_share_weights(_per_model(spark, sf, "f1"), "f1", "squared")


@register("weights_accuracy_share", "model string, weight double",
          LP_SQL + F1_BY_MODEL + "SELECT model, acc / sum(acc) OVER () AS weight FROM f", ops=("B4",))
def q_w_acc(spark, sf):
    return ens.metric_share_weights(_per_model(spark, sf, "accuracy"), "accuracy", "share")


@register("blend_auc_weighted", "id bigint, prob double",
          LP_SQL + AUC_BY_MODEL + ", wt AS (SELECT model, auc / sum(auc) OVER () AS weight FROM auc)\n"
          "SELECT id, sum(prob * weight) AS prob FROM lp JOIN wt USING (model) GROUP BY id", ops=("B3", "B2"))
def q_blend_auc(spark, sf):
    lp = long_probs(spark, sf)
    return ens.blend_weighted(lp, ens.metric_share_weights(ens.per_model_auc(lp), "auc", "share"))


def _simplex(k, units):
    out = []

    def rec(prefix, left):
        if len(prefix) == k - 1:
            out.append(prefix + [left])
            return
        for u in range(left + 1):
            rec(prefix + [u], left - u)
    rec([], units)
    return out


_CANDS = _simplex(3, 20)
SEARCH_SQL = LP_SQL + ", wide AS (SELECT id, max(label) AS y, max(prob) FILTER (WHERE model = 'm1') AS m1, " \
    "max(prob) FILTER (WHERE model = 'm2') AS m2, max(prob) FILTER (WHERE model = 'm3') AS m3 FROM lp GROUP BY id),\n" \
    "cands AS (SELECT * FROM (VALUES " + ", ".join(
        f"({i}, CAST('{c[0] / 20!r}' AS DOUBLE), CAST('{c[1] / 20!r}' AS DOUBLE), CAST('{c[2] / 20!r}' AS DOUBLE))"
        for i, c in enumerate(_CANDS)) + ") AS v(cand, w1, w2, w3)),\n" + """b AS (SELECT cand, y, w1 * m1 + w2 * m2 + w3 * m3 AS p FROM wide, cands),
c AS (SELECT cand, p, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY cand, p),
w AS (SELECT cand, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
  coalesce(sum(neg) OVER (PARTITION BY cand ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
SELECT cand, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM w GROUP BY cand"""


@register("search_weights", "cand bigint, auc double", SEARCH_SQL, ops=("B7",))
def q_search_weights(spark, sf):
    lp = long_probs(spark, sf)
    wide = lp.groupBy("id").pivot("model", sorted(PROB_MODELS)).agg(F.first("prob")).join(
        lp.groupBy("id").agg(F.first("label").alias("label")), "id")
    return ens.search_weights(wide, "label", sorted(PROB_MODELS), step=0.05).select("cand", "auc")


@register("guard_degenerate", "id bigint, label bigint",
          f"WITH s AS ({fr.SCORES_SQL}), " + """q AS (SELECT quantile_cont(p, 0.6) AS qv, min(p) AS lo, max(p) AS hi FROM s),
t AS (SELECT CASE WHEN hi > lo THEN least(greatest(qv, lo + 1e-06), hi - 1e-06) ELSE 0.5 END AS thr FROM q)
SELECT id, CAST(p >= thr AS INTEGER) AS label FROM s, t""", ops=("B20",))
def q_guard(spark, sf):
    s = fr.scores(spark, sf)
    # the cut above every score makes the first rule degenerate; the quantile rule then applies
    return ens.guard_degenerate(s, "id", "p", 0.99, prevalence=0.4)


# --- selection ---------------------------------------------------------------------------------

CARDIO_F = ["height", "weight", "ap_hi", "ap_lo", "age", "cholesterol", "gluc"]


@register("select_by_corr", "feature string, corr double, abs_corr double",
          W_CARDIO + ", s AS (" + "\nUNION ALL ".join(
              f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(cardio AS DOUBLE)) AS corr FROM t" for c in CARDIO_F) +
          ")\nSELECT feature, corr, abs(corr) AS abs_corr FROM s ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 4", ops=("X2", "L1"))
def q_select_corr(spark, sf):
    return sel.select_by_corr(fr.cardio(spark, sf), CARDIO_F, "cardio", 4)


@register("select_by_variance", "feature string, var double",
          W_CARDIO + ", s AS (" + "\nUNION ALL ".join(f"SELECT '{c}' AS feature, var_samp({c}) AS var FROM t" for c in CARDIO_F) +
          ")\nSELECT * FROM s ORDER BY var DESC NULLS LAST, feature LIMIT 3", ops=("X8", "L2"))
def q_select_var(spark, sf):
    return sel.select_by_variance(fr.cardio(spark, sf), CARDIO_F, 3)


@register("prune_correlated", "feature string",
          f"WITH t AS ({fr.NUMERIC_SQL})\n, p AS (" + "\nUNION ALL ".join(
              f"SELECT '{b}' AS feature, abs(corr({a}, {b})) AS r FROM t" for i, a in enumerate(fr.NUMERIC_COLS)
              for b in fr.NUMERIC_COLS[i + 1:]) + ")\nSELECT DISTINCT feature FROM p WHERE r > 0.5", ops=("X5", "A12"))
def q_prune_corr(spark, sf):
    drop = sel.prune_correlated(fr.numeric(spark, sf), fr.NUMERIC_COLS, 0.5)
    # the rule runs on the small pair table; the answer is a list of names
    return spark.createDataFrame([(d,) for d in drop], "feature string")


@register("blend_scores", "feature string, combined double",
          W_CARDIO + ", lf AS (" + "\nUNION ALL ".join(
              f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, cardio FROM t" for c in CARDIO_F) + """),
sc AS (SELECT feature, abs(corr(value, CAST(cardio AS DOUBLE))) AS c, var_samp(value) AS v FROM lf GROUP BY feature),
m AS (SELECT feature, cardio, count(*) AS n, avg(value) AS mean, var_samp(value) AS var FROM lf GROUP BY feature, cardio),
g AS (SELECT feature, sum(n) AS N, count(*) AS k, sum(n * mean) AS S, sum(n * mean * mean) AS SS, sum((n - 1) * coalesce(var, 0)) AS ssw FROM m GROUP BY feature),
fs AS (SELECT feature, ((SS - S * S / N) / (k - 1)) / (ssw / (N - k)) AS f FROM g),
a AS (SELECT sc.feature, c, v, f FROM sc JOIN fs USING (feature)),
b AS (SELECT min(c) AS lc, max(c) AS hc, min(v) AS lv, max(v) AS hv, min(f) AS lf_, max(f) AS hf FROM a)
SELECT feature, CASE WHEN hc = lc THEN 0 ELSE (c - lc) / (hc - lc) END * 0.5 + CASE WHEN hf = lf_ THEN 0 ELSE (f - lf_) / (hf - lf_) END * 0.3
  + CASE WHEN hv = lv THEN 0 ELSE (v - lv) / (hv - lv) END * 0.2 AS combined FROM a, b ORDER BY combined DESC, feature LIMIT 5""",
          ops=("X4", "J3"))
def q_blend_scores(spark, sf):
    c = fr.cardio(spark, sf)
    corr = pr.target_corr(c, CARDIO_F, "cardio").select("feature", F.col("abs_corr").alias("score"))
    fsc = pr.anova_f(c, CARDIO_F, "cardio").select("feature", F.col("f_score").alias("score"))
    var = pr.fused_stats(c, CARDIO_F, {"score": F.var_samp})
    out = sel.blend_scores({"corr": corr, "anova": fsc, "variance": var}, {"corr": 0.5, "anova": 0.3, "variance": 0.2}, 5)
    return out.select("feature", "combined")


# --- schema helpers, ordering, previews -------------------------------------------------------

@register("common_projection", "id bigint, age bigint",
          f"WITH t AS ({fr.CARDIO_SQL}) SELECT id, age FROM t", ops=("P2", "P3", "P11"))
def q_common_projection(spark, sf):
    c, h = fr.cardio(spark, sf), fr.heart(spark, sf)
    keep = cl_common(["age", "sex", "gender", "age"], c, h)
    return cl_select(cl_drop(c, ["no_such_column", "cardio"]), keep, keep=["id"])


def cl_common(cands, a, b):
    from ..operators.clean import common_features
    return common_features(cands, a, b)


def cl_select(df, names, keep=()):
    from ..operators.clean import select_features
    return select_features(df, names, keep)


def cl_drop(df, names):
    from ..operators.clean import drop_cols
    return drop_cols(df, names)


@register("normalise_predictions", "id bigint, label bigint",
          f"WITH v AS ({fr.VOTES_SQL}) SELECT id, y AS label FROM v", ops=("P12", "F14"))
def q_normalise(spark, sf):
    from ..operators.clean import normalise_predictions
    v = fr.votes(spark, sf).select(F.col("id").alias("ID"), F.col("y").alias("Cardio"))
    return normalise_predictions(v, "id")


@register("constant_drop", "feature string",
          f"WITH t AS ({fr.SENTINEL_SQL}), a AS (SELECT * FROM t WHERE s1 = 999 AND s2 = 999 AND s3 = 999)\n" + "\nUNION ALL ".join(
              f"SELECT '{c}' AS feature FROM a HAVING count(DISTINCT {c}) <= 1" for c in fr.SENTINEL_COLS + ["meta"]),
          ops=("F25", "A6", "P9"))
def q_constant_drop(spark, sf):
    """The metadata-only route (all behaviour values are the sentinel): behaviour columns are
    constant there and are dropped before that route's model is fitted."""
    from ..operators.clean import ConstantDropper, split_by_class
    s = fr.sentinel(spark, sf).withColumn("row_type", pr.sentinel_row_type(fr.SENTINEL_COLS))
    route = split_by_class(s, "row_type", ["all"])["all"]
    cols = fr.SENTINEL_COLS + ["meta"]
    dropped = ConstantDropper(cols).fit(route)
    kept = ConstantDropper.transform(route, dropped).columns
    return spark.createDataFrame([(c,) for c in cols if c not in kept], "feature string")


@register("preview_rows", "id bigint, ap_hi bigint", f"WITH t AS ({fr.CARDIO_SQL}) SELECT id, ap_hi FROM t ORDER BY id LIMIT 5",
          ops=("L7",))
def q_preview(spark, sf):
    from ..operators.order import preview
    return preview(fr.cardio(spark, sf).select("id", "ap_hi"), 5, "id")


@register("sort_abs_corr", "feature string, corr double",
          f"WITH t AS ({fr.CARDIO_SQL}), s AS (" + "\nUNION ALL ".join(
              f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(cardio AS DOUBLE)) AS corr FROM t" for c in CARDIO_F) +
          ") SELECT * FROM s", ops=("L3",))
def q_sort_abs(spark, sf):
    from ..operators.order import sort_abs
    tc = pr.target_corr(fr.cardio(spark, sf), CARDIO_F, "cardio").select("feature", "corr")
    return sort_abs(tc, "corr", tie_col="feature")


@register("order_ids", "key string", """SELECT CAST(doc_id AS VARCHAR) AS key FROM documents
  UNION ALL SELECT source FROM documents""", ops=("L4",))
def q_order_ids(spark, sf):
    from ..operators.order import order_ids
    d = fr.table(spark, sf, "documents")
    keys = d.select(F.col("doc_id").cast("string").alias("key")).unionByName(d.select(F.col("source").alias("key")))
    return order_ids(keys, "key")


@register("assembled_blocks", "id bigint, n_features bigint, total double",
          f"WITH t AS ({fr.CARDIO_SQL}) SELECT id, 4 AS n_features, ((0.0 + ap_hi) + ap_lo) + weight + height AS total FROM t",
          ops=("U4",))
def q_assembled(spark, sf):
    from pyspark.ml.functions import vector_to_array
    from ..operators.features import assemble
    c = fr.cardio(spark, sf)
    blocks = [c.select("id", "ap_hi", "ap_lo"), c.select("id", "weight", "height")]
    j = reduce(lambda a, b: a.join(b, "id"), blocks)
    v = assemble(j, ["ap_hi", "ap_lo", "weight", "height"]).select("id", vector_to_array("features").alias("a"))
    return v.select("id", F.size("a").alias("n_features"), F.aggregate("a", F.lit(0.0), lambda s, x: s + x).alias("total"))
