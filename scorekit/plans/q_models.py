"""Queries: models, cross-fitting, stacking, calibration, k-NN, k-NN mutual information
(M1-M15, K3-K7, K9, K11, B13-B15, J7, A14, X1, X3, X6). Learned or seeded output: rows-only checks
in the driver, properties in the tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import crossfit as cf
from ..operators import ensemble as ens
from ..operators import features as fe
from ..operators import knn
from ..operators import models as mdl
from ..operators import select as sel
from ..session import keep_alone, kept_frames
from . import frames as fr
from .registry import register

FEATS = ["age", "gender", "height", "weight", "ap_hi", "ap_lo", "cholesterol", "gluc", "smoke", "alco", "active"]
OOF_SCHEMA = "id bigint, fold bigint, model string, label bigint, prob double"


def ml_frame(spark, sf, k: int = 3, seed: int = 42) -> DataFrame:
    c = fr.cardio(spark, sf).withColumnRenamed("cardio", "label")
    folded = cf.stratified_folds(c, "id", "label", k, seed)
    return fe.assemble(folded, FEATS)


def _oof(name, make):
    """``make(n)`` gets the rows of a training part, from which linear models set their penalty."""
    def build(spark, sf):
        since = kept_frames()
        d = keep_alone(ml_frame(spark, sf), since)
        oof, _ = cf.cross_fit(d, make(d.where("fold <> 0").count()), "id", "label", "fold", name)
        return oof
    return build


for _name, _make, _ops in (
        ("oof_gbt", lambda n: mdl.boosted(max_iter=30, max_depth=4), ("M1", "K3")),
        ("oof_forest", lambda n: mdl.forest(num_trees=50, max_depth=8), ("M2", "K3")),
        ("oof_extra_trees", lambda n: mdl.extra_trees(num_trees=50, max_depth=8), ("M3",)),
        ("oof_tree", lambda n: mdl.tree(max_depth=4), ("M5",)),
        ("oof_logistic", lambda n: mdl.logistic(C=1.0, n_rows=n, standardization=True), ("M6",)),
        ("oof_linear_svc", lambda n: mdl.linear_svc(C=1.0, n_rows=n, max_iter=20), ("M7", "M11", "F13")),
        ("oof_perceptron", lambda n: mdl.perceptron([len(FEATS), 8, 2], max_iter=30), ("M8",))):
    register(_name, OOF_SCHEMA, None, ops=_ops)(_oof(_name, _make))


@register("adaboost_scores", "id bigint, prob double", None, ops=("M4",))
def q_adaboost(spark, sf):
    d = ml_frame(spark, sf)
    model = mdl.AdaBoost(depth=2, rounds=6, rate=0.5).fit(d)
    return model.transform(d).select("id", "prob")


@register("test_mean_scores", "id bigint, model string, prob double", None, ops=("K4", "M11"))
def q_test_mean(spark, sf):
    train = ml_frame(spark, sf)
    test = fe.assemble(fr.cardio(spark, sf), FEATS)
    _, ts = cf.cross_fit(train, mdl.tree(max_depth=3), "id", "label", "fold", "tree", test=test)
    return ts


@register("fold_summary", "model string, mean double, std double, folds bigint", None, ops=("K5", "E2"))
def q_fold_summary(spark, sf):
    oof, _ = cf.cross_fit(ml_frame(spark, sf), mdl.tree(max_depth=3), "id", "label", "fold", "tree")
    return cf.fold_summary(cf.per_fold_auc(oof), "auc")


@register("random_search", "params string, auc double", None, ops=("K6",))
def q_random_search(spark, sf):
    from pyspark.ml.classification import DecisionTreeClassifier
    d = ml_frame(spark, sf)
    _, res = cf.random_search(d, lambda: DecisionTreeClassifier(labelCol="label"), {"maxDepth": [2, 3, 4], "minInstancesPerNode": [1, 5]},
                              3, "label", "fold", seed=42)
    return spark.createDataFrame([(str(sorted(p.items())), float(s)) for p, s in res], "params string, auc double")


@register("grid_search", "params string, auc double", None, ops=("K7", "K8"))
def q_grid_search(spark, sf):
    from pyspark.ml.classification import DecisionTreeClassifier
    c = fe.assemble(fr.cardio(spark, sf).withColumnRenamed("cardio", "label"), FEATS)
    _, res = cf.grid_search(c, lambda: DecisionTreeClassifier(labelCol="label"), {"maxDepth": [2, 4]}, "label", "id",
                            sample_n=10_000, k=3)
    return spark.createDataFrame([(str(sorted(p.items())), float(s)) for p, s in res], "params string, auc double")


@register("adversarial_weights", "id bigint, weight double", None, ops=("K9", "R3", "U2"))
def q_adversarial(spark, sf):
    c = fr.cardio(spark, sf)
    train = c.where(F.col("id") % 5 != 0)
    score = c.where(F.col("id") % 5 == 0).withColumn("ap_hi", F.col("ap_hi") + 10)
    w, _ = cf.adversarial_weights(train, score, mdl.tree(max_depth=3, label_col="origin"), "id", ["ap_hi", "ap_lo", "weight"], k=3)
    return w


@register("repeat_cross_fit", "id bigint, model string, label bigint, prob double", None, ops=("K11", "M14"))
def q_repeat(spark, sf):
    c = fe.assemble(fr.cardio(spark, sf).withColumnRenamed("cardio", "label"), FEATS)
    oof, _ = cf.repeat_cross_fit(c, mdl.tree(max_depth=3), "id", "label", [1, 2], k=3, model_name="tree")
    return oof


@register("seed_bag", "id bigint, model string, label bigint, prob double", None, ops=("M14",))
def q_seed_bag(spark, sf):
    oof, _ = mdl.seed_bag(ml_frame(spark, sf), lambda s: mdl.forest(num_trees=5, max_depth=4, seed=s)(), "id", "label",
                          [1, 2, 3], model_name="forest")
    return oof


@register("boosted_categorical", "id bigint, prob double", None, ops=("M15",))
def q_boosted_cat(spark, sf):
    c = fr.cardio(spark, sf).withColumnRenamed("cardio", "label").withColumn("chol_cat", F.col("cholesterol").cast("string"))
    pipe = mdl.boosted_categorical(["chol_cat"], max_iter=5, max_depth=3)(["ap_hi", "ap_lo", "weight"])
    return cf.positive_prob(pipe.fit(c).transform(c)).select("id", "prob")


@register("routed_model", "id bigint, _route string, prob double", None, ops=("M12", "P9"))
def q_routed(spark, sf):
    s = fr.sentinel(spark, sf).withColumnRenamed("y", "label")
    rm = mdl.RoutedModel(fr.SENTINEL_COLS, ["meta"], mdl.tree(max_depth=3), mdl.tree(max_depth=2))
    return rm.transform(rm.fit(s), s, "id")


@register("stacked", "id bigint, label bigint, prob double", None, ops=("B13",))
def q_stack(spark, sf):
    d = ml_frame(spark, sf)
    oofs = [cf.cross_fit(d, m, "id", "label", "fold", n)[0]
            for n, m in (("tree", mdl.tree(max_depth=3)), ("lr", mdl.logistic(standardization=True)))]
    _, out, _ = mdl.stack(reduce(DataFrame.unionByName, oofs), None)
    return out


@register("stack_cv", "reg double, auc double", None, ops=("B14",))
def q_stack_cv(spark, sf):
    d = ml_frame(spark, sf)
    oofs = [cf.cross_fit(d, m, "id", "label", "fold", n)[0]
            for n, m in (("tree", mdl.tree(max_depth=3)), ("lr", mdl.logistic(standardization=True)))]
    _, res = mdl.stack_cv(reduce(DataFrame.unionByName, oofs), grid=(0.01, 0.1))
    return spark.createDataFrame([(float(a), float(b)) for a, b in res], "reg double, auc double")


@register("isotonic_calibration", "id bigint, prob double, calibrated double", None, ops=("B15",))
def q_isotonic(spark, sf):
    s = fr.scores(spark, sf).select("id", F.col("p").alias("prob"), F.col("y").alias("label"))
    model = mdl.calibrate_isotonic(s)
    return mdl.apply_calibration(model, s).select("id", "prob", "calibrated")


@register("importance_top", "feature string, importance double", None, ops=("X3",))
def q_importance(spark, sf):
    d = ml_frame(spark, sf)
    m = mdl.forest(num_trees=10, max_depth=5)().fit(d)
    return sel.select_by_importance(spark, m, FEATS, 5)


@register("prune_least_important", "feature string", None, ops=("X6",))
def q_prune_imp(spark, sf):
    d = ml_frame(spark, sf)
    rows = []
    for f in range(3):
        m = mdl.forest(num_trees=5, max_depth=4, seed=f)().fit(d.where(F.col("fold") != f))
        rows += [(f, n, v) for n, v in sel.importance_table(m, FEATS)]
    imp = spark.createDataFrame(rows, "fold int, feature string, importance double")
    return spark.createDataFrame([(x,) for x in sel.prune_least_important(imp, 0.2)], "feature string")


# --- k-NN ------------------------------------------------------------------------------------

def _vec_split(spark, sf):
    v = fr.vectors(spark, sf)
    return v.where(F.col("id") % 10 == 0), v.where(F.col("id") % 10 != 0)


@register("knn_join", "qid bigint, rank bigint, bid bigint, distance double, label bigint",
          f"""WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
q AS (SELECT * FROM v WHERE id % 10 = 0), b AS (SELECT * FROM v WHERE id % 10 <> 0),
d AS (SELECT q.id AS qid, b.id AS bid, sqrt(list_sum(list_transform(list_zip(q.e, b.e), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) AS distance,
  b.label FROM q, b),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, bid) AS rank FROM d)
SELECT qid, rank, bid, distance, label FROM r WHERE rank <= 5""", ops=("J7",))
def q_knn_join(spark, sf):
    q, b = _vec_split(spark, sf)
    return knn.knn_join(q, b, 5, "euclidean")


_DIST = {
    "euclidean": "sqrt(list_sum(list_transform(list_zip(q.e, b.e), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))",
    "manhattan": "list_sum(list_transform(list_zip(q.e, b.e), lambda x: abs(x[1] - x[2])))",
    "minkowski": "pow(list_sum(list_transform(list_zip(q.e, b.e), lambda x: pow(abs(x[1] - x[2]), 3))), 1.0 / 3)",
    "cosine": "1 - list_sum(list_transform(list_zip(q.e, b.e), lambda x: x[1] * x[2])) / (sqrt(list_sum(list_transform(q.e, lambda x: x * x))) * "
              "sqrt(list_sum(list_transform(b.e, lambda x: x * x))))",
}
_VOTE_SQL = """WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
q AS (SELECT * FROM v WHERE id % 10 = 0), b AS (SELECT * FROM v WHERE id % 10 <> 0),
d AS (""" + " UNION ALL ".join(f"SELECT '{m}' AS metric, q.id AS qid, b.id AS bid, b.label, {_DIST[m]} AS distance FROM q, b" for m in knn.METRICS) + """),
r AS (SELECT *, row_number() OVER (PARTITION BY metric, qid ORDER BY distance, bid) AS rank FROM d),
s AS (SELECT k.k, r.metric, r.qid, r.label, count(*) / k.k AS share FROM r JOIN (VALUES (3), (5), (7)) k(k) ON r.rank <= k.k GROUP BY k.k, r.metric, r.qid, r.label),
p AS (SELECT qid, label, sum(share) / """ + str(3 * len(knn.METRICS)) + """ AS prob FROM s GROUP BY qid, label),
w AS (SELECT qid, label AS pred, row_number() OVER (PARTITION BY qid ORDER BY round(prob, 9) DESC, label) AS place FROM p)
SELECT p.qid, p.label, p.prob, w.pred FROM p JOIN w ON w.qid = p.qid AND w.place = 1"""


@register("knn_vote", "qid bigint, label bigint, prob double, pred bigint", _VOTE_SQL, ops=("M9", "J7"))
def q_knn_vote(spark, sf):
    q, b = _vec_split(spark, sf)
    variants = [(k, m) for k in (3, 5, 7) for m in knn.METRICS]
    return knn.knn_soft_vote(q, b, variants)


def _psi(x: str) -> str:
    """Digamma of an SQL expression: recurrence up to x + 6, then the asymptotic series."""
    z = f"({x} + 6.0)"
    return (f"(ln({z}) - 0.5 / {z} - 1.0 / (12 * {z} * {z}) + 1.0 / (120 * pow({z}, 4)) - 1.0 / (252 * pow({z}, 6)) - "
            + " - ".join(f"1.0 / ({x} + {i})" for i in range(6)) + ")")


def mi_knn_sql(source: str, cols, label: str, k: int = 3) -> str:
    """k-NN mutual information with a class: radius to the k-th neighbour of the same class among distinct
    values and their counts, then the points of any class inside it, by two lookups of running counts."""
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, {label} AS y FROM t WHERE {c} IS NOT NULL" for c in cols)
    near = ", ".join(f"lag(x, {i}) OVER w AS b{i}, lag(c, {i}) OVER w AS cb{i}, lead(x, {i}) OVER w AS a{i}, lead(c, {i}) OVER w AS ca{i}"
                     for i in range(1, k + 1))
    cands = "[{'d': 0.0, 'c': c - 1}, " + ", ".join(f"{{'d': x - b{i}, 'c': cb{i}}}, {{'d': a{i} - x, 'c': ca{i}}}" for i in range(1, k + 1)) + "]"
    return f"""WITH t AS ({source}), l AS ({long}),
n AS (SELECT feature, y, count(*) AS ny FROM l GROUP BY 1, 2 HAVING count(*) > 1),
v AS (SELECT l.feature, l.y, l.x, count(*) AS c, any_value(n.ny) AS ny FROM l JOIN n ON n.feature = l.feature AND n.y = l.y GROUP BY 1, 2, 3),
q AS (SELECT *, {near} FROM v WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
e AS (SELECT feature, y, x, c, ny, least({k}, ny - 1) AS kk, list_filter({cands}, lambda s: s.d IS NOT NULL) AS s FROM q),
r AS (SELECT *, list_min(list_transform(list_filter(s, lambda u: list_sum(list_transform(list_filter(s, lambda w: w.d <= u.d), lambda w: w.c)) >= kk), lambda u: u.d)) AS r FROM e),
g AS (SELECT feature, x, sum(c) AS c FROM v GROUP BY 1, 2),
h AS (SELECT feature, x, sum(c) OVER (PARTITION BY feature ORDER BY x) AS upto FROM g),
z AS (SELECT r.*, CASE WHEN r = 0 THEN x ELSE x + r - 1e-9 END AS hi, CASE WHEN r = 0 THEN x - 1e-9 ELSE x - r + 1e-9 END AS lo FROM r),
u AS (SELECT z.*, h.upto AS up FROM z ASOF JOIN h ON z.feature = h.feature AND z.hi >= h.x),
m AS (SELECT u.*, u.up - coalesce(h.upto, 0) AS m FROM u ASOF LEFT JOIN h ON u.feature = h.feature AND u.lo >= h.x)
SELECT feature, greatest(0, {_psi("sum(c)")} + (sum(c * {_psi("kk")}) - sum(c * {_psi("ny")}) - sum(c * {_psi("m")})) / sum(c)) AS mi
FROM m GROUP BY feature"""


@register("mutual_info_knn", "feature string, mi double", mi_knn_sql(fr.NUMERIC_SQL, fr.NUMERIC_COLS, "y"), ops=("A14", "W4"))
def q_mi_knn(spark, sf):
    return knn.mutual_info_knn(fr.numeric(spark, sf), fr.NUMERIC_COLS, "y", k=3)


@register("select_by_mi", "feature string, mi double",
          f"SELECT * FROM ({mi_knn_sql(fr.CARDIO_SQL, ['height', 'weight', 'ap_hi', 'ap_lo', 'age'], 'cardio')}) ORDER BY mi DESC, feature LIMIT 3", ops=("X1",))
def q_select_mi(spark, sf):
    return sel.select_by_mi(fr.cardio(spark, sf), ["height", "weight", "ap_hi", "ap_lo", "age"], "cardio", 3, k=3)


def _pick_best_sql():
    from .q_misc import AUC_BY_MODEL, LP_SQL
    return LP_SQL + AUC_BY_MODEL + "SELECT model FROM auc ORDER BY auc DESC, model LIMIT 1"


@register("pick_best", "model string", _pick_best_sql(), ops=("M10", "L6"))
def q_pick_best(spark, sf):
    from .q_misc import long_probs
    best = mdl.pick_best(ens.per_model_auc(long_probs(spark, sf)))
    return spark.createDataFrame([(best,)], "model string")
