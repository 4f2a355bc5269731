"""Contracts of learned and seeded operators, checked by SQL.

Scores of learned models are not SQL, but what must hold of them is: every id once, the right number of
folds, probabilities in range, an AUC above a floor on a label that depends on the features, nulls and
odd ids kept. ``patient`` is the frame: measures with gaps and a label computed from them before."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import crossfit as cf
from ..operators import ensemble as ens
from ..operators import features as fe
from ..operators import metrics as met
from ..operators import models as mdl
from ..operators import select as sel
from ..session import keep, keep_alone, kept_frames
from . import frames as fr
from .registry import register

COLS = ["age", "weight", "ap_hi", "ap_lo", "cholesterol"]
PATIENT_SQL = f"""SELECT id, age, CASE WHEN id % 13 = 0 THEN NULL ELSE weight END AS weight, CASE WHEN id % 17 = 0 THEN NULL ELSE ap_hi END AS ap_hi,
  ap_lo, cholesterol, gluc, CAST(ap_hi + weight + 20 * cholesterol > 280 AS INTEGER) AS label, 'w' || (id * 7 % 100) AS ward
FROM ({fr.CARDIO_SQL})"""
W = f"WITH t AS ({PATIENT_SQL})\n"


def patient(spark, sf) -> DataFrame:
    c = fr.cardio(spark, sf)
    gap = lambda name, k: F.when(F.col("id") % k != 0, F.col(name)).alias(name)
    return c.select("id", "age", gap("weight", 13), gap("ap_hi", 17), "ap_lo", "cholesterol", "gluc",
                    (F.col("ap_hi") + F.col("weight") + 20 * F.col("cholesterol") > 280).cast("int").alias("label"),
                    F.concat(F.lit("w"), (F.col("id") * 7 % 100).cast("string")).alias("ward"))


def folded(spark, sf, k: int = 3) -> DataFrame:
    p = patient(spark, sf)
    return cf.stratified_folds(fe.assemble(p, COLS, fill=fe.fit_fill(p, COLS)), "id", "label", k, 42)


def _kept(spark, sf) -> DataFrame:
    """The folded frame, ordered once, for queries that fit many models on it."""
    since = kept_frames()
    return keep_alone(folded(spark, sf).select("id", "label", "fold", "features"), since)


def _auc(scored: DataFrame) -> float:
    return met.auc_exact(scored, "label", "prob").first()["auc"] or 0.0


def _contract(name: str, scored: DataFrame, floor: float, folds: int = 0) -> DataFrame:
    """One row: rows, ids, folds, probabilities in range, and whether the AUC is above the floor."""
    scored = keep(scored.select("id", "label", "prob", *(["fold"] if folds else [])))  # scored once for the counts and the AUC
    found = scored.agg(F.countDistinct("fold").alias("folds")) if folds else scored.sparkSession.range(1).select(F.lit(0).alias("folds"))
    by_id = scored.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prob").between(0, 1)).alias("good"))
    counts = by_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("id").alias("ids"), F.coalesce(F.sum("good"), F.lit(0)).alias("in_range"))
    return counts.crossJoin(found).select(F.lit(name).alias("model"), "rows", "ids", "folds", "in_range", F.lit(int(_auc(scored) > floor)).alias("learned"))


CONTRACT = "model string, rows bigint, ids bigint, folds bigint, in_range bigint, learned bigint"


def contract_sql(name: str, folds: int) -> str:
    return W + f"SELECT '{name}' AS model, count(*) AS rows, count(DISTINCT id) AS ids, {folds} AS folds, count(*) AS in_range, 1 AS learned FROM t"


for _name, _make, _floor, _ops in (
        ("gbt", lambda n: mdl.boosted(max_iter=8, max_depth=4), 0.9, ("M1", "K3")),
        ("forest", lambda n: mdl.forest(num_trees=12, max_depth=6), 0.85, ("M2", "K3")),
        ("extra_trees", lambda n: mdl.extra_trees(num_trees=12, max_depth=6), 0.8, ("M3",)),
        ("tree", lambda n: mdl.tree(max_depth=5), 0.8, ("M5",)),
        ("logistic", lambda n: mdl.logistic(n_rows=n, standardization=True), 0.9, ("M6",)),
        ("linear_svc", lambda n: mdl.linear_svc(n_rows=n, max_iter=20), 0.85, ("M7", "M11", "F13")),
        ("poly_svc", lambda n: mdl.linear_svc(n_rows=n, max_iter=20, degree=2), 0.85, ("M7",)),
        ("perceptron", lambda n: mdl.perceptron([len(COLS), 6, 2], max_iter=60), 0.6, ("M8",))):
    def _build(spark, sf, name=_name, make=_make, floor=_floor):
        d = folded(spark, sf)
        n = d.where("fold <> 0").count()  # rows of a training part set the penalty
        return _contract(name, cf.cross_fit(d, make(n), "id", "label", "fold", name)[0], floor, 3)
    register(f"contract_{_name}", CONTRACT, contract_sql(_name, 3), ops=_ops)(_build)


@register("contract_adaboost", CONTRACT, contract_sql("adaboost", 0), ops=("M4",))
def q_adaboost(spark, sf):
    d = folded(spark, sf)
    return _contract("adaboost", mdl.AdaBoost(depth=3, rounds=6, rate=0.5, checkpoint_every=2).fit(d).transform(d), 0.8)


@register("contract_categorical", CONTRACT, contract_sql("categorical", 0), ops=("M15", "F37"))
def q_categorical(spark, sf):
    """A category of 100 levels by ordered target statistics, gaps in the numeric columns."""
    p = patient(spark, sf)
    m = mdl.boosted_categorical(["ward"], max_iter=5, max_depth=3)(COLS).fit(p)
    return _contract("categorical", cf.positive_prob(m.transform(p)), 0.85)


@register("contract_seeds", CONTRACT, W + " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS rows, count(DISTINCT id) AS ids, 0 AS folds, count(*) AS in_range, 1 AS learned FROM t"
    for m in ("repeat", "bag", "stack")), ops=("K11", "M14", "B13"))
def q_seeds(spark, sf):
    """Averages over seeds, and a stack of two models: one score for each id."""
    d = _kept(spark, sf)
    repeat, _ = cf.repeat_cross_fit(d.drop("fold"), mdl.tree(max_depth=4), "id", "label", [1, 2], k=3)
    bag, _ = mdl.seed_bag(d, lambda s: mdl.forest(num_trees=4, max_depth=5, seed=s)(), "id", "label", [1, 2])
    parts = [cf.cross_fit(d, m, "id", "label", "fold", n)[0] for n, m in (("tree", mdl.tree(max_depth=4)), ("lr", mdl.logistic(standardization=True)))]
    _, stacked, _ = mdl.stack(reduce(DataFrame.unionByName, parts), None)
    return reduce(DataFrame.unionByName, [_contract("repeat", repeat, 0.8), _contract("bag", bag, 0.8), _contract("stack", stacked, 0.85)])


# A fixed scorer in place of a learned one: cross-fitting, fold means and summaries in SQL.

class FixedScorer:
    """An estimator whose model scores by a formula and a constant learned from its rows (their share of
    label 1), so that a fold's score depends on what it was fitted on."""

    def __init__(self, label_col: str = "label", modulus: int = 50):
        self.label_col, self.modulus = label_col, modulus

    def fit(self, df: DataFrame) -> "FixedScorer":
        self.base = df.agg(F.avg(F.col(self.label_col).cast("double"))).first()[0]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(self.base) * 0.5 + (F.col("ap_lo") % self.modulus) / 100.0)


RN = "row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(id AS VARCHAR)), id)"
FIXED_SQL = W + f""", f AS (SELECT *, ({RN} - 1) % 3 AS fold FROM t),
b AS (SELECT k.fold, avg(CAST(f.label AS DOUBLE)) AS base FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold)
"""


@register("cross_fit_fixed", "id bigint, fold bigint, model string, label bigint, prob double",
          FIXED_SQL + "SELECT f.id, f.fold, 'fixed' AS model, f.label, b.base * 0.5 + (f.ap_lo % 50) / 100.0 AS prob FROM f JOIN b USING (fold)",
          ops=("K3",))
def q_fixed(spark, sf):
    p = cf.stratified_folds(patient(spark, sf), "id", "label", 3, 42)
    return cf.cross_fit(p, FixedScorer, "id", "label", "fold", "fixed")[0]


@register("test_mean_fixed", "id bigint, model string, prob double",
          FIXED_SQL + f"""SELECT s.id, 'fixed' AS model, avg(b.base * 0.5 + (s.ap_lo % 50) / 100.0) AS prob
FROM (SELECT id + 10000000 AS id, ap_lo FROM ({fr.CARDIO_SQL})) s, b GROUP BY s.id""", ops=("K4", "M11"))
def q_fixed_test(spark, sf):
    p = cf.stratified_folds(patient(spark, sf), "id", "label", 3, 42)
    test = fr.cardio(spark, sf).select((F.col("id") + 10000000).alias("id"), "ap_lo")
    return cf.cross_fit(p, FixedScorer, "id", "label", "fold", "fixed", test=test)[1]


@register("fold_summary_fixed", "model string, mean double, std double, folds bigint", FIXED_SQL + """,
s AS (SELECT fold, label, (ap_lo % 50) / 100.0 AS p FROM f),
c AS (SELECT fold, p, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY fold, p),
w AS (SELECT fold, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
  coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
a AS (SELECT fold, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM w GROUP BY fold)
SELECT 'fixed' AS model, avg(auc) AS mean, stddev_pop(auc) AS std, count(*) AS folds FROM a""", ops=("K5", "E2"))
def q_fixed_summary(spark, sf):
    p = cf.stratified_folds(patient(spark, sf), "id", "label", 3, 42)
    return cf.fold_summary(cf.per_fold_auc(cf.cross_fit(p, FixedScorer, "id", "label", "fold", "fixed")[0]), "auc")


@register("adversarial_fixed", "id string, weight double", f"""WITH b AS (SELECT ('c:' || id) AS id, ap_lo, 0 AS origin FROM ({fr.CARDIO_SQL}) WHERE id % 5 <> 0
  UNION ALL SELECT ('c:' || id), ap_lo, 1 FROM ({fr.CARDIO_SQL}) WHERE id % 5 = 0),
k AS (SELECT *, (CAST(origin AS VARCHAR) || ':' || id) AS key FROM b),
f AS (SELECT *, (row_number() OVER (PARTITION BY origin ORDER BY md5('42:' || key), key) - 1) % 3 AS fold FROM k),
m AS (SELECT j.fold, avg(CAST(f.origin AS DOUBLE)) AS base FROM (SELECT DISTINCT fold FROM f) j JOIN f ON f.fold <> j.fold GROUP BY j.fold),
w AS (SELECT id, 1 - (m.base * 0.5 + (ap_lo % 50) / 100.0) AS w FROM f JOIN m USING (fold) WHERE origin = 0)
SELECT id, w / avg(w) OVER () AS weight FROM w""", ops=("K9", "R3", "U2"))
def q_adversarial(spark, sf):
    """Ids with a colon: none may be lost."""
    c = fr.cardio(spark, sf).select(F.concat(F.lit("c:"), F.col("id").cast("string")).alias("id"), F.col("id").alias("n"), "ap_lo")
    w, _ = cf.adversarial_weights(c.where("n % 5 <> 0"), c.where("n % 5 = 0"), lambda: FixedScorer("origin"), "id", ["ap_lo"], k=3)
    return w


# A search over the fixed scorer's parameter: every score and the order in SQL.

GRID = {"modulus": [7, 20, 33, 50, 90]}
DRAWN = {"grid": cf.draw_params(GRID), "random": cf.draw_params(GRID, 3, 42)}


def _search_sql() -> str:
    pairs = [(s, p["modulus"], k) for s, points in DRAWN.items() for k, p in enumerate(points)]
    values = ", ".join(f"('{s}', {m}, {k})" for s, m, k in pairs)
    return FIXED_SQL + f""", k(search, modulus, listed) AS (VALUES {values}),
s AS (SELECT DISTINCT modulus, f.id, fold, label, (ap_lo % modulus) / 100.0 AS p FROM f, k),
c AS (SELECT modulus, fold, p, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY modulus, fold, p),
w AS (SELECT modulus, fold, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
  coalesce(sum(neg) OVER (PARTITION BY modulus, fold ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
a AS (SELECT modulus, fold, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM w GROUP BY modulus, fold),
m AS (SELECT modulus, avg(auc) AS auc FROM a GROUP BY modulus)
SELECT search, row_number() OVER (PARTITION BY search ORDER BY auc DESC, listed) AS place, modulus, auc FROM k JOIN m USING (modulus)"""


@register("param_search_fixed", "search string, place bigint, modulus bigint, auc double", _search_sql(), ops=("K6", "K7"))
def q_param_search(spark, sf):
    p = cf.stratified_folds(patient(spark, sf), "id", "label", 3, 42)
    rows = [(s, k, q["modulus"], float(a)) for s, points in DRAWN.items()
            for k, (q, a) in enumerate(cf.search_params(p, lambda modulus: FixedScorer("label", modulus), points, "id", "label"), 1)]
    return spark.createDataFrame(rows, "search string, place int, modulus int, auc double")


# Searches and choices: how many were tried, and that the best one is good.

@register("contract_search", "search string, tried bigint, good bigint",
          "SELECT 'random auc' AS search, 3 AS tried, 1 AS good UNION ALL SELECT 'random accuracy', 3, 1 UNION ALL SELECT 'grid', 2, 1 "
          "UNION ALL SELECT 'class weight', 3, 1 UNION ALL SELECT 'stack penalty', 2, 1", ops=("K6", "K7", "M13", "B14"))
def q_search(spark, sf):
    from pyspark.ml.classification import DecisionTreeClassifier
    d = _kept(spark, sf)
    tree = lambda: DecisionTreeClassifier(labelCol="label")
    grid = {"maxDepth": [2, 3, 4], "minInstancesPerNode": [1, 5]}
    rows = []
    for metric, name in (("areaUnderROC", "random auc"), ("accuracy", "random accuracy")):
        _, res = cf.random_search(d, tree, grid, 3, "label", "fold", 42, metric)
        rows.append((name, len(res), int(max(s for _, s in res) > 0.6)))
    _, res = cf.grid_search(d.drop("fold"), tree, {"maxDepth": [2, 4]}, "label", "id", sample_n=10_000, k=3)
    rows.append(("grid", len(res), int(max(s for _, s in res) > 0.6)))
    best, tried = mdl.choose_class_weight(d, mdl.tree(max_depth=4, weight_col="weight"), {"none": 1.0, "balanced": "balanced", "up": 1.1}, "id", "label")
    rows.append(("class weight", len(tried), int(dict(tried)[best] == max(a for _, a in tried) > 0.6)))
    parts = [cf.cross_fit(d, m, "id", "label", "fold", n)[0] for n, m in (("tree", mdl.tree(max_depth=4)), ("lr", mdl.logistic(standardization=True)))]
    _, res = mdl.stack_cv(reduce(DataFrame.unionByName, parts), grid=(0.01, 0.1))
    rows.append(("stack penalty", len(res), int(max(a for _, a in res) > 0.8)))
    return spark.createDataFrame(rows, "search string, tried int, good int")


@register("contract_importance", "step string, n bigint, ok bigint",
          "SELECT 'top' AS step, 3 AS n, 1 AS ok UNION ALL SELECT 'pruned', 4, 1 UNION ALL SELECT 'refit', 4, 1", ops=("X3", "X6"))
def q_importance(spark, sf):
    d = folded(spark, sf)
    models = [mdl.forest(num_trees=6, max_depth=4, seed=f)().fit(d.where(F.col("fold") != f)) for f in range(2)]
    top = [r["feature"] for r in sel.select_by_importance(spark, models[0], COLS, 3).collect()]
    imp = spark.createDataFrame([(n, v) for m in models for n, v in sel.importance_table(m, COLS)], "feature string, importance double")
    kept, oof = sel.refit_pruned(d, mdl.tree(max_depth=4), COLS, imp, "id", "label", 0.2)
    rows = [("top", len(top), int({"ap_hi", "weight"} <= set(top))), ("pruned", len(kept), int({"ap_hi", "weight"} <= set(kept))),
            ("refit", len(kept), int(_auc(oof) > 0.8))]
    return spark.createDataFrame(rows, "step string, n int, ok int")


# Clusters, components: every row scored, gaps filled.

KM = ["weight", "ap_hi", "ap_lo"]
CENTRES = [[60.0, 110.0, 60.0], [100.0, 160.0, 90.0], [140.0, 220.0, 120.0]]
_D = [" + ".join(f"({c} - {v}) * ({c} - {v})" for c, v in zip(KM, ctr)) for ctr in CENTRES]


@register("centroid_distances_fixed", "id bigint, dist_c0 double, dist_c1 double, dist_c2 double, cluster bigint", W + """, m AS (
SELECT """ + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in KM) + """ FROM t),
f AS (SELECT id, """ + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in KM) + """ FROM t, m),
d AS (SELECT id, """ + ", ".join(f"sqrt({e}) AS dist_c{k}" for k, e in enumerate(_D)) + """ FROM f)
SELECT *, CASE WHEN dist_c0 <= dist_c1 AND dist_c0 <= dist_c2 THEN 0 WHEN dist_c1 <= dist_c2 THEN 1 ELSE 2 END AS cluster FROM d""", ops=("J8", "F41"))
def q_centroids(spark, sf):
    p = patient(spark, sf)
    return fe.centroid_distances(p, CENTRES, KM, fill=fe.fit_fill(p, KM)).select("id", "dist_c0", "dist_c1", "dist_c2", "cluster")


@register("contract_unsupervised", "operator string, rows bigint, ids bigint, complete bigint, ok bigint",
          W + " UNION ALL ".join(f"SELECT '{o}' AS operator, count(*) AS rows, count(DISTINCT id) AS ids, count(*) AS complete, 1 AS ok FROM t"
                                 for o in ("kmeans", "distances", "pca", "ica")), ops=("F40", "F41", "F42", "F43"))
def q_unsupervised(spark, sf):
    p = patient(spark, sf)
    full = fe.complete_rows(p, KM)

    def row(name, df, cols, ok):
        done = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols])
        return df.agg(F.lit(name).alias("operator"), F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"),
                      F.count_if(done).alias("complete")).withColumn("ok", F.lit(int(ok)))
    km = fe.ClusterLabel(KM, 3, scale=True).fit(p).transform(p)
    cd = fe.ClusterDistances(KM, 3)
    near = cd.transform(p, cd.fit(p))
    pca = fe.CenteredPCA(KM, 2)
    comp = pca.transform(p, pca.fit(p))
    ica = fe.IndependentComponents(KM, 2, max_iter=30)
    ind = ica.transform(p, ica.fit(p))

    def centred(df, cols):
        r = full.select("id").join(df, "id").agg(*[F.avg(c) for c in cols], *[F.corr(cols[0], cols[1])]).first()
        return all(abs(v) < 0.01 for v in r)
    rows = [row("kmeans", km, ["kmeans_3"], km.select("kmeans_3").distinct().count() == 3), row("distances", near, ["dist_c0", "dist_c2", "cluster"], True),
            row("pca", comp, ["pca_0", "pca_1"], centred(comp, ["pca_0", "pca_1"])), row("ica", ind, ["ica_0", "ica_1"], centred(ind, ["ica_0", "ica_1"]))]
    return reduce(DataFrame.unionByName, rows)


@register("isotonic_small", "prob double, calibrated double", W + """, s AS (SELECT CAST(ap_lo // 20 AS DOUBLE) AS x, CAST(label AS DOUBLE) AS y FROM t),
g AS (SELECT x, avg(y) AS y, count(*) AS w FROM s GROUP BY x),
r AS (SELECT a.x AS lo, b.x AS hi, sum(c.y * c.w) / sum(c.w) AS m FROM g a JOIN g b ON b.x >= a.x JOIN g c ON c.x BETWEEN a.x AND b.x GROUP BY a.x, b.x),
u AS (SELECT g.x, r.lo, min(r.m) AS m FROM g JOIN r ON r.lo <= g.x AND r.hi >= g.x GROUP BY g.x, r.lo)
SELECT x AS prob, max(m) AS calibrated FROM u GROUP BY x""", ops=("B15",))
def q_isotonic_small(spark, sf):
    """Isotonic means by the max-min formula over the few pooled scores."""
    s = patient(spark, sf).select(F.floor(F.col("ap_lo") / 20).cast("double").alias("prob"), "label")
    return mdl.apply_calibration(mdl.calibrate_isotonic(s), s.select("prob").distinct()).select("prob", "calibrated")


@register("guard_flat_scores", "id bigint, label bigint", W + """, s AS (SELECT id, 0.5 + (id % 3) * 1e-08 AS p FROM t),
m AS (SELECT quantile_cont(p, 0.5) AS m FROM s) SELECT id, CAST(p >= m AS INTEGER) AS label FROM s, m""", ops=("B20",))
def q_guard_flat(spark, sf):
    s = patient(spark, sf).select("id", (F.lit(0.5) + (F.col("id") % 3) * F.lit(1e-8)).alias("p"))
    thr = ens.guard_flat(s, "p", 0.7)
    return s.select("id", (F.col("p") >= F.lit(thr)).cast("int").alias("label"))


@register("guard_share", "id bigint, label bigint", f"WITH s AS ({fr.SCORES_SQL}), " + """m AS (SELECT quantile_cont(p, 0.5) AS m FROM s)
SELECT id, CAST(p >= m AS INTEGER) AS label FROM s, m""", ops=("B20",))
def q_guard_share(spark, sf):
    """At 0.99 under 5 % are positive: the median decides."""
    return ens.guard_share(fr.scores(spark, sf), "id", "p", 0.99)


@register("vote_8_of_15", "id bigint, label bigint", f"""WITH c AS ({fr.CARDIO_SQL}), v AS (SELECT id, """ + " + ".join(
    f"CAST((ap_hi + {7 * k}) % 40 >= 18 AS INTEGER)" for k in range(15)) + " AS n FROM c) SELECT id, CAST(n >= 8 AS INTEGER) AS label FROM v", ops=("B8",))
def q_vote_8(spark, sf):
    c = fr.cardio(spark, sf)
    sets = [c.select("id", F.lit(f"fold{k}").alias("model"), F.lit(k).alias("ordinal"), ((F.col("ap_hi") + 7 * k) % 40 >= 18).cast("int").alias("label"))
            for k in range(15)]
    return ens.hard_vote(reduce(DataFrame.unionByName, sets), 8)


_HITS = " + ".join(f"CAST(coalesce({c} = 999, false) AS INTEGER)" for c in fr.SENTINEL_COLS)


@register("contract_routed", "route string, rows bigint, ids bigint, in_range bigint", f"""WITH t AS ({fr.SENTINEL_SQL}),
r AS (SELECT id, CASE WHEN {_HITS} = {len(fr.SENTINEL_COLS)} THEN 'all' WHEN {_HITS} > 0 THEN 'partial' ELSE 'none' END AS route FROM t)
SELECT route, count(*) AS rows, count(DISTINCT id) AS ids, count(*) AS in_range FROM r GROUP BY route""", ops=("M12", "P9"))
def q_routed(spark, sf):
    """Every row scored once, by the model of its route."""
    s = fr.sentinel(spark, sf).withColumnRenamed("y", "label")
    rm = mdl.RoutedModel(fr.SENTINEL_COLS, ["meta"], mdl.tree(max_depth=3), mdl.tree(max_depth=2))
    out = rm.transform(rm.fit(s), s, "id")
    return out.groupBy(F.col("_route").alias("route")).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"),
                                                          F.count_if(F.col("prob").between(0, 1)).alias("in_range"))
