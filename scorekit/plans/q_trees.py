"""Queries: second-order boosting (M1), extra-randomised trees (M3), ordered target statistics (M15), pruned and approximate
k-NN joins (J7), isotonic steps of many buckets (B15). Trees over fixed cuts are the same in SQL, node by node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import boosting as bo
from ..operators import crossfit as cf
from ..operators import extratrees as et
from ..operators import features as fe
from ..operators import knn
from ..operators import models as mdl
from ..operators import order
from ..operators import select as sel
from . import q_contracts as qc
from . import q_models
from .registry import REGISTRY, register

CUTS = {"weight": [70, 100, 130], "ap_hi": [110, 140, 170, 200, 230], "ap_lo": [60, 90, 120], "cholesterol": [1, 2]}
TABLE = "tree bigint, node bigint, feature string, cut double, missing_left bigint, gain double, value double, rows bigint"


def _bins(cuts: dict) -> str:
    """Bin of each feature: 0 for a missing value, else 1 + the number of cuts below it."""
    return ", ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 + " + " + ".join(f"CAST({c} > {v} AS INTEGER)" for v in vs) + f" END AS b{k}"
                     for k, (c, vs) in enumerate(cuts.items()))


def boost_sql(cuts: dict, rounds: int, depth: int, rate: float, l1: float, l2: float, min_gain: float, min_hessian: float, scores: bool = False) -> str:
    """Gradient boosting of second order in SQL: a chain of histograms, best cuts and moved rows for each level of each round."""
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - {l1}, 0))"
    part = lambda g, h: f"({soft(g)} * {soft(g)} / ({h} + {l2}))"
    n = len(cuts)
    cols = ", ".join(f"b{k}" for k in range(n))
    sql = [f"t AS MATERIALIZED ({qc.PATIENT_SQL})",
           f"s0 AS MATERIALIZED (SELECT id, CAST(label AS DOUBLE) AS y, {_bins(cuts)}, (SELECT ln(avg(label) / (1 - avg(label))) FROM t) AS m FROM t)"]
    found = []
    limit = "CASE f " + " ".join(f"WHEN {k} THEN {len(v)}" for k, v in enumerate(cuts.values())) + " END"
    name = "CASE f " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(cuts)) + " END"
    value = "CASE f " + " ".join(f"WHEN {k} THEN CASE b " + " ".join(f"WHEN {j + 1} THEN {v}" for j, v in enumerate(vs)) + " END" for k, vs in enumerate(cuts.values())) + " END"
    for r in range(rounds):
        sql.append(f"n{r}_0 AS MATERIALIZED (SELECT *, 1 / (1 + exp(-m)) - y AS g, 1 / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m))) AS h, 0 AS node FROM s{r})")
        for lv in range(depth):
            x = f"{r}_{lv}"
            long = " UNION ALL ".join(f"SELECT node, {k} AS f, b{k} AS b, g, h FROM n{x} WHERE node >= {2**lv - 1}" for k in range(n))
            sums = ", ".join(f"sum({c}) OVER (PARTITION BY node, f ORDER BY b) AS {c}l, sum({c}) OVER (PARTITION BY node, f) AS {c}t, "
                             f"coalesce(sum(CASE WHEN b = 0 THEN {c} END) OVER (PARTITION BY node, f), 0) AS {c}m" for c in ("g", "h", "q"))
            less = ", ".join(f"{c}l - (1 - d) * {c}m AS {c}l, {c}t" for c in ("g", "h", "q"))
            gain = f"round(0.5 * ({part('gl', 'hl')} + {part('(gt - gl)', '(ht - hl)')} - {part('gt', 'ht')}), 9)"
            sql += [f"c{x} AS (SELECT node, f, b, sum(g) AS g, sum(h) AS h, count(*) AS q FROM ({long}) GROUP BY node, f, b)",
                    f"w{x} AS (SELECT node, f, b, {sums} FROM c{x})",
                    f"e{x} AS (SELECT node, f, b, d, {less} FROM w{x}, (VALUES (1), (0)) AS dirs(d))",
                    f"p{x} AS MATERIALIZED (SELECT * FROM (SELECT *, {gain} AS gain FROM e{x} WHERE b >= 1 AND b <= {limit} AND hl >= {min_hessian} "
                    f"AND ht - hl >= {min_hessian} AND ql > 0 AND qt > ql QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b, d DESC) = 1) "
                    f"WHERE gain > {min_gain})"]
            own = "CASE p.f " + " ".join(f"WHEN {k} THEN n.b{k}" for k in range(n)) + " END"
            sql.append(f"n{r}_{lv + 1} AS MATERIALIZED (SELECT n.* REPLACE (CASE WHEN p.node IS NULL THEN n.node WHEN CASE WHEN {own} = 0 THEN p.d = 1 ELSE {own} <= p.b END "
                       f"THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node) FROM n{x} n LEFT JOIN p{x} p ON p.node = n.node AND n.node >= {2**lv - 1})")
            found.append(f"SELECT {r} AS tree, node, {name} AS feature, CAST({value} AS DOUBLE) AS cut, d AS missing_left, gain, NULL AS value, qt AS rows FROM p{x}")
        sql += [f"v{r} AS MATERIALIZED (SELECT node, -{rate} * {soft('sum(g)')} / (sum(h) + {l2}) AS value, count(*) AS rows FROM n{r}_{depth} GROUP BY node)",
                f"s{r + 1} AS MATERIALIZED (SELECT id, y, {cols}, m + value AS m FROM n{r}_{depth} JOIN v{r} USING (node))"]
        found.append(f"SELECT {r} AS tree, node, NULL, NULL, NULL, 0 AS gain, value, rows FROM v{r}")
    out = f"SELECT id, 1 / (1 + exp(-m)) AS prob FROM s{rounds}" if scores else "\nUNION ALL ".join(found)
    return "WITH " + ",\n".join(sql) + "\n" + out


def _nodes(spark, model) -> DataFrame:
    """Nodes with their cut, leaves with their value."""
    return model.table(spark).withColumn("value", F.when(F.col("feature").isNull(), F.col("value")))


PLAIN = dict(rounds=2, depth=3, rate=0.3, l1=0.0, l2=1.0, min_gain=0.0, min_hessian=1.0)
PENALISED = dict(rounds=3, depth=2, rate=0.5, l1=20.0, l2=50.0, min_gain=5.0, min_hessian=10.0)


def _boosted(spark, sf, how: dict):
    p = qc.patient(spark, sf)
    return p, bo.GradientBoosting(cuts=list(CUTS.values()), feature_cols=list(CUTS), id_col="id", **how).fit(p)


@register("boost_nodes", TABLE, boost_sql(CUTS, **PLAIN), ops=("M1",))
def q_boost_nodes(spark, sf):
    """Every node of two trees over fixed cuts, gaps in two features."""
    return _nodes(spark, _boosted(spark, sf, PLAIN)[1])


@register("boost_nodes_penalised", TABLE, boost_sql(CUTS, **PENALISED), ops=("M1",))
def q_boost_penalised(spark, sf):
    """L1 and L2 penalties, a least gain and a least hessian."""
    return _nodes(spark, _boosted(spark, sf, PENALISED)[1])


@register("boost_scores", "id bigint, prob double", boost_sql(CUTS, scores=True, **PENALISED), ops=("M1",))
def q_boost_scores(spark, sf):
    p, model = _boosted(spark, sf, PENALISED)
    return model.transform(p).select("id", F.col("prediction").alias("prob"))


@register("contract_boosting", qc.CONTRACT, qc.contract_sql("boosting", 3), ops=("M1", "K3"))
def q_contract_boosting(spark, sf):
    """Cross-fitted on raw columns with gaps, row and column samples, rounds stopped early on rows of the training part."""
    p = cf.stratified_folds(qc.patient(spark, sf), "id", "label", 3, 42).withColumn("held", F.crc32(F.col("id").cast("string")) % 5 == 0)
    make = bo.second_order(rounds=5, depth=3, rate=0.5, l1=0.1, l2=2.0, row_share=0.8, column_share=0.8, feature_cols=qc.COLS, validation_col="held",
                           patience=3, id_col="id")
    return qc._contract("boosting", cf.cross_fit(p, make, "id", "label", "fold", "boosting")[0], 0.9, 3)


def _importance_sql(how: dict) -> str:
    names = " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in CUTS)
    return f"""SELECT f.feature, coalesce(g.s, 0) / (SELECT sum(gain) FROM ({boost_sql(CUTS, **how)}) AS nodes WHERE feature IS NOT NULL) AS importance
FROM ({names}) f LEFT JOIN (SELECT feature, sum(gain) AS s FROM ({boost_sql(CUTS, **how)}) AS nodes WHERE feature IS NOT NULL GROUP BY feature) g USING (feature)"""


@register("importance_top_boosted", "feature string, importance double",
          f"SELECT * FROM ({_importance_sql(PLAIN)}) AS i ORDER BY importance DESC, feature LIMIT 3", ops=("X3", "M1"))
def q_importance_boosted(spark, sf):
    """Shares of the gain, the three largest."""
    return sel.select_by_importance(spark, _boosted(spark, sf, PLAIN)[1], list(CUTS), 3)


@register("prune_least_boosted", "feature string", f"""WITH i AS ({_importance_sql(PLAIN)} UNION ALL {_importance_sql(PENALISED)})
SELECT feature FROM (SELECT feature, avg(importance) AS imp FROM i GROUP BY feature) ORDER BY imp, feature LIMIT 2""", ops=("X6", "M1"))
def q_prune_boosted(spark, sf):
    """The two of four features with the least mean importance of two models."""
    rows = [(n, v) for how in (PLAIN, PENALISED) for n, v in sel.importance_table(_boosted(spark, sf, how)[1], list(CUTS))]
    return spark.createDataFrame([(f,) for f in sel.prune_least_important(spark.createDataFrame(rows, "feature string, importance double"), 0.5)], "feature string")


# --- M3 ---------------------------------------------------------------------------------------

ET_COLS = ["age", "ap_lo", "cholesterol", "weight"]


def _unit(*parts: str) -> str:
    """A number from 0 to 1 by md5 of the parts joined by colons."""
    return "CAST('0x' || substr(md5(" + " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "), 1, 13) AS BIGINT) / 4503599627370496.0"


def extra_sql(cols, n_trees: int, depth: int, per_node: int, min_split: int, min_leaf: int, seed: int) -> str:
    """Extra-randomised trees in SQL: candidate features and cuts by hash, class counts on both sides, the best by Gini."""
    n = len(cols)
    sql = [f"t AS MATERIALIZED ({qc.PATIENT_SQL})",
           f"n0 AS MATERIALIZED (SELECT tree, id, label, {', '.join(f'CAST({c} AS DOUBLE) AS x{k}' for k, c in enumerate(cols))}, 0 AS node FROM t, "
           f"(SELECT unnest(range({n_trees})) AS tree))"]
    gini = lambda a, m: f"(2 * ({a} / {m}) * (1 - {a} / {m}))"
    found = []
    for lv in range(depth):
        open_ = f"(SELECT tree, node FROM n{lv} WHERE node >= {2**lv - 1} GROUP BY tree, node HAVING count(*) >= {min_split} AND min(label) < max(label))"
        long = " UNION ALL ".join(f"SELECT tree, node, {k} AS f, x{k} AS x, label FROM n{lv}" for k in range(n))
        sql += [f"k{lv} AS (SELECT tree, node, f FROM {open_}, (SELECT unnest(range({n})) AS f) "
                f"QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY {_unit(str(seed), 'tree', 'node', repr('pick'), 'f')}, f) <= {per_node})",
                f"l{lv} AS MATERIALIZED (SELECT tree, node, f, x, label FROM ({long}) SEMI JOIN k{lv} USING (tree, node, f))",
                f"r{lv} AS MATERIALIZED (SELECT tree, node, f, min(x) + {_unit(str(seed), 'tree', 'node', 'f')} * (max(x) - min(x)) AS cut FROM l{lv} "
                f"GROUP BY tree, node, f HAVING min(x) < max(x))",
                f"c{lv} AS (SELECT tree, node, f, cut, CAST(sum(CASE WHEN x <= cut THEN 1 ELSE 0 END) AS DOUBLE) AS nl, CAST(sum(CASE WHEN x <= cut THEN label ELSE 0 END) AS DOUBLE) AS yl, "
                f"CAST(count(*) AS DOUBLE) AS nt, CAST(sum(label) AS DOUBLE) AS yt FROM l{lv} JOIN r{lv} USING (tree, node, f) GROUP BY tree, node, f, cut)",
                f"p{lv} AS MATERIALIZED (SELECT *, round({gini('yt', 'nt')} - (nl * {gini('yl', 'nl')} + (nt - nl) * {gini('(yt - yl)', '(nt - nl)')}) / nt, 9) AS gain "
                f"FROM c{lv} WHERE nl >= {min_leaf} AND nt - nl >= {min_leaf} QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f) = 1)"]
        own = "CASE p.f " + " ".join(f"WHEN {k} THEN n.x{k}" for k in range(n)) + " END"
        sql.append(f"n{lv + 1} AS MATERIALIZED (SELECT n.* REPLACE (CASE WHEN p.node IS NULL THEN n.node WHEN coalesce({own} <= p.cut, false) THEN 2 * n.node + 1 "
                   f"ELSE 2 * n.node + 2 END AS node) FROM n{lv} n LEFT JOIN p{lv} p ON p.tree = n.tree AND p.node = n.node AND n.node >= {2**lv - 1})")
        name = "CASE f " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(cols)) + " END"
        found.append(f"SELECT tree, node, {name} AS feature, cut, 0 AS missing_left, gain, NULL AS value, CAST(nt AS BIGINT) AS rows FROM p{lv}")
    found.append(f"SELECT tree, node, NULL, NULL, NULL, 0, avg(CAST(label AS DOUBLE)), count(*) FROM n{depth} GROUP BY tree, node")
    return "WITH " + ",\n".join(sql) + "\n" + "\nUNION ALL ".join(found)


EXTRA = dict(n_trees=3, depth=3, per_node=2, min_split=20, min_leaf=5, seed=42)


@register("extra_trees_nodes", TABLE, extra_sql(ET_COLS, **EXTRA), ops=("M3",))
def q_extra_nodes(spark, sf):
    """Every node of three trees, a feature with gaps among them."""
    return _nodes(spark, et.ExtraTrees(feature_cols=ET_COLS, **EXTRA).fit(qc.patient(spark, sf)))


@register("contract_randomised", qc.CONTRACT, qc.contract_sql("randomised", 3), ops=("M3", "K3"))
def q_contract_randomised(spark, sf):
    p = cf.stratified_folds(qc.patient(spark, sf), "id", "label", 3, 42)
    make = et.randomised(n_trees=16, depth=6, per_node=3, feature_cols=qc.COLS)
    return qc._contract("randomised", cf.cross_fit(p, make, "id", "label", "fold", "randomised")[0], 0.85, 3)


# --- M15 --------------------------------------------------------------------------------------

_ORDERED = """(coalesce(sum(label) OVER w, 0) + 2.0 * (SELECT avg(label) FROM t)) / (count(label) OVER w + 2.0)"""
ORDERED_SQL = qc.W + f"""SELECT id, ward, {_ORDERED} AS ward_ordered_mean FROM t
WINDOW w AS (PARTITION BY ward ORDER BY md5('42:' || CAST(id AS VARCHAR)), id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@register("ordered_target_encode", "id bigint, ward string, ward_ordered_mean double", ORDERED_SQL, ops=("M15", "F37"))
def q_ordered(spark, sf):
    """No row sees its own label."""
    return fe.OrderedTargetEncoder(["ward"], "label", "id", 42, 2.0).fit_transform(qc.patient(spark, sf)).select("id", "ward", "ward_ordered_mean")


@register("ordered_target_encode_buckets", "id bigint, ward string, ward_ordered_mean double", ORDERED_SQL, ops=("M15", "W1"))
def q_ordered_buckets(spark, sf):
    with order.bucket_rows(40):
        return q_ordered(spark, sf)


@register("ordered_target_score", "id bigint, ward_ordered_mean double", qc.W + """, g AS (SELECT ward, (sum(label) + 2.0 * (SELECT avg(label) FROM t)) / (count(*) + 2.0) AS e
FROM t WHERE id % 3 <> 0 AND ward <> 'w7' GROUP BY ward),
a AS (SELECT avg(label) AS m FROM t WHERE id % 3 <> 0 AND ward <> 'w7'),
h AS (SELECT ward, (sum(label) + 2.0 * (SELECT m FROM a)) / (count(*) + 2.0) AS e FROM t WHERE id % 3 <> 0 AND ward <> 'w7' GROUP BY ward)
SELECT id, coalesce(h.e, (SELECT m FROM a)) AS ward_ordered_mean FROM t LEFT JOIN h USING (ward) WHERE id % 3 = 0""", ops=("M15",))
def q_ordered_score(spark, sf):
    """Scoring rows get the statistics of all training rows, an unseen category the mean."""
    p = qc.patient(spark, sf)
    fitted = fe.OrderedTargetEncoder(["ward"], "label", "id", 42, 2.0).fit(p.where("id % 3 <> 0 and ward <> 'w7'"))
    return fitted.transform(p.where("id % 3 = 0")).select("id", "ward_ordered_mean")


# --- J7, B15 ----------------------------------------------------------------------------------

_KNN = ", ".join(f"{c} {t}" for c, t in REGISTRY["knn_join"].schema)


@register("knn_join_pruned", _KNN, REGISTRY["knn_join"].sql, ops=("J7",))
def q_knn_pruned(spark, sf):
    q, b = q_models._vec_split(spark, sf)
    return knn.knn_pruned(q, b, 5, "euclidean", pivots=16, cell_rows=40)[0]


@register("contract_knn_approx", "queries bigint, found bigint, good bigint",
          "SELECT count(*) AS queries, 5 * count(*) AS found, 1 AS good FROM embeddings WHERE vec_id % 10 = 0", ops=("J7",))
def q_knn_approx(spark, sf):
    """Five neighbours for every query, nine tenths of them the exact ones."""
    q, b = q_models._vec_split(spark, sf)
    near = knn.knn_approx(q, b, 5, "euclidean", bucket_rows=max(20, b.count() // 16))
    exact = knn.knn_join(q, b, 5, "euclidean")
    both = near.select("qid", "bid").join(exact.select("qid", "bid"), ["qid", "bid"], "left_semi").count()
    return near.agg(F.countDistinct("qid").alias("queries"), F.count(F.lit(1)).alias("found")).withColumn("good", F.lit(int(both >= 0.9 * 5 * q.count())))


def isotonic_sql(score: str) -> str:
    """Max-min formula of isotonic means over pooled scores."""
    return qc.W + f""", s AS (SELECT CAST({score} AS DOUBLE) AS x, CAST(label AS DOUBLE) AS y FROM t WHERE {score} IS NOT NULL),
g AS (SELECT x, sum(y) AS s, count(*) AS w FROM s GROUP BY x),
c AS (SELECT x, sum(s) OVER (ORDER BY x) AS cs, sum(w) OVER (ORDER BY x) AS cw, s, w FROM g),
r AS (SELECT a.x AS lo, b.x AS hi, (b.cs - a.cs + a.s) / (b.cw - a.cw + a.w) AS m FROM c a JOIN c b ON b.x >= a.x),
u AS (SELECT g.x, r.lo, min(r.m) AS m FROM g JOIN r ON r.lo <= g.x AND r.hi >= g.x GROUP BY g.x, r.lo)
SELECT x AS prob, max(m) AS calibrated FROM u GROUP BY x"""


@register("isotonic_buckets", "prob double, calibrated double", isotonic_sql("ap_hi // 2"), ops=("B15",))
def q_isotonic_buckets(spark, sf):
    """A hundred scores in buckets of seven: pooled in each, then over shifted pieces."""
    with order.bucket_rows(7):
        s = qc.patient(spark, sf).where("ap_hi is not null").select(F.floor(F.col("ap_hi") / 2).cast("double").alias("prob"), "label")
        return mdl.apply_calibration(mdl.calibrate_isotonic(s), s.select("prob").distinct()).select("prob", "calibrated")
