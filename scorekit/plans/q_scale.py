"""The same queries on the path of large data: small buckets and blocks, many groups, wide frames.

Each takes the oracle text of the query it repeats; only the plan differs (many value buckets with cut
points per group, the rank by prefix sum instead of a sort with a limit, several k-NN blocks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crossfit as cf
from ..operators import knn
from ..operators import metrics as met
from ..operators import order
from ..operators import profile as pr
from ..operators import select as sel
from . import frames as fr
from . import q_ensemble, q_misc, q_models, q_profile  # noqa: F401  (the queries repeated here)
from .registry import REGISTRY, register
from .sqltext import long_sql


def _schema(name: str) -> str:
    return ", ".join(f"{c} {t}" for c, t in REGISTRY[name].schema)


def _many_buckets(name: str, rows: int) -> None:
    source = REGISTRY[name]

    def build(spark, sf):
        with order.bucket_rows(rows):
            return source.build(spark, sf)
    register(f"{name}_buckets", _schema(name), source.sql, ops=source.ops)(build)


for _name, _rows in (("auc_exact", 50), ("roc_points", 50), ("model_auc", 40), ("quantiles_1_99", 30), ("describe_exact", 30),
                     ("stratified_folds", 60), ("stratified_holdout", 60), ("mutual_info_knn", 40)):
    _many_buckets(_name, _rows)

AUC_BY_USER = f"""WITH s AS ({fr.SCORES_SQL}),
c AS (SELECT grp, p AS score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY grp, p),
w AS (SELECT grp, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
  coalesce(sum(neg) OVER (PARTITION BY grp ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
SELECT grp, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc FROM w GROUP BY grp"""


@register("auc_by_user_buckets", "grp bigint, auc double", AUC_BY_USER, ops=("E2", "W1"))
def q_auc_by_user(spark, sf):
    """Hundreds of groups, each cut into buckets of its own."""
    with order.bucket_rows(3):
        return met.auc_exact(fr.scores(spark, sf), "y", "p", by=["grp"]).select("grp", "auc")


@register("hash_sample_ranked", _schema("hash_sample"), REGISTRY["hash_sample"].sql, ops=("K8", "W3"))
def q_hash_sample(spark, sf):
    with order.bucket_rows(60):
        return cf.hash_sample(fr.cardio(spark, sf).select("id", "cardio"), "id", 1000, seed=42, small_n=10)


TOP_SQL = f"WITH s AS ({fr.SCORES_SQL}) SELECT id, p FROM s ORDER BY p DESC NULLS LAST, id LIMIT 100"


@register("top_k", "id bigint, p double", TOP_SQL, ops=("W2",))
def q_top_k(spark, sf):
    return order.top_k(fr.scores(spark, sf).select("id", "p"), "p", "id", 100)


@register("top_k_ranked", "id bigint, p double", TOP_SQL, ops=("W2",))
def q_top_k_ranked(spark, sf):
    with order.bucket_rows(50):
        return order.top_k(fr.scores(spark, sf).select("id", "p"), "p", "id", 100, small_k=10)


@register("knn_join_blocks", _schema("knn_join"), REGISTRY["knn_join"].sql, ops=("J7",))
def q_knn_blocks(spark, sf):
    q, b = q_models._vec_split(spark, sf)
    return knn.knn_join(q, b, 5, "euclidean", block_rows=max(1, q.count() // 3))


# --- 60 plain columns -----------------------------------------------------------------------

WIDE = [f"w{k:02d}" for k in range(60)]
WIDE_EXPR = {c: f"(l_orderkey * {2 * k + 3} + l_partkey * {k + 1} + l_suppkey * {3 * k + 1}) % {17 + 3 * k}" for k, c in enumerate(WIDE)}
WIDE_SQL = "SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in WIDE_EXPR.items()) + " FROM lineitem"


def wide(spark, sf):
    return fr.table(spark, sf, "lineitem").selectExpr(*[f"cast({e} as double) as {c}" for c, e in WIDE_EXPR.items()])


@register("moments_wide", _schema("moments"), f"WITH t AS ({WIDE_SQL}), lf AS ({long_sql('t', WIDE)})\n" + """
SELECT feature, var_samp(value) AS var, skewness(value) AS skewness, kurtosis(value) AS kurtosis, count(DISTINCT value) AS n_unique
FROM lf GROUP BY feature""", ops=("A3",))
def q_moments_wide(spark, sf):
    return pr.moments(wide(spark, sf), WIDE)


@register("feature_kinds_wide", _schema("feature_kinds"), f"WITH t AS ({WIDE_SQL}), lf AS ({long_sql('t', WIDE)})\n" + """
SELECT feature, count(DISTINCT value) AS n_unique, var_samp(value) AS var,
  CASE WHEN count(DISTINCT value) = 1 THEN 'constant' WHEN count(DISTINCT value) = 2 THEN 'binary'
  WHEN count(DISTINCT value) < 10 THEN 'few' ELSE 'many' END AS kind, CAST(coalesce(var_samp(value) < 0.01, false) AS INTEGER) AS low_variance
FROM lf GROUP BY feature""", ops=("A6", "F25"))
def q_kinds_wide(spark, sf):
    return pr.feature_kinds(wide(spark, sf), WIDE)


_PAIRS = ", ".join(f"corr({a}, {b}) AS {a}_{b}" for i, a in enumerate(WIDE) for b in WIDE[i + 1:])


@register("corr_pairs_wide", "feature_a string, feature_b string, corr double", f"""WITH t AS ({WIDE_SQL}), g AS (SELECT {_PAIRS} FROM t),
u AS (UNPIVOT g ON * INTO NAME pair VALUE corr)
SELECT split_part(pair, '_', 1) AS feature_a, split_part(pair, '_', 2) AS feature_b, corr FROM u""", ops=("A12",))
def q_corr_wide(spark, sf):
    return pr.corr_pairs(wide(spark, sf), WIDE, -1.0)


@register("prune_correlated_wide", "feature string", f"""WITH t AS ({WIDE_SQL}), g AS (SELECT {_PAIRS} FROM t),
u AS (UNPIVOT g ON * INTO NAME pair VALUE corr)
SELECT DISTINCT split_part(pair, '_', 2) AS feature FROM u WHERE abs(corr) > 0.05""", ops=("X5",))
def q_prune_wide(spark, sf):
    return spark.createDataFrame([(c,) for c in sel.prune_correlated(wide(spark, sf), WIDE, 0.05)], "feature string")


@register("null_total", "nulls bigint, null_share double", f"""WITH t AS ({q_profile.DOCS_LEFT_SQL})
SELECT count(*) * 3 - count(quality) - count(toxic) - count(n_chars) AS nulls,
  (count(*) * 3 - count(quality) - count(toxic) - count(n_chars)) / (count(*) * 3.0) AS null_share FROM t""", ops=("A4",))
def q_null_total(spark, sf):
    return pr.null_total(q_profile.docs_left(spark, sf), ["quality", "toxic", "n_chars"])


@register("crosstab_unlabelled", "category string, label bigint, n bigint",
          f"WITH t AS ({q_profile.DOCS_LEFT_SQL}) SELECT lang AS category, coalesce(quality, -1) AS label, count(*) AS n FROM t GROUP BY 1, 2",
          ops=("A22",))
def q_crosstab_left(spark, sf):
    d = q_profile.docs_left(spark, sf).withColumn("quality", F.coalesce("quality", F.lit(-1)))
    return pr.crosstab_long(d, "lang", "quality")
