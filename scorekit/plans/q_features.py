"""Queries: feature builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators.cardio import age_band
from . import frames as fr
from .registry import register

W_CARDIO = f"WITH t AS ({fr.CARDIO_SQL})\n"
RANKED = ["ap_hi", "ap_lo", "weight", "height", "age"]


def _band_cols():
    out = []
    for i, a in enumerate(RANKED):
        for b in RANKED[i + 1:i + 3]:
            out.append((a, b))
    return out


@register("band_interactions", "id bigint, " + ", ".join(f"{a}_x_{b} double" for a, b in _band_cols()),
          W_CARDIO + "SELECT id, " + ", ".join(f"CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE) AS {a}_x_{b}" for a, b in _band_cols()) +
          " FROM t", ops=("F30",))
def q_band(spark, sf):
    c = fr.cardio(spark, sf).select("id", *RANKED)
    return fe.band_interactions(c, RANKED, 5, 3, ("mul",))


PAIRS = [("ap_hi", "ap_lo"), ("weight", "height"), ("ap_hi", "missing_col")]


@register("pair_interactions", "id bigint, ap_hi_div_ap_lo double, weight_div_height double, ap_hi_plus_ap_lo double, "
          "weight_minus_height double",
          W_CARDIO + """SELECT id, ap_hi / (ap_lo + 1e-8) AS ap_hi_div_ap_lo, weight / (height + 1e-8) AS weight_div_height,
  CAST(ap_hi AS DOUBLE) + ap_lo AS ap_hi_plus_ap_lo, weight - height AS weight_minus_height FROM t""", ops=("F31",))
def q_pairs(spark, sf):
    c = fr.cardio(spark, sf).select("id", "ap_hi", "ap_lo", "weight", "height")
    d = fe.pair_interactions(c, PAIRS, "div")
    d = fe.pair_interactions(d, [("ap_hi", "ap_lo")], "add")
    return fe.pair_interactions(d, [("weight", "height")], "sub")


@register("unary_pack", "id bigint, ap_lo_log1p_abs double, ap_lo_sqrt_abs double, ap_lo_square double, "
          "weight_log1p_abs double, weight_sqrt_abs double, weight_square double",
          W_CARDIO + """SELECT id, ln(1 + abs(ap_lo)) AS ap_lo_log1p_abs, sqrt(abs(ap_lo)) AS ap_lo_sqrt_abs,
  CAST(ap_lo AS DOUBLE) * ap_lo AS ap_lo_square, ln(1 + abs(weight)) AS weight_log1p_abs, sqrt(abs(weight)) AS weight_sqrt_abs,
  weight * weight AS weight_square FROM t""", ops=("F32",))
def q_unary(spark, sf):
    c = fr.cardio(spark, sf).select("id", "ap_lo", "weight")
    return fe.unary_pack(c, ["ap_lo", "weight"])


def _qbin_sql(cols, q=5):
    edges = ", ".join(f"quantile_cont({c}, [{', '.join(str(i / q) for i in range(q + 1))}]) AS e_{c}" for c in cols)
    parts = []
    for c in cols:
        # distinct sorted edges; code = position of the right-closed interval (first one closed)
        parts.append(f"""(SELECT CASE WHEN t.{c} = ue[1] THEN 0 ELSE
   (SELECT min(i) - 2 FROM generate_series(2, len(ue)) AS g(i) WHERE t.{c} <= ue[i]) END
   FROM (SELECT list_sort(list_distinct(e_{c})) AS ue)) AS {c}_qbin""")
    return W_CARDIO + f", e AS (SELECT {edges} FROM t)\nSELECT id, " + ", ".join(parts) + " FROM t, e"


@register("quantile_bins", "id bigint, weight_qbin bigint, ap_hi_qbin bigint", _qbin_sql(["weight", "ap_hi"]), ops=("F33",))
def q_qbins(spark, sf):
    c = fr.cardio(spark, sf).select("id", "weight", "ap_hi")
    return fe.QuantileBinner(["weight", "ap_hi"], 5).fit(c).transform(c, "_qbin").select("id", "weight_qbin", "ap_hi_qbin")


def _ebin_sql(cols, n=5):
    st = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in cols)
    parts = []
    for c in cols:
        e = [f"(lo_{c} - (hi_{c} - lo_{c}) * 0.001)"] + [f"({i} * ((hi_{c} - lo_{c}) / {n}) + lo_{c})" for i in range(1, n)] + [f"hi_{c}"]
        conds = []
        for i in range(n):
            left = f"t.{c} >= {e[i]}" if i == 0 else f"t.{c} > {e[i]}"
            conds.append(f"WHEN {left} AND t.{c} <= {e[i + 1]} THEN {i}")
        parts.append("CASE " + " ".join(conds) + f" END AS {c}_ebin")
    return W_CARDIO + f", s AS (SELECT {st} FROM t)\nSELECT id, " + ", ".join(parts) + " FROM t, s"


@register("width_bins", "id bigint, weight_ebin bigint, ap_hi_ebin bigint", _ebin_sql(["weight", "ap_hi"]), ops=("F34",))
def q_ebins(spark, sf):
    c = fr.cardio(spark, sf).select("id", "weight", "ap_hi")
    return fe.WidthBinner(["weight", "ap_hi"], 5).fit(c).transform(c, "_ebin").select("id", "weight_ebin", "ap_hi_ebin")


@register("fixed_bins", "id bigint, age_group string, restecg_code bigint",
          W_CARDIO + """, a AS (SELECT id, floor(age / 365) AS age_years, ap_hi / (ap_lo + 1e-06) AS ratio FROM t)
SELECT id, CASE WHEN age_years >= 29 AND age_years <= 40 THEN '29-40' WHEN age_years > 40 AND age_years <= 50 THEN '40-50'
  WHEN age_years > 50 AND age_years <= 60 THEN '50-60' WHEN age_years > 60 AND age_years <= 200 THEN '60+' END AS age_group,
  CASE WHEN ratio > 0 AND ratio <= 1.1 THEN 0 WHEN ratio > 1.1 AND ratio <= 1.4 THEN 1 WHEN ratio > 1.4 AND ratio <= 10 THEN 2 ELSE 1 END AS restecg_code
FROM a""", ops=("F35",))
def q_fixed_bins(spark, sf):
    c = fr.cardio(spark, sf).select("id", F.floor(F.col("age") / 365).alias("age_years"),
                                    (F.col("ap_hi") / (F.col("ap_lo") + 1e-06)).alias("ratio"))
    return c.select("id", age_band("age_years").alias("age_group"),
                    fe.bin_fixed("ratio", [0, 1.1, 1.4, 10], default=1).alias("restecg_code"))


@register("dummies", "id bigint, cholesterol_2 bigint, cholesterol_3 bigint, gluc_2 bigint, gluc_3 bigint",
          W_CARDIO + """SELECT id, CAST(cholesterol = 2 AS INTEGER) AS cholesterol_2, CAST(cholesterol = 3 AS INTEGER) AS cholesterol_3,
  CAST(gluc = 2 AS INTEGER) AS gluc_2, CAST(gluc = 3 AS INTEGER) AS gluc_3 FROM t""", ops=("F36",))
def q_dummies(spark, sf):
    c = fr.cardio(spark, sf).select("id", "cholesterol", "gluc")
    return fe.DummyEncoder(["cholesterol", "gluc"], max_levels=1000).fit(c).transform(c)


@register("target_encode", "id bigint, cholesterol_target_mean double, cholesterol_target_std double",
          W_CARDIO + """, s AS (SELECT cholesterol, avg(CAST(cardio AS DOUBLE)) AS m, stddev_samp(CAST(cardio AS DOUBLE)) AS sd FROM t GROUP BY cholesterol),
g AS (SELECT avg(CAST(cardio AS DOUBLE)) AS gm, stddev_samp(CAST(cardio AS DOUBLE)) AS gs FROM t)
SELECT id, coalesce(m, gm) AS cholesterol_target_mean, coalesce(sd, gs) AS cholesterol_target_std
FROM t LEFT JOIN s USING (cholesterol), g""", ops=("F37", "A17", "J4"))
def q_target_encode(spark, sf):
    c = fr.cardio(spark, sf).select("id", "cholesterol", "cardio")
    return fe.TargetStatEncoder(["cholesterol"], "cardio").fit_transform(c).select(
        "id", "cholesterol_target_mean", "cholesterol_target_std")


FOLD_SQL = """folds AS (SELECT *, (row_number() OVER (PARTITION BY cardio ORDER BY md5('7:' || CAST(id AS VARCHAR)), id) - 1) % 5 AS fold FROM t)"""


@register("target_encode_oof", "id bigint, fold bigint, cholesterol_target_mean double, cholesterol_target_std double",
          W_CARDIO + ", " + FOLD_SQL + """,
tot AS (SELECT cholesterol, count(*) AS n, sum(CAST(cardio AS DOUBLE)) AS s, sum(CAST(cardio AS DOUBLE) * cardio) AS ss FROM folds GROUP BY cholesterol),
per AS (SELECT fold, cholesterol, count(*) AS n, sum(CAST(cardio AS DOUBLE)) AS s, sum(CAST(cardio AS DOUBLE) * cardio) AS ss FROM folds GROUP BY fold, cholesterol),
oof AS (SELECT per.fold, per.cholesterol, tot.n - per.n AS n, tot.s - per.s AS s, tot.ss - per.ss AS ss FROM per JOIN tot USING (cholesterol)),
st AS (SELECT fold, cholesterol, CASE WHEN n > 0 THEN s / n END AS m,
  CASE WHEN n > 1 THEN sqrt(greatest((ss - s * s / n) / (n - 1), 0)) END AS sd FROM oof),
g AS (SELECT avg(CAST(cardio AS DOUBLE)) AS gm, stddev_samp(CAST(cardio AS DOUBLE)) AS gs FROM t)
SELECT id, folds.fold, coalesce(m, gm) AS cholesterol_target_mean, coalesce(sd, gs) AS cholesterol_target_std
FROM folds LEFT JOIN st ON folds.fold = st.fold AND folds.cholesterol = st.cholesterol, g""", ops=("F37", "K2"))
def q_target_encode_oof(spark, sf):
    from ..operators.crossfit import stratified_folds
    c = stratified_folds(fr.cardio(spark, sf).select("id", "cholesterol", "cardio"), "id", "cardio", 5, seed=7)
    return fe.TargetStatEncoder(["cholesterol"], "cardio", fold_col="fold").fit_transform(c).select(
        "id", "fold", "cholesterol_target_mean", "cholesterol_target_std")


@register("group_deviation", "id bigint, bmi_deviation double, bp_deviation double",
          W_CARDIO + """, a AS (SELECT id, gender, ap_hi, weight / pow(height / 100, 2) AS bmi,
  CASE WHEN floor(age / 365) >= 29 AND floor(age / 365) <= 40 THEN '29-40' WHEN floor(age / 365) > 40 AND floor(age / 365) <= 50 THEN '40-50'
  WHEN floor(age / 365) > 50 AND floor(age / 365) <= 60 THEN '50-60' WHEN floor(age / 365) > 60 AND floor(age / 365) <= 200 THEN '60+' END AS age_group FROM t),
g AS (SELECT age_group, gender, avg(bmi) AS mb, avg(ap_hi) AS mh FROM a GROUP BY age_group, gender)
SELECT id, bmi - mb AS bmi_deviation, ap_hi - mh AS bp_deviation FROM a LEFT JOIN g
  ON a.age_group = g.age_group AND a.gender = g.gender""", ops=("F38", "A18"))
def q_group_dev(spark, sf):
    c = fr.cardio(spark, sf)
    a = c.select("id", "gender", "ap_hi", (F.col("weight") / F.pow(F.col("height") / 100, 2)).alias("bmi"),
                 age_band(F.floor(F.col("age") / 365)).alias("age_group"))
    gm = fe.GroupDeviation(["age_group", "gender"], ["bmi", "ap_hi"]).fit(a)
    out = gm.transform(a, {"bmi": "bmi_deviation", "ap_hi": "bp_deviation"})
    return out.select("id", "bmi_deviation", "bp_deviation")


KM_COLS = ["ap_hi", "ap_lo", "weight", "height"]


@register("kmeans_label", "id bigint, kmeans_4 bigint", None, ops=("F40",))
def q_kmeans(spark, sf):
    c = fr.cardio(spark, sf).select("id", *KM_COLS)
    model = fe.ClusterLabel(KM_COLS, 4, scale=True).fit(c)
    return fe.ClusterLabel.transform(model, c).select("id", "kmeans_4")


@register("cluster_distances", "id bigint, cluster bigint, dist_c0 double, dist_c1 double, dist_c2 double", None,
          ops=("F41", "J8"))
def q_cluster_dist(spark, sf):
    c = fr.cardio(spark, sf).select("id", *KM_COLS)
    cd = fe.ClusterDistances(KM_COLS, 3)
    return cd.transform(c, cd.fit(c)).select("id", "cluster", "dist_c0", "dist_c1", "dist_c2")


@register("pca_scores", "id bigint, pca_0 double, pca_1 double", None, ops=("F42",))
def q_pca(spark, sf):
    c = fr.cardio(spark, sf).select("id", *KM_COLS)
    p = fe.CenteredPCA(KM_COLS, 2)
    return p.transform(c, p.fit(c)).select("id", "pca_0", "pca_1")


@register("ica_components", "id bigint, ica_0 double, ica_1 double", None, ops=("F43",))
def q_ica(spark, sf):
    c = fr.cardio(spark, sf).select("id", *KM_COLS)
    ica = fe.IndependentComponents(KM_COLS, 2, max_iter=50)
    return ica.transform(c, ica.fit(c)).select("id", "ica_0", "ica_1")

