"""Queries: profiling and statistics (A*), sentinel classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as pr
from . import frames as fr
from .registry import register
from .sqltext import long_sql, per_feature, qi

NUM = fr.NUMERIC_COLS
W_NUM = f"WITH t AS ({fr.NUMERIC_SQL}),\nlf AS ({long_sql('t', NUM)})\n"
W_NUM_Y = f"WITH t AS ({fr.NUMERIC_SQL}),\nlf AS ({long_sql('t', NUM, keep=['y'])})\n"
W_CARDIO = f"WITH t AS ({fr.CARDIO_SQL})\n"
CARDIO_CODES = ["cholesterol", "gluc", "gender", "smoke", "alco", "active"]
CARDIO_MEASURES = ["height", "weight", "ap_hi", "ap_lo", "age"]


@register("value_counts", "value bigint, n bigint, share double",
          W_CARDIO + "SELECT cholesterol AS value, count(*) AS n, count(*) / sum(count(*)) OVER () AS share "
          "FROM t WHERE cholesterol IS NOT NULL GROUP BY cholesterol", ops=("A1",))
def q_value_counts(spark, sf):
    return pr.value_counts(fr.cardio(spark, sf), "cholesterol")


@register("crosstab_long", "category string, label bigint, n bigint",
          f"WITH t AS ({fr.DOCS_SQL}) SELECT lang AS category, quality AS label, count(*) AS n FROM t GROUP BY 1, 2",
          ops=("A22",))
def q_crosstab(spark, sf):
    return pr.crosstab_long(fr.docs(spark, sf), "lang", "quality")


@register("mode_value", "feature string, mode double, mode_count bigint",
          W_CARDIO + f", lf AS ({long_sql('t', CARDIO_CODES + ['height'])}),\n" + """c AS (SELECT feature, value, count(*) AS n FROM lf GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rn FROM c)
SELECT feature, value AS mode, n AS mode_count FROM r WHERE rn = 1""", ops=("A24",))
def q_mode(spark, sf):
    return pr.mode_value(fr.cardio(spark, sf), CARDIO_CODES + ["height"])


@register("describe_exact", "feature string, count bigint, mean double, std double, min double, q25 double, "
          "q50 double, q75 double, max double",
          W_NUM + """SELECT feature, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
  quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, max(value) AS max
FROM lf GROUP BY feature""", ops=("A2", "W1"))
def q_describe(spark, sf):
    return pr.describe_exact(fr.numeric(spark, sf), NUM)


@register("moments", "feature string, var double, skewness double, kurtosis double, n_unique bigint",
          W_NUM + """SELECT feature, var_samp(value) AS var, skewness(value) AS skewness, kurtosis(value) AS kurtosis,
  count(DISTINCT value) AS n_unique FROM lf GROUP BY feature""", ops=("A3",))
def q_moments(spark, sf):
    return pr.moments(fr.numeric(spark, sf), NUM)


DOCS_LEFT_SQL = """SELECT d.doc_id, d.n_chars, d.lang, d.source, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def docs_left(spark, sf):
    d = fr.table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    return d.join(fr.table(spark, sf, "labels"), "doc_id", "left")


@register("null_counts", "feature string, nulls bigint, null_share double",
          f"WITH t AS ({DOCS_LEFT_SQL})\n" + per_feature(
              "t", ["quality", "toxic", "n_chars"], "count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
              "count(*) FILTER (WHERE {c} IS NULL) / count(*) AS null_share"), ops=("A4",))
def q_null_counts(spark, sf):
    return pr.null_counts(docs_left(spark, sf), ["quality", "toxic", "n_chars"])


@register("table_summary", "column string, type string, kind string, non_null bigint, rows bigint",
          f"WITH t AS ({DOCS_LEFT_SQL})\n" + "\nUNION ALL ".join(
              f"SELECT '{c}' AS column, '{ty}' AS type, '{k}' AS kind, count({qi(c)}) AS non_null, count(*) AS rows FROM t"
              for c, ty, k in (("doc_id", "bigint", "numeric"), ("n_chars", "bigint", "numeric"),
                               ("lang", "string", "other"), ("source", "string", "other"),
                               ("quality", "int", "numeric"), ("toxic", "int", "numeric"))), ops=("A29", "P1"))
def q_table_summary(spark, sf):
    return pr.table_summary(docs_left(spark, sf))


@register("feature_kinds", "feature string, n_unique bigint, var double, kind string, low_variance bigint",
          W_CARDIO + "," + f" lf AS ({long_sql('t', CARDIO_CODES + CARDIO_MEASURES)})\n" + """SELECT feature, count(DISTINCT value) AS n_unique,
  var_samp(value) AS var, CASE WHEN count(DISTINCT value) = 1 THEN 'constant' WHEN count(DISTINCT value) = 2 THEN 'binary'
  WHEN count(DISTINCT value) < 10 THEN 'few' ELSE 'many' END AS kind, CAST(coalesce(var_samp(value) < 0.01, false) AS INTEGER) AS low_variance
FROM lf GROUP BY feature""", ops=("A6",))
def q_feature_kinds(spark, sf):
    return pr.feature_kinds(fr.cardio(spark, sf), CARDIO_CODES + CARDIO_MEASURES)


@register("near_constant", "feature string, top_share double, near_constant bigint",
          W_CARDIO + "," + f" lf AS ({long_sql('t', CARDIO_CODES)}),\n" + """c AS (SELECT feature, value, count(*) AS n FROM lf GROUP BY 1, 2)
SELECT feature, max(n) / sum(n) AS top_share, CAST(max(n) / sum(n) > 0.99 AS INTEGER) AS near_constant FROM c GROUP BY feature""",
          ops=("A7",))
def q_near_constant(spark, sf):
    return pr.near_constant(fr.cardio(spark, sf), CARDIO_CODES)


@register("quantiles_1_99", "feature string, prob double, value double",
          W_NUM + """SELECT feature, 0.01 AS prob, quantile_cont(value, 0.01) AS value FROM lf GROUP BY feature
UNION ALL SELECT feature, 0.99, quantile_cont(value, 0.99) FROM lf GROUP BY feature""", ops=("A19",))
def q_quantiles(spark, sf):
    return pr.quantiles(fr.numeric(spark, sf), NUM, [0.01, 0.99])


W_SENT = f"WITH t AS ({fr.SENTINEL_SQL})\n"


@register("sentinel_profile", "feature string, sentinel_count bigint, sentinel_pct double",
          W_SENT + ", p AS (" + per_feature("t", fr.SENTINEL_COLS, "count(*) FILTER (WHERE {c} = 999) AS sentinel_count, "
                                            "count(*) FILTER (WHERE {c} = 999) * 100.0 / count(*) AS sentinel_pct") +
          ")\nSELECT * FROM p WHERE sentinel_count > 0", ops=("A5",))
def q_sentinel_profile(spark, sf):
    return pr.sentinel_profile(fr.sentinel(spark, sf), fr.SENTINEL_COLS)


SENT_HITS = " + ".join(f"CAST(coalesce({c} = 999, false) AS INTEGER)" for c in fr.SENTINEL_COLS)


@register("sentinel_class_counts", "row_type string, label bigint, n bigint",
          W_SENT + f"""SELECT CASE WHEN {SENT_HITS} = {len(fr.SENTINEL_COLS)} THEN 'all' WHEN {SENT_HITS} > 0 THEN 'partial'
  ELSE 'none' END AS row_type, y AS label, count(*) AS n FROM t GROUP BY 1, 2""", ops=("P8", "R4", "A5"))
def q_sentinel_classes(spark, sf):
    return pr.sentinel_class_counts(fr.sentinel(spark, sf), fr.SENTINEL_COLS, 999, "y")


QB = """q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY feature),
b AS (SELECT feature, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)"""


@register("iqr_outliers", "feature string, outliers bigint, outlier_pct double, lower double, upper double",
          W_CARDIO + "," + f" lf AS ({long_sql('t', CARDIO_MEASURES)}),\n" + QB + """,
o AS (SELECT b.feature, count(*) FILTER (WHERE lf.value < b.lower OR lf.value > b.upper) AS outliers,
  (SELECT count(*) FROM t) AS rows, b.lower, b.upper FROM b JOIN lf ON lf.feature = b.feature GROUP BY b.feature, b.lower, b.upper)
SELECT feature, outliers, outliers * 100.0 / rows AS outlier_pct, lower, upper FROM o WHERE outliers > 0""", ops=("A8",))
def q_iqr(spark, sf):
    return pr.iqr_outliers(fr.cardio(spark, sf), CARDIO_MEASURES)


@register("box_summary", "label bigint, feature string, q1 double, median double, q3 double, whisker_low double, "
          "whisker_high double, outliers bigint",
          W_NUM_Y + """, q AS (SELECT y, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY y, feature),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT b.y AS label, b.feature, b.q1, b.median, b.q3, min(lf.value) FILTER (WHERE lf.value >= b.lower) AS whisker_low,
  max(lf.value) FILTER (WHERE lf.value <= b.upper) AS whisker_high,
  count(*) FILTER (WHERE lf.value < b.lower OR lf.value > b.upper) AS outliers
FROM b JOIN lf ON lf.y = b.y AND lf.feature = b.feature GROUP BY b.y, b.feature, b.q1, b.median, b.q3""", ops=("A21",))
def q_box(spark, sf):
    return pr.box_summary(fr.numeric(spark, sf), NUM, by=["y"]).withColumnRenamed("y", "label")


@register("class_ranges", "label bigint, feature string, min double, max double, mean double, median double, std double",
          W_NUM_Y + """SELECT y AS label, feature, min(value) AS min, max(value) AS max, avg(value) AS mean,
  quantile_cont(value, 0.5) AS median, stddev_samp(value) AS std FROM lf GROUP BY y, feature""", ops=("A9",))
def q_class_ranges(spark, sf):
    return pr.class_ranges(fr.numeric(spark, sf), NUM, "y")


@register("class_variance_ratio", "feature string, var_0 double, var_1 double, variance_ratio double",
          W_NUM_Y + """, v AS (SELECT feature, y, var_samp(value) AS var FROM lf GROUP BY feature, y)
SELECT feature, max(var) FILTER (WHERE y = 0) AS var_0, max(var) FILTER (WHERE y = 1) AS var_1,
  max(var) / (min(var) + 1e-10) AS variance_ratio FROM v GROUP BY feature""", ops=("A10",))
def q_var_ratio(spark, sf):
    return pr.class_variance_ratio(fr.numeric(spark, sf), NUM, "y")


@register("ttest", "feature string, mean_class_0 double, mean_class_1 double, t_statistic double, dof double",
          W_NUM_Y + """, m AS (SELECT feature, y, count(value) AS n, avg(value) AS mean, var_samp(value) AS var FROM lf GROUP BY feature, y),
g AS (SELECT feature, max(n) FILTER (WHERE y = 0) AS n0, max(n) FILTER (WHERE y = 1) AS n1,
  max(mean) FILTER (WHERE y = 0) AS m0, max(mean) FILTER (WHERE y = 1) AS m1,
  max(var) FILTER (WHERE y = 0) AS v0, max(var) FILTER (WHERE y = 1) AS v1 FROM m GROUP BY feature)
SELECT feature, m0 AS mean_class_0, m1 AS mean_class_1,
  (m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)) AS t_statistic,
  CAST(n0 + n1 - 2 AS DOUBLE) AS dof FROM g""", ops=("A11",))
def q_ttest(spark, sf):
    return pr.ttest(fr.numeric(spark, sf), NUM, "y")


# p = 1 - 2 * (integral of the t density from 0 to |t|), by Simpson's rule with 4000 steps
TTEST_P_SQL = W_NUM_Y + """, m AS (SELECT feature, y, count(value) AS n, avg(value) AS mean, var_samp(value) AS var FROM lf GROUP BY feature, y),
g AS (SELECT a.feature, (a.mean - b.mean) / sqrt(((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)) AS t,
  CAST(a.n + b.n - 2 AS DOUBLE) AS v FROM m a JOIN m b ON a.feature = b.feature AND a.y = 0 AND b.y = 1),
x AS (SELECT feature, t, v, i, abs(t) / 4000 AS h, i * abs(t) / 4000 AS x FROM g, range(4001) r(i)),
f AS (SELECT feature, t, h, CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END *
  exp(lgamma((v + 1) / 2) - lgamma(v / 2) - 0.5 * ln(v * pi()) - (v + 1) / 2 * ln(1 + x * x / v)) AS y FROM x),
p AS (SELECT feature, t, 1 - 2 * sum(y) * h / 3 AS p FROM f GROUP BY feature, t, h)
SELECT feature, t AS t_statistic, greatest(p, 0) AS p_value, CAST(p < 0.05 AS INTEGER) AS significant FROM p"""


@register("ttest_pvalues", "feature string, t_statistic double, p_value double, significant bigint", TTEST_P_SQL, ops=("A11",))
def q_ttest_p(spark, sf):
    return pr.t_pvalues(pr.ttest(fr.numeric(spark, sf), NUM, "y"))


@register("anova_f", "feature string, f_score double",
          W_NUM_Y + """, m AS (SELECT feature, y, count(value) AS n, avg(value) AS mean, var_samp(value) AS var FROM lf GROUP BY feature, y),
g AS (SELECT feature, sum(n) AS N, count(*) AS k, sum(n * mean) AS S, sum(n * mean * mean) AS SS,
  sum((n - 1) * coalesce(var, 0)) AS ssw FROM m GROUP BY feature)
SELECT feature, ((SS - S * S / N) / (k - 1)) / (ssw / (N - k)) AS f_score FROM g""", ops=("A16",))
def q_anova(spark, sf):
    return pr.anova_f(fr.numeric(spark, sf), NUM, "y")


@register("corr_pairs", "feature_a string, feature_b string, corr double",
          f"WITH t AS ({fr.NUMERIC_SQL})\n" + "\nUNION ALL ".join(
              f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM t"
              for i, a in enumerate(NUM) for b in NUM[i + 1:]), ops=("A12",))
def q_corr_pairs(spark, sf):
    return pr.corr_pairs(fr.numeric(spark, sf), NUM, 0.0)


@register("target_corr", "feature string, corr double, abs_corr double",
          W_CARDIO + per_feature("t", CARDIO_CODES + CARDIO_MEASURES,
                                 "corr(CAST({c} AS DOUBLE), CAST(cardio AS DOUBLE)) AS corr, "
                                 "abs(corr(CAST({c} AS DOUBLE), CAST(cardio AS DOUBLE))) AS abs_corr"), ops=("A13",))
def q_target_corr(spark, sf):
    return pr.target_corr(fr.cardio(spark, sf), CARDIO_CODES + CARDIO_MEASURES, "cardio")


@register("mutual_info_discrete", "feature string, mi double",
          W_CARDIO + "," + f" lf AS ({long_sql('t', CARDIO_CODES, keep=['cardio'])}),\n" + """j AS (SELECT feature, value, cardio AS y, count(*) AS nxy FROM lf GROUP BY 1, 2, 3),
x AS (SELECT feature, value, sum(nxy) AS nx FROM j GROUP BY 1, 2),
yy AS (SELECT feature, y, sum(nxy) AS ny FROM j GROUP BY 1, 2),
n AS (SELECT feature, sum(ny) AS n FROM yy GROUP BY 1)
SELECT j.feature, sum((CAST(nxy AS DOUBLE) / n) * ln(CAST(nxy AS DOUBLE) * n / (CAST(nx AS DOUBLE) * ny))) AS mi
FROM j JOIN x USING (feature, value) JOIN yy USING (feature, y) JOIN n USING (feature) GROUP BY j.feature""", ops=("A15",))
def q_mi_discrete(spark, sf):
    return pr.mutual_info_discrete(fr.cardio(spark, sf), CARDIO_CODES, "cardio")


@register("target_stats", "value bigint, target_mean double, target_std double, n bigint",
          W_CARDIO + "SELECT cholesterol AS value, avg(CAST(cardio AS DOUBLE)) AS target_mean, "
          "stddev_samp(CAST(cardio AS DOUBLE)) AS target_std, count(*) AS n FROM t GROUP BY cholesterol", ops=("A17",))
def q_target_stats(spark, sf):
    return pr.target_stats(fr.cardio(spark, sf), "cholesterol", "cardio")


@register("group_means", "gender bigint, cholesterol bigint, mean_weight double, mean_ap_hi double",
          W_CARDIO + "SELECT gender, cholesterol, avg(weight) AS mean_weight, avg(ap_hi) AS mean_ap_hi FROM t GROUP BY 1, 2",
          ops=("A18",))
def q_group_means(spark, sf):
    return pr.group_means(fr.cardio(spark, sf), ["gender", "cholesterol"], ["weight", "ap_hi"])


HIST_SQL = W_NUM_Y + """, r AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM lf GROUP BY feature),
h AS (SELECT lf.feature, lf.y AS label, CASE WHEN r.hi = r.lo THEN 0 ELSE least(CAST(floor((lf.value - r.lo) / ((r.hi - r.lo) / 10)) AS INTEGER), 9) END AS bin,
  r.lo, r.hi FROM lf JOIN r ON lf.feature = r.feature),
c AS (SELECT feature, label, bin, lo + bin * (hi - lo) / 10 AS bin_lo, lo + (bin + 1) * (hi - lo) / 10 AS bin_hi, count(*) AS n
  FROM h GROUP BY feature, label, bin, lo, hi)
"""


@register("histogram", "feature string, label bigint, bin bigint, bin_lo double, bin_hi double, n bigint",
          HIST_SQL + "SELECT * FROM c", ops=("A20",))
def q_histogram(spark, sf):
    return pr.histogram(fr.numeric(spark, sf), NUM, 10, by="y")


@register("histogram_density", "feature string, label bigint, bin bigint, n bigint, density double",
          HIST_SQL + """SELECT feature, label, bin, n, CASE WHEN bin_hi - bin_lo > 0 THEN
  n / sum(n) OVER (PARTITION BY feature, label) / (bin_hi - bin_lo) END AS density FROM c""", ops=("A28",))
def q_histogram_density(spark, sf):
    return pr.histogram(fr.numeric(spark, sf), NUM, 10, by="y", density=True)


@register("pair_sample", "id bigint, cardio bigint, ap_hi bigint, ap_lo bigint, rank bigint",
          W_CARDIO + """, r AS (SELECT id, cardio, ap_hi, ap_lo, row_number() OVER (PARTITION BY cardio
  ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) AS rank FROM t)
SELECT * FROM r WHERE rank <= 100""", ops=("A23", "W3"))
def q_pair_sample(spark, sf):
    return pr.pair_sample(fr.cardio(spark, sf), "id", "cardio", ["ap_hi", "ap_lo"], 100, seed=42)


CARDIO_WRONG = "CAST(ap_hi >= 140 AS INTEGER) <> cardio"


@register("error_feature_gap", "feature string, error_mean double, correct_mean double, abs_diff double",
          W_CARDIO + per_feature("t", CARDIO_MEASURES,
                                 f"avg({{c}}) FILTER (WHERE {CARDIO_WRONG}) AS error_mean, "
                                 f"avg({{c}}) FILTER (WHERE NOT ({CARDIO_WRONG})) AS correct_mean, "
                                 f"abs(avg({{c}}) FILTER (WHERE {CARDIO_WRONG}) - avg({{c}}) FILTER (WHERE NOT ({CARDIO_WRONG}))) AS abs_diff"),
          ops=("A25",))
def q_error_gap(spark, sf):
    c = fr.cardio(spark, sf)
    c = c.withColumn("wrong", (F.col("ap_hi") >= 140).cast("int") != F.col("cardio"))
    return pr.error_feature_gap(c, CARDIO_MEASURES, "wrong")


@register("prob_summary", "min double, mean double, max double",
          f"WITH s AS ({fr.SCORES_SQL}) SELECT min(p) AS min, avg(p) AS mean, max(p) AS max FROM s", ops=("A26",))
def q_prob_summary(spark, sf):
    return pr.prob_summary(fr.scores(spark, sf), "p")


@register("range_check", "feature string, min double, max double, too_large bigint",
          f"WITH t AS ({fr.NUMERIC_SQL})\n" + per_feature("t", NUM, "min({c}) AS min, max({c}) AS max, "
                                                        "CAST(abs(min({c})) > 10000 OR abs(max({c})) > 10000 AS INTEGER) AS too_large"),
          ops=("A27",))
def q_range_check(spark, sf):
    return pr.range_check(fr.numeric(spark, sf), NUM)
