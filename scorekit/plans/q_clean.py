"""Queries: plausibility filters, fitted cleaners, scalar functions (P*, F1-F29)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalar as sc
from ..operators import clean as cl
from ..session import ensure_checkpoint_dir
from ..streaming.scoring import read_stream, start_scoring
from . import frames as fr
from .q_profile import DOCS_LEFT_SQL, docs_left
from .registry import REGISTRY, register

W_CARDIO = f"WITH t AS ({fr.CARDIO_SQL})\n"
BMI_SQL = "(weight / pow(height / 100, 2))"
BASE_FILTER_SQL = f"""ap_hi BETWEEN 70 AND 250 AND ap_lo BETWEEN 40 AND 150 AND ap_hi > ap_lo AND height BETWEEN 130 AND 220
  AND weight BETWEEN 30 AND 200 AND {BMI_SQL} BETWEEN 15 AND 50"""
EXTRA_FILTER_SQL = f"""(ap_hi - ap_lo) BETWEEN 20 AND 100 AND NOT (cholesterol = 3 AND gluc = 3 AND floor(age / 365) < 35)
  AND NOT ({BMI_SQL} < 16 OR {BMI_SQL} > 45)"""
STRICT_FILTER_SQL = f"""ap_hi BETWEEN 70 AND 200 AND ap_lo BETWEEN 40 AND 130 AND ap_hi > ap_lo AND (ap_hi - ap_lo) BETWEEN 20 AND 100
  AND height BETWEEN 140 AND 210 AND weight BETWEEN 40 AND 160 AND {BMI_SQL} BETWEEN 16 AND 45 AND age BETWEEN 10000 AND 25000"""


@register("filter_plausible_base", "id bigint", W_CARDIO + f"SELECT id FROM t WHERE {BASE_FILTER_SQL}", ops=("P4",))
def q_filter_base(spark, sf):
    return cl.filter_plausible(fr.cardio(spark, sf), cl.BASE_RULES).select("id")


@register("filter_plausible_extended", "id bigint",
          W_CARDIO + f"SELECT id FROM t WHERE {BASE_FILTER_SQL} AND {EXTRA_FILTER_SQL}", ops=("P4", "P5"))
def q_filter_ext(spark, sf):
    return cl.filter_plausible(fr.cardio(spark, sf), cl.BASE_RULES + cl.EXTRA_RULES).select("id")


@register("filter_plausible_strict", "id bigint", W_CARDIO + f"SELECT id FROM t WHERE {STRICT_FILTER_SQL}", ops=("P6",))
def q_filter_strict(spark, sf):
    return cl.filter_plausible(fr.cardio(spark, sf), cl.STRICT_RULES).select("id")


@register("flag_outliers", "id bigint, ap_hi_extreme bigint, ap_lo_extreme bigint, bmi_raw double, bmi_outlier bigint",
          W_CARDIO + f"""SELECT id, CAST(ap_hi < 70 OR ap_hi > 250 AS INTEGER) AS ap_hi_extreme,
  CAST(ap_lo < 40 OR ap_lo > 150 AS INTEGER) AS ap_lo_extreme, {BMI_SQL} AS bmi_raw,
  CAST({BMI_SQL} < 15 OR {BMI_SQL} > 50 AS INTEGER) AS bmi_outlier FROM t""", ops=("P7",))
def q_flag_outliers(spark, sf):
    return cl.flag_outliers(fr.cardio(spark, sf))


@register("median_impute", "doc_id bigint, quality double, toxic double, n_chars double",
          f"WITH t AS ({DOCS_LEFT_SQL}),\nm AS (SELECT quantile_cont(quality, 0.5) AS mq, quantile_cont(toxic, 0.5) AS mt, "
          "quantile_cont(n_chars, 0.5) AS mn FROM t)\nSELECT doc_id, coalesce(quality, mq) AS quality, coalesce(toxic, mt) AS toxic, "
          "coalesce(n_chars, mn) AS n_chars FROM t, m", ops=("F20",))
def q_median_impute(spark, sf):
    d = docs_left(spark, sf)
    model = cl.MedianImputer(["quality", "toxic", "n_chars"]).fit(d)
    return model.transform(d)


@register("mixed_impute", "doc_id bigint, quality double, source string",
          f"""WITH t AS (SELECT doc_id, quality, CASE WHEN quality IS NULL THEN NULL ELSE source END AS source FROM ({DOCS_LEFT_SQL})),
m AS (SELECT quantile_cont(quality, 0.5) AS mq FROM t),
s AS (SELECT source AS ms FROM t WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1)
SELECT doc_id, coalesce(quality, mq) AS quality, coalesce(source, ms) AS source FROM t, m, s""", ops=("F21",))
def q_mixed_impute(spark, sf):
    d = docs_left(spark, sf).select("doc_id", "quality",
                                    F.when(F.col("quality").isNull(), F.lit(None)).otherwise(F.col("source")).alias("source"))
    return cl.MixedImputer(["quality", "source"]).fit(d).transform(d)


W_SENT = f"WITH t AS ({fr.SENTINEL_SQL})\n"


@register("sentinel_impute", "id bigint, s1 double, s2 double, s3 double",
          W_SENT + """, m AS (SELECT quantile_cont(s1, 0.5) FILTER (WHERE s1 <> 999) AS m1, quantile_cont(s2, 0.5) FILTER (WHERE s2 <> 999) AS m2,
  quantile_cont(s3, 0.5) FILTER (WHERE s3 <> 999) AS m3 FROM t)
SELECT id, CASE WHEN s1 = 999 THEN m1 ELSE s1 END AS s1, CASE WHEN s2 = 999 THEN m2 ELSE s2 END AS s2,
  CASE WHEN s3 = 999 THEN m3 ELSE s3 END AS s3 FROM t, m""", ops=("F23", "F8"))
def q_sentinel_impute(spark, sf):
    s = fr.sentinel(spark, sf)
    return cl.SentinelImputer(fr.SENTINEL_COLS).fit(s).transform(s)


@register("sentinel_flags", "id bigint, s1_is_999 bigint, s2_is_999 bigint, s3_is_999 bigint, n_sentinel bigint, sentinel_share double",
          W_SENT + """SELECT id, CAST(s1 = 999 AS INTEGER) AS s1_is_999, CAST(s2 = 999 AS INTEGER) AS s2_is_999,
  CAST(s3 = 999 AS INTEGER) AS s3_is_999, CAST(s1 = 999 AS INTEGER) + CAST(s2 = 999 AS INTEGER) + CAST(s3 = 999 AS INTEGER) AS n_sentinel,
  (CAST(s1 = 999 AS INTEGER) + CAST(s2 = 999 AS INTEGER) + CAST(s3 = 999 AS INTEGER)) / 3 AS sentinel_share FROM t""", ops=("F24", "F17"))
def q_sentinel_flags(spark, sf):
    return cl.sentinel_flags(fr.sentinel(spark, sf), fr.SENTINEL_COLS).select(
        "id", "s1_is_999", "s2_is_999", "s3_is_999", "n_sentinel", "sentinel_share")


MEAS = ["height", "weight", "ap_hi", "ap_lo"]


@register("winsorize", "id bigint, height double, weight double, ap_hi double, ap_lo double",
          W_CARDIO + ", q AS (SELECT " + ", ".join(
              f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in MEAS) +
          " FROM t)\nSELECT id, " + ", ".join(f"least(greatest({c}, lo_{c}), hi_{c}) AS {c}" for c in MEAS) + " FROM t, q",
          ops=("F26", "F6"))
def q_winsorize(spark, sf):
    c = fr.cardio(spark, sf).select("id", *MEAS)
    return cl.Winsorizer(MEAS).fit(c).transform(c)


@register("zscale", "id bigint, height double, weight double, ap_hi double, ap_lo double",
          W_CARDIO + ", s AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in MEAS) +
          " FROM t)\nSELECT id, " + ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS {c}" for c in MEAS) +
          " FROM t, s", ops=("F28",))
def q_zscale(spark, sf):
    c = fr.cardio(spark, sf).select("id", *MEAS)
    return cl.ZScaler(MEAS).fit(c).transform(c)


@register("stream_zscale", ", ".join(f"{c} {t}" for c, t in REGISTRY["zscale"].schema), REGISTRY["zscale"].sql, ops=("F28",))
def q_stream_zscale(spark, sf):
    """The same fitted scaler over a stream of files, all that are there, against the SQL of the batch."""
    c = fr.cardio(spark, sf).select("id", *MEAS)
    scaler = cl.ZScaler(MEAS).fit(c)
    root, name = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}", f"zscale_{uuid.uuid4().hex}"
    c.repartition(3).write.parquet(f"{root}/in")
    query = start_scoring(read_stream(spark, f"{root}/in", c.schema), [scaler.transform], f"{root}/out", name, checkpoint=f"{root}/state", trigger_once=True)
    query.awaitTermination()
    return spark.read.schema(scaler.transform(c).schema).parquet(f"{root}/out")


@register("iqr_scale", "id bigint, height double, weight double, ap_hi double, ap_lo double",
          W_CARDIO + ", s AS (SELECT " + ", ".join(
              f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS r_{c}" for c in MEAS) +
          " FROM t)\nSELECT id, " + ", ".join(f"({c} - m_{c}) / CASE WHEN r_{c} = 0 THEN 1 ELSE r_{c} END AS {c}" for c in MEAS) +
          " FROM t, s", ops=("F29",))
def q_iqr_scale(spark, sf):
    c = fr.cardio(spark, sf).select("id", *MEAS)
    return cl.IqrScaler(MEAS).fit(c).transform(c)


@register("iqr_capper_fit", "feature string, lower double, upper double",
          W_CARDIO + ", lf AS (" + "\nUNION ALL ".join(
              f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM t" for c in fr.CARDIO_COLS) + """),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY feature),
b AS (SELECT feature, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q),
o AS (SELECT b.feature, b.lower, b.upper, count(*) FILTER (WHERE value < lower OR value > upper) * 100.0 / count(*) AS pct
  FROM b JOIN lf ON b.feature = lf.feature GROUP BY ALL)
SELECT feature, lower, upper FROM o WHERE pct > 10""", ops=("F27",))
def q_iqr_capper(spark, sf):
    fitted = cl.IqrCapper(fr.CARDIO_COLS, min_pct=10.0).fit(fr.cardio(spark, sf))
    return spark.createDataFrame([(k, float(v[0]), float(v[1])) for k, v in fitted.params.items()],
                                 "feature string, lower double, upper double") if fitted.params else \
        spark.createDataFrame([], "feature string, lower double, upper double")


# --- scalar function pack (F1-F17) on the cardio frame --------------------------------------

@register("scalar_pack", "id bigint, prod double, ratio double, log1p_abs double, log2_abs1 double, sqrt_abs double, "
          "cube double, sin_v double, age_floor bigint, age_div double, clipped double, in_range bigint, coded double, "
          "staged bigint, sig double, pos_log double, max_c double",
          W_CARDIO + """SELECT id, CAST(ap_hi AS DOUBLE) * weight AS prod, ap_hi / (ap_lo + 1e-8) AS ratio,
  ln(1 + abs(ap_hi - 150)) AS log1p_abs, log2(abs(ap_hi - 150) + 1) AS log2_abs1, sqrt(abs(ap_hi - 150)) AS sqrt_abs,
  CAST(ap_lo AS DOUBLE) * ap_lo * ap_lo AS cube, sin(CAST(ap_lo AS DOUBLE)) AS sin_v, floor(age / 365) AS age_floor,
  age / 365.25 AS age_div, CASE WHEN weight < 60 THEN 60 WHEN weight > 140 THEN 140 ELSE weight END AS clipped,
  CAST(ap_hi BETWEEN 120 AND 129 AS INTEGER) AS in_range,
  coalesce(CASE cholesterol WHEN 1 THEN 200 WHEN 2 THEN 240 WHEN 3 THEN 280 END, 220) AS coded,
  CASE WHEN ap_hi >= 180 THEN 3 WHEN ap_hi >= 140 THEN 2 WHEN ap_hi >= 130 THEN 1 ELSE 0 END AS staged,
  1 / (1 + exp(-(ap_hi - 140) / 20.0)) AS sig, ln(1 + greatest(ap_hi - 150, 0)) AS pos_log, greatest(ap_lo, 90) AS max_c
FROM t""", ops=("F1", "F2", "F3", "F4", "F5", "F6", "F7", "F9", "F11", "F12", "F13", "F15"))
def q_scalar_pack(spark, sf):
    c = fr.cardio(spark, sf)
    d = (F.col("ap_hi") - 150)
    return c.select(
        "id", sc.mul(F.col("ap_hi").cast("double"), "weight").alias("prod"), sc.safe_ratio("ap_hi", "ap_lo", 1e-8).alias("ratio"),
        sc.unary(d, "log1p_abs").alias("log1p_abs"), sc.unary(d, "log2_abs1").alias("log2_abs1"),
        sc.unary(d, "sqrt_abs").alias("sqrt_abs"), sc.unary("ap_lo", "cube").alias("cube"),
        sc.unary("ap_lo", "sin").alias("sin_v"), sc.age_years("age", 365, floor=True).alias("age_floor"),
        sc.age_years("age", 365.25).alias("age_div"), sc.clip("weight", 60, 140).alias("clipped"),
        sc.flag(sc.between("ap_hi", 120, 129)).alias("in_range"),
        sc.map_codes("cholesterol", {1: 200, 2: 240, 3: 280}, 220).alias("coded"),
        sc.last_wins(0, [(F.col("ap_hi") >= 130, 1), (F.col("ap_hi") >= 140, 2), (F.col("ap_hi") >= 180, 3)]).alias("staged"),
        sc.sigmoid((F.col("ap_hi") - 140) / 20.0).alias("sig"), sc.log1p_pos(d).alias("pos_log"),
        sc.max_const("ap_lo", 90).alias("max_c"))


ROW_COLS = ["height", "weight", "ap_hi", "ap_lo"]


@register("row_stats", "id bigint, row_sum double, row_mean double, row_std double, row_median double, row_min double, "
          "row_max double, row_range double, row_skew double, row_kurt double, n_above_100 bigint",
          W_CARDIO + """, lf AS (""" + "\nUNION ALL ".join(f"SELECT id, CAST({c} AS DOUBLE) AS v FROM t" for c in ROW_COLS) + """),
m AS (SELECT id, count(v) AS n, sum(v) AS s, avg(v) AS mean, stddev_samp(v) AS sd, quantile_cont(v, 0.5) AS med, min(v) AS mn,
  max(v) AS mx FROM lf GROUP BY id),
c AS (SELECT lf.id, sum(pow(v - mean, 2)) AS m2, sum(pow(v - mean, 3)) AS m3, sum(pow(v - mean, 4)) AS m4 FROM lf JOIN m USING (id) GROUP BY lf.id)
SELECT m.id, s AS row_sum, mean AS row_mean, sd AS row_std, med AS row_median, mn AS row_min, mx AS row_max, mx - mn AS row_range,
  CASE WHEN m2 = 0 THEN 0.0 ELSE (m3 / n) / pow(m2 / n, 1.5) * sqrt(n * (n - 1)) / (n - 2) END AS row_skew,
  CASE WHEN m2 = 0 THEN 0.0 ELSE (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * ((m4 / n) / pow(m2 / n, 2) - 3) + 6) END AS row_kurt,
  """ + " + ".join(f"CAST(t.{c} > 100 AS INTEGER)" for c in ROW_COLS) + """ AS n_above_100
FROM m JOIN c USING (id) JOIN t ON t.id = m.id""", ops=("F16", "F17"))
def q_row_stats(spark, sf):
    c = fr.cardio(spark, sf)
    st = sc.row_stats(ROW_COLS)
    return c.select("id", *[e.alias(n) for n, e in st.items()],
                    sc.row_count_if(ROW_COLS, lambda x: x > 100).alias("n_above_100"))


@register("text_keys", "conv_id bigint, turn bigint, role_key string, is_user bigint, turn_num double",
          """SELECT conv_id, turn, lower(CAST(role AS VARCHAR)) AS role_key, CAST(starts_with(CAST(role AS VARCHAR), 'user') AS INTEGER) AS is_user,
  coalesce(TRY_CAST(CAST(turn AS VARCHAR) AS DOUBLE), -1) AS turn_num FROM conversations""", ops=("F14", "P10"))
def q_text_keys(spark, sf):
    c = fr.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", sc.text_key("role").alias("role_key"),
                    sc.flag(sc.starts_with("role", "user")).alias("is_user"),
                    sc.to_number("turn", -1).alias("turn_num"))
