"""Queries: domain feature packs and schema harmonisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cardio as cd
from . import frames as fr
from .registry import REGISTRY, register

W_CARDIO = f"WITH t AS ({fr.CARDIO_SQL})\n"
BMI = "(weight / pow(height / 100, 2))"
AGE_Y = "floor(age / 365)"

D1_COLS = """floor(age / 365) AS age_years, {bmi} AS bmi, ap_hi - ap_lo AS pulse_pressure,
  CAST(ap_hi >= 140 OR ap_lo >= 90 AS INTEGER) AS bp_high, ap_hi / (ap_lo + 1e-06) AS ap_hi_to_lo, (ap_hi + 2 * ap_lo) / 3 AS map,
  floor(age / 365) * {bmi} AS age_bmi_interact, {bmi} * cholesterol AS bmi_chol_interact, cholesterol - cm AS chol_m_diff,
  pow(ap_hi, 2) AS ap_hi_sq, CAST(ap_hi >= 140 OR ap_lo >= 90 AS INTEGER) + CAST(cholesterol = 3 AS INTEGER) + CAST(gluc = 3 AS INTEGER) AS risk_score""".format(bmi=BMI)
D1_SCHEMA = ("id bigint, age_years bigint, bmi double, pulse_pressure bigint, bp_high bigint, ap_hi_to_lo double, map double, "
             "age_bmi_interact double, bmi_chol_interact double, chol_m_diff double, ap_hi_sq double, risk_score bigint")
D1_NAMES = [c.split()[0] for c in D1_SCHEMA.split(", ")]


def _chol_mean(c):
    return c.agg(F.avg("cholesterol")).first()[0]


@register("cardio_base", D1_SCHEMA, W_CARDIO + ", m AS (SELECT avg(cholesterol) AS cm FROM t)\nSELECT id, " + D1_COLS + " FROM t, m",
          ops=("D1", "F39", "F5"))
def q_cardio_base(spark, sf):
    c = fr.cardio(spark, sf)
    return cd.cardio_base(c, _chol_mean(c)).select(*D1_NAMES)


D2_EXTRA = ("metabolic_risk_score bigint, hypertension_stage bigint, age_x_gender bigint, is_older_female bigint, "
            "is_older_male bigint, ap_lo_squared double, age_years_squared double, sqrt_pulse_pressure double")


@register("cardio_extended", D1_SCHEMA + ", " + D2_EXTRA,
          W_CARDIO + ", m AS (SELECT avg(cholesterol) AS cm FROM t)\nSELECT id, " + D1_COLS + f""",
  CAST({BMI} > 30 AS INTEGER) + CAST(cholesterol = 3 AS INTEGER) + CAST(gluc = 3 AS INTEGER) + CAST(active = 0 AS INTEGER) AS metabolic_risk_score,
  CASE WHEN ap_hi >= 180 OR ap_lo >= 120 THEN 3 WHEN ap_hi >= 140 OR ap_lo >= 90 THEN 2 WHEN ap_hi >= 130 OR ap_lo >= 80 THEN 1 ELSE 0 END AS hypertension_stage,
  {AGE_Y} * gender AS age_x_gender, CAST({AGE_Y} > 55 AND gender = 2 AS INTEGER) AS is_older_female,
  CAST({AGE_Y} > 55 AND gender = 1 AS INTEGER) AS is_older_male, pow(ap_lo, 2) AS ap_lo_squared, pow({AGE_Y}, 2) AS age_years_squared,
  sqrt(greatest(CAST(ap_hi - ap_lo AS DOUBLE), 0.0)) AS sqrt_pulse_pressure FROM t, m""", ops=("D2", "F11"))
def q_cardio_extended(spark, sf):
    c = fr.cardio(spark, sf)
    names = D1_NAMES + [x.split()[0] for x in D2_EXTRA.split(", ")]
    return cd.cardio_extended(c, _chol_mean(c)).select(*names)


# --- D3 + D4 + D5: clinical pack, winsorised, scores, BP stage ------------------------------

CLIN_SQL = W_CARDIO + f""", c1 AS (SELECT *, age / 365.25 AS age_years, CAST(gender = 2 AS INTEGER) AS gender_male, {BMI} AS bmi,
  ap_hi - ap_lo AS pulse_pressure, ap_lo + (ap_hi - ap_lo) / 3.0 AS mean_arterial_pressure, ap_hi / (ap_lo + 1e-06) AS bp_ratio,
  CAST(ap_hi < 120 AND ap_lo < 80 AS INTEGER) AS bp_normal, CAST(ap_hi BETWEEN 120 AND 129 AND ap_lo < 80 AS INTEGER) AS bp_elevated,
  CAST(ap_hi BETWEEN 130 AND 139 OR ap_lo BETWEEN 80 AND 89 AS INTEGER) AS bp_stage1_htn,
  CAST(ap_hi >= 140 OR ap_lo >= 90 AS INTEGER) AS bp_stage2_htn, CAST(ap_hi > 180 OR ap_lo > 120 AS INTEGER) AS bp_crisis,
  CAST(cholesterol = 1 AS INTEGER) AS chol_normal, CAST(cholesterol > 1 AS INTEGER) AS chol_abnormal,
  CAST(gluc = 1 AS INTEGER) AS gluc_normal, CAST(gluc > 1 AS INTEGER) AS gluc_abnormal, CAST(gluc = 3 AS INTEGER) AS has_diabetes FROM t),
c2 AS (SELECT *, CAST(bmi >= 18.5 AND bmi < 25 AS INTEGER) AS bmi_normal, CAST(bmi >= 30 AS INTEGER) AS bmi_obese,
  CAST(bp_stage1_htn = 1 OR bp_stage2_htn = 1 OR bp_crisis = 1 AS INTEGER) AS has_hypertension FROM c1),
c3 AS (SELECT *, bmi_obese + has_hypertension + chol_abnormal + gluc_abnormal AS metabolic_risk_score,
  pulse_pressure / (age_years + 1e-06) AS pulse_pressure_age_ratio FROM c2),
c4 AS (SELECT *, CAST(metabolic_risk_score >= 3 AS INTEGER) AS has_metabolic_syndrome,
  smoke * 2 + alco * 1 - active * 1 AS lifestyle_risk_score, (1 - gender_male) * metabolic_risk_score AS female_metabolic_risk,
  0.0 + age_years * 0.1 + gender_male * 2.0 + smoke * 3.0 + has_hypertension * 2.0 + chol_abnormal * 1.5 + has_diabetes * 2.0 + bmi_obese * 1.0 AS framingham_risk,
  CAST(0.0 + bp_normal + chol_normal + gluc_normal + bmi_normal + (1 - smoke) + active + (1 - alco) * 0.5 AS DOUBLE) AS cv_health_score,
  CASE WHEN bp_crisis = 1 THEN 4 WHEN bp_stage2_htn = 1 THEN 3 WHEN bp_stage1_htn = 1 THEN 2 WHEN bp_elevated = 1 THEN 1 ELSE 0 END AS bp_stage FROM c3),
b AS (SELECT quantile_cont(ap_hi, 0.01) AS l_ap_hi, quantile_cont(ap_hi, 0.99) AS h_ap_hi,
  quantile_cont(ap_lo, 0.01) AS l_ap_lo, quantile_cont(ap_lo, 0.99) AS h_ap_lo,
  quantile_cont(pulse_pressure, 0.01) AS l_pp, quantile_cont(pulse_pressure, 0.99) AS h_pp,
  quantile_cont(weight, 0.01) AS l_w, quantile_cont(weight, 0.99) AS h_w, quantile_cont(bmi, 0.01) AS l_b, quantile_cont(bmi, 0.99) AS h_b FROM c4),
w AS (SELECT c4.* REPLACE (least(greatest(ap_hi, l_ap_hi), h_ap_hi) AS ap_hi, least(greatest(ap_lo, l_ap_lo), h_ap_lo) AS ap_lo,
  least(greatest(pulse_pressure, l_pp), h_pp) AS pulse_pressure, least(greatest(weight, l_w), h_w) AS weight,
  least(greatest(bmi, l_b), h_b) AS bmi) FROM c4, b)
"""

CLIN_OUT = ("id bigint, age_years double, gender_male bigint, bmi double, ap_hi double, ap_lo double, pulse_pressure double, "
            "weight double, mean_arterial_pressure double, bp_ratio double, has_hypertension bigint, metabolic_risk_score bigint, "
            "has_metabolic_syndrome bigint, lifestyle_risk_score bigint, female_metabolic_risk bigint, framingham_risk double, "
            "cv_health_score double, log_weight double, log_bmi double, bp_stage bigint")
CLIN_NAMES = [c.split()[0] for c in CLIN_OUT.split(", ")]


def _clinical(spark, sf):
    c = fr.cardio(spark, sf)
    clin = cd.bp_stage(cd.cardio_clinical(c))
    bounds = cd.fit_winsor_bounds(clin)
    return cd.cardio_scores_finish(clin, bounds)


@register("cardio_clinical", CLIN_OUT,
          CLIN_SQL + "SELECT " + ", ".join(n for n in CLIN_NAMES if not n.startswith("log_")) +
          ", ln(1 + greatest(weight, 0)) AS log_weight, ln(1 + greatest(bmi, 0)) AS log_bmi FROM w",
          ops=("D3", "D4", "D5", "F26"))
def q_cardio_clinical(spark, sf):
    return _clinical(spark, sf).select(*CLIN_NAMES)


PROXY_OUT = ("id bigint, sex bigint, trestbps double, chol bigint, fbs bigint, restecg bigint, thalach double, exang bigint, "
             "oldpeak double, slope bigint, ca bigint, thal bigint")


@register("heart_proxies", PROXY_OUT,
          CLIN_SQL + """SELECT id, gender_male AS sex, ap_hi AS trestbps, coalesce(CASE cholesterol WHEN 1 THEN 200 WHEN 2 THEN 240 WHEN 3 THEN 280 END, 200) AS chol,
  CAST(gluc >= 2 AS INTEGER) AS fbs,
  CASE WHEN bp_ratio > 0 AND bp_ratio <= 1.1 THEN 0 WHEN bp_ratio > 1.1 AND bp_ratio <= 1.4 THEN 1 WHEN bp_ratio > 1.4 AND bp_ratio <= 10 THEN 2 ELSE 1 END AS restecg,
  (220 - age_years) * CASE WHEN active = 0 THEN 0.9 WHEN active = 1 THEN 1.0 ELSE active END AS thalach,
  CAST(active = 0 AND has_hypertension = 1 AS INTEGER) AS exang, greatest(0.0, pulse_pressure - 60.0) / 10.0 AS oldpeak,
  CASE WHEN pulse_pressure_age_ratio > -1 AND pulse_pressure_age_ratio <= 0.1 THEN 0 WHEN pulse_pressure_age_ratio > 0.1 AND pulse_pressure_age_ratio <= 0.3 THEN 1
       WHEN pulse_pressure_age_ratio > 0.3 AND pulse_pressure_age_ratio <= 10 THEN 2 ELSE 1 END AS slope,
  CAST(least(greatest(metabolic_risk_score, 0), 4) AS INTEGER) AS ca, chol_abnormal AS thal FROM w""", ops=("D6", "F9"))
def q_heart_proxies(spark, sf):
    return cd.heart_proxies(_clinical(spark, sf)).select(*[c.split()[0] for c in PROXY_OUT.split(", ")])


# --- D7 / D10: harmoniser ----------------------------------------------------------------------

HARM_OUT = "id bigint, " + ", ".join(f"{c} {'bigint' if c in cd.INT_TARGETS else 'double'}" for c in cd.HEART_TARGETS)

HARM_TRAIN_SQL = W_CARDIO + f""", h AS (SELECT id, age / 365.0 AS age, CAST(gender = 2 AS INTEGER) AS sex, CAST(ap_hi AS DOUBLE) AS trestbps,
  CAST(CASE cholesterol WHEN 1 THEN 180 WHEN 2 THEN 240 WHEN 3 THEN 300 END AS DOUBLE) AS chol, CAST(gluc >= 2 AS INTEGER) AS fbs,
  coalesce(CASE WHEN ap_hi / (ap_lo + 1e-06) > 0 AND ap_hi / (ap_lo + 1e-06) <= 1.1 THEN 0 WHEN ap_hi / (ap_lo + 1e-06) > 1.1 AND ap_hi / (ap_lo + 1e-06) <= 1.4 THEN 1
    WHEN ap_hi / (ap_lo + 1e-06) > 1.4 AND ap_hi / (ap_lo + 1e-06) <= 10 THEN 2 END, 1) AS restecg,
  (220 - age / 365.0) * CASE WHEN active = 0 THEN 0.9 WHEN active = 1 THEN 1.0 ELSE active END AS thalach,
  CAST((1 - active) = 1 AND (ap_hi >= 140 OR ap_lo >= 90) AS INTEGER) AS exang, greatest(0.0, ap_hi - ap_lo - 60.0) / 10.0 AS oldpeak,
  coalesce(CASE WHEN (ap_hi - ap_lo) / (age / 365.0 + 1e-06) > -1 AND (ap_hi - ap_lo) / (age / 365.0 + 1e-06) <= 0.1 THEN 0
    WHEN (ap_hi - ap_lo) / (age / 365.0 + 1e-06) > 0.1 AND (ap_hi - ap_lo) / (age / 365.0 + 1e-06) <= 0.3 THEN 1
    WHEN (ap_hi - ap_lo) / (age / 365.0 + 1e-06) > 0.3 AND (ap_hi - ap_lo) / (age / 365.0 + 1e-06) <= 10 THEN 2 END, 1) AS slope,
  least(greatest(coalesce(CAST({BMI} >= 30 AS DOUBLE), 0.0) + CAST(cholesterol > 1 AS INTEGER) + CAST(gluc > 1 AS INTEGER), 0), 3) AS ca,
  CAST(cholesterol > 1 AS INTEGER) AS thal,
  CASE WHEN ap_hi >= 140 OR ap_lo >= 90 THEN 3 WHEN ap_hi BETWEEN 130 AND 139 OR ap_lo BETWEEN 80 AND 89 THEN 2
       WHEN ap_hi BETWEEN 120 AND 129 AND ap_lo < 80 THEN 1 ELSE 0 END AS cp FROM t)
"""


@register("harmonise_train", HARM_OUT, HARM_TRAIN_SQL + "SELECT * FROM h", ops=("D7", "D10", "P11"))
def q_harm_train(spark, sf):
    return cd.harmonise(fr.cardio(spark, sf), "train")


@register("harmonise_score", HARM_OUT, f"WITH h AS ({fr.HEART_SQL}) SELECT id, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c not in cd.INT_TARGETS else f"CAST(coalesce(CAST({c} AS DOUBLE), 0) AS INTEGER) AS {c}"
    for c in cd.HEART_TARGETS) + " FROM h", ops=("D7", "D10", "P10"))
def q_harm_score(spark, sf):
    return cd.harmonise(fr.heart(spark, sf), "score")


@register("harmonise_filled", HARM_OUT, HARM_TRAIN_SQL + ", m AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}" for c in cd.CONT_TARGETS) + " FROM h)\nSELECT h.* REPLACE (" + ", ".join(
    f"coalesce({c}, m_{c}) AS {c}" for c in cd.CONT_TARGETS) + ") FROM h, m", ops=("D7", "F20"))
def q_harm_filled(spark, sf):
    h = cd.harmonise(fr.cardio(spark, sf), "train")
    return cd.MedianFill(cd.CONT_TARGETS).fit(h).transform(h)


# --- D8: clipped harmoniser --------------------------------------------------------------------

V2_OUT = ("id bigint, age double, sex bigint, cp bigint, trestbps double, chol double, fbs bigint, restecg bigint, thalach double, "
          "exang bigint, oldpeak double, slope bigint, ca bigint, thal bigint, has_restecg bigint, has_slope bigint, has_ca bigint, "
          "has_thal bigint, age_risk_low bigint, age_risk_mid bigint, age_risk_high bigint, bp_risk_0 bigint, bp_risk_1 bigint, "
          "bp_risk_2 bigint, chol_risk bigint, metabolic_risk bigint, age_sex_interact double, age_chol_interact double, "
          "bp_age_interact double")
V2_NAMES = [c.split()[0] for c in V2_OUT.split(", ")]


@register("harmonise_v2_train", V2_OUT, W_CARDIO + f""", a AS (SELECT *, least(greatest(age / 365.25, 20), 90) AS age_y,
  CAST(least(greatest(gender - 1, 0), 1) AS INTEGER) AS sex_v, coalesce(CAST(ap_hi AS DOUBLE), 120.0) AS tb,
  CAST(coalesce(CASE cholesterol WHEN 1 THEN 200 WHEN 2 THEN 240 WHEN 3 THEN 280 END, 220) AS DOUBLE) AS ch,
  CAST(gluc >= 2 AS INTEGER) AS fb, coalesce(least(greatest(CAST(ap_hi - ap_lo AS DOUBLE), 20), 100), 40.0) AS pp FROM t),
b AS (SELECT *, CAST(ch > 240 AS INTEGER) AS chol_risk FROM a)
SELECT id, age_y AS age, sex_v AS sex,
  CASE WHEN coalesce(ap_hi, 120) >= 160 THEN 3 WHEN coalesce(ap_hi, 120) >= 140 AND coalesce(ap_hi, 120) < 160 THEN 2
       WHEN coalesce(ap_hi, 120) >= 120 AND coalesce(ap_hi, 120) < 140 THEN 1 ELSE 0 END AS cp,
  tb AS trestbps, ch AS chol, fb AS fbs, 1 AS restecg,
  least(greatest(least(greatest(220 - age_y, 100), 200) * CASE WHEN active = 0 THEN 0.85 WHEN active = 1 THEN 0.95 ELSE 0.9 END, 70), 200) AS thalach,
  CAST(CAST(ap_hi >= 140 OR ap_lo >= 90 AS INTEGER) = 1 AND (1 - active) = 1 AS INTEGER) AS exang,
  least(greatest((pp - 40) / 20.0, 0), 3) AS oldpeak, 2 AS slope,
  CAST(least(greatest(CAST(cholesterol = 3 AS INTEGER) + CAST(gluc = 3 AS INTEGER) + CAST(coalesce({BMI}, 25.0) > 35 AS INTEGER), 0), 3) AS INTEGER) AS ca,
  2 AS thal, 0 AS has_restecg, 0 AS has_slope, 0 AS has_ca, 0 AS has_thal,
  CAST(age_y < 45 AS INTEGER) AS age_risk_low, CAST(age_y >= 45 AND age_y <= 60 AS INTEGER) AS age_risk_mid, CAST(age_y > 60 AS INTEGER) AS age_risk_high,
  CAST(tb < 120 AS INTEGER) AS bp_risk_0, CAST(tb >= 120 AND tb < 140 AS INTEGER) AS bp_risk_1, CAST(tb >= 140 AS INTEGER) AS bp_risk_2,
  chol_risk, CAST(least(greatest(chol_risk + fb, 0), 2) AS INTEGER) AS metabolic_risk, age_y * sex_v AS age_sex_interact,
  age_y * chol_risk AS age_chol_interact, tb * age_y / 100.0 AS bp_age_interact FROM b""", ops=("D8", "F6"))
def q_harm_v2_train(spark, sf):
    return cd.harmonise_v2(fr.cardio(spark, sf), "train").select(*V2_NAMES)


@register("harmonise_v2_score", V2_OUT, f"WITH t AS ({fr.HEART_SQL}), " + """a AS (SELECT *, least(greatest(coalesce(CAST(age AS DOUBLE), 50.0), 20), 90) AS age_y,
  CAST(coalesce(CAST(sex AS DOUBLE), 0) AS INTEGER) AS sex_v, coalesce(CAST(trestbps AS DOUBLE), 120.0) AS tb,
  coalesce(CAST(chol AS DOUBLE), 200.0) AS ch, CAST(coalesce(CAST(fbs AS DOUBLE), 0) AS INTEGER) AS fb FROM t),
b AS (SELECT *, CAST(ch > 240 AS INTEGER) AS chol_risk FROM a)
SELECT id, age_y AS age, sex_v AS sex, CAST(coalesce(CAST(cp AS DOUBLE), 0) AS INTEGER) AS cp, tb AS trestbps, ch AS chol, fb AS fbs,
  CAST(coalesce(CAST(restecg AS DOUBLE), 1) AS INTEGER) AS restecg, coalesce(CAST(thalach AS DOUBLE), 150.0) AS thalach,
  CAST(coalesce(CAST(exang AS DOUBLE), 0) AS INTEGER) AS exang, coalesce(CAST(oldpeak AS DOUBLE), 0.0) AS oldpeak,
  CAST(coalesce(CAST(slope AS DOUBLE), 2) AS INTEGER) AS slope, CAST(coalesce(CAST(ca AS DOUBLE), 0) AS INTEGER) AS ca,
  CAST(coalesce(CAST(thal AS DOUBLE), 2) AS INTEGER) AS thal, 1 AS has_restecg, 1 AS has_slope, 1 AS has_ca, 1 AS has_thal,
  CAST(age_y < 45 AS INTEGER) AS age_risk_low, CAST(age_y >= 45 AND age_y <= 60 AS INTEGER) AS age_risk_mid, CAST(age_y > 60 AS INTEGER) AS age_risk_high,
  CAST(tb < 120 AS INTEGER) AS bp_risk_0, CAST(tb >= 120 AND tb < 140 AS INTEGER) AS bp_risk_1, CAST(tb >= 140 AS INTEGER) AS bp_risk_2,
  chol_risk, CAST(least(greatest(chol_risk + fb, 0), 2) AS INTEGER) AS metabolic_risk, age_y * sex_v AS age_sex_interact,
  age_y * chol_risk AS age_chol_interact, tb * age_y / 100.0 AS bp_age_interact FROM b""", ops=("D8",))
def q_harm_v2_score(spark, sf):
    return cd.harmonise_v2(fr.heart(spark, sf), "score").select(*V2_NAMES)


# --- D9: compact pack --------------------------------------------------------------------------

COMPACT_OUT = "id bigint, " + ", ".join(f"{c} double" for c in cd.COMPACT_COLS)


@register("cardio_compact", COMPACT_OUT, W_CARDIO + f"""SELECT id, age / 365.0 AS age_years, CAST(gender = 2 AS INTEGER) AS gender_male,
  {BMI} AS bmi, ap_hi AS resting_bp, ap_hi - ap_lo AS pulse_pressure, ap_lo + (ap_hi - ap_lo) / 3.0 AS mean_arterial_pressure,
  coalesce(CAST(CASE cholesterol WHEN 1 THEN 180 WHEN 2 THEN 240 WHEN 3 THEN 300 END AS DOUBLE), 180.0) AS chol_mgdl,
  CAST(gluc >= 2 AS INTEGER) AS fbs, smoke, alco, active, 1 - active AS sedentary, smoke + alco - active AS lifestyle_risk,
  cholesterol + gluc AS metabolic_risk, ap_hi - ap_lo AS bp_difference FROM t""", ops=("D9", "D10"))
def q_cardio_compact(spark, sf):
    return cd.cardio_compact(fr.cardio(spark, sf), "train")


@register("cardio_compact_score", COMPACT_OUT, f"WITH t AS ({fr.HEART_SQL})\n" + """SELECT id, CAST(age AS DOUBLE) AS age_years, sex AS gender_male,
  NULL AS bmi, trestbps AS resting_bp, NULL AS pulse_pressure, NULL AS mean_arterial_pressure, coalesce(CAST(chol AS DOUBLE), 180.0) AS chol_mgdl,
  fbs, 0 AS smoke, 0 AS alco, 0 AS active, 1 AS sedentary, 0 AS lifestyle_risk,
  CASE WHEN chol >= 240 THEN 3 WHEN chol >= 200 THEN 2 ELSE 1 END + CASE WHEN fbs = 1 THEN 2 ELSE 1 END AS metabolic_risk, NULL AS bp_difference FROM t""",
          ops=("D9", "D10"))
def q_cardio_compact_score(spark, sf):
    return cd.cardio_compact(fr.heart(spark, sf), "score")


# Bodies of the two compact queries, over CTEs t (training) and h (scoring) of the caller.
REGISTRY_SQL = {
    "cardio_compact": REGISTRY["cardio_compact"].sql.removeprefix(W_CARDIO),
    "cardio_compact_score": REGISTRY["cardio_compact_score"].sql.removeprefix(f"WITH t AS ({fr.HEART_SQL})\n").replace("FROM t", "FROM h"),
}
