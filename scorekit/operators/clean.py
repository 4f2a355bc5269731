"""Row filters, schema helpers and fitted cleaners.

Every cleaner is fitted once on training rows (one distributed aggregate; the fitted values are
one number per column) and applied unchanged to any frame, batch or streaming, as a projection.
Filters apply to training frames only; scoring frames are never filtered (a scored id must never
disappear).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip, col, flag
from ..spec import NUMERIC_TYPES
from .profile import feature_kinds, fused_stats, mode_value
from .stats import clean_double, exact_quantiles

# --- P2, P3, P9, P12, P13: schema helpers ----------------------------------------------------


def drop_cols(df: DataFrame, names) -> DataFrame:
    """Drop, ignoring names the frame does not have."""
    have = set(df.columns)
    return df.drop(*[n for n in names if n in have])


def select_features(df: DataFrame, names, keep=()) -> DataFrame:
    have = set(df.columns)
    return df.select(*[col(k) for k in keep], *[col(n) for n in names if n in have and n not in keep])


def common_features(candidates, a: DataFrame, b: DataFrame) -> list[str]:
    """Ordered candidate list (de-duplicated) present in both frames."""
    ca, cb = set(a.columns), set(b.columns)
    return [c for c in dict.fromkeys(candidates) if c in ca and c in cb]


def require(df: DataFrame, cols) -> None:
    """P13."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def split_by_class(df: DataFrame, class_col: str, classes) -> dict:
    """One filtered frame per class value."""
    return {c: df.where(col(class_col) == c) for c in classes}


PRED_ALIASES = ("target", "cardio", "label", "prediction", "pred")


def normalise_predictions(df: DataFrame, id_col: str = "id", aliases=PRED_ALIASES) -> DataFrame:
    """Lower-case names, find the prediction column among aliases, return (id, label)."""
    low = df.toDF(*[c.lower() for c in df.columns])
    for a in aliases:
        if a in low.columns:
            return low.select(F.col(id_col.lower()).alias("id"), F.col(a).cast("int").alias("label"))
    raise ValueError(f"no prediction column among {aliases}: {df.columns}")


# --- P4-P7: plausibility rules ------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """A keep-condition that applies only when the frame has all ``needs`` columns."""
    needs: tuple
    keep: object  # callable () -> Column


def range_rule(c: str, lo, hi) -> Rule:
    return Rule((c,), lambda: col(c).between(lo, hi))


def _bmi() -> Column:
    return col("weight") / F.pow(col("height") / 100, 2)


# fixed values: plausibility limits of the reference scripts
BASE_RULES = (
    range_rule("ap_hi", 70, 250),
    range_rule("ap_lo", 40, 150),
    Rule(("ap_hi", "ap_lo"), lambda: col("ap_hi") > col("ap_lo")),
    range_rule("height", 130, 220),
    range_rule("weight", 30, 200),
    Rule(("height", "weight"), lambda: _bmi().between(15, 50)),
)
EXTRA_RULES = (
    Rule(("ap_hi", "ap_lo"), lambda: (col("ap_hi") - col("ap_lo")).between(20, 100)),
    Rule(("age", "cholesterol", "gluc"),
         lambda: ~((col("cholesterol") == 3) & (col("gluc") == 3) & (F.floor(col("age") / 365) < 35))),
    Rule(("height", "weight"), lambda: ~((_bmi() < 16) | (_bmi() > 45))),
)
STRICT_RULES = (
    range_rule("ap_hi", 70, 200),
    range_rule("ap_lo", 40, 130),
    Rule(("ap_hi", "ap_lo"), lambda: col("ap_hi") > col("ap_lo")),
    Rule(("ap_hi", "ap_lo"), lambda: (col("ap_hi") - col("ap_lo")).between(20, 100)),
    range_rule("height", 140, 210),
    range_rule("weight", 40, 160),
    Rule(("height", "weight"), lambda: _bmi().between(16, 45)),
    range_rule("age", 10000, 25000),
)


def plausible(df: DataFrame, rules) -> Column:
    """Conjunction of the applicable rules; a null comparison counts as not plausible."""
    have = set(df.columns)
    conds = [F.coalesce(r.keep(), F.lit(False)) for r in rules if all(n in have for n in r.needs)]
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def filter_plausible(df: DataFrame, rules=BASE_RULES) -> DataFrame:
    """Keep rows passing every applicable rule (training frames only)."""
    return df.where(plausible(df, rules))


def flag_outliers(df: DataFrame) -> DataFrame:
    """Flag, do not drop: extreme blood pressure and implausible BMI indicators."""
    out = df
    if "ap_hi" in df.columns:
        out = out.withColumn("ap_hi_extreme", flag((col("ap_hi") < 70) | (col("ap_hi") > 250)))
    if "ap_lo" in df.columns:
        out = out.withColumn("ap_lo_extreme", flag((col("ap_lo") < 40) | (col("ap_lo") > 150)))
    if "height" in df.columns and "weight" in df.columns:
        out = out.withColumn("bmi_raw", _bmi()).withColumn(
            "bmi_outlier", flag((col("bmi_raw") < 15) | (col("bmi_raw") > 50)))
    return out


# --- fitted cleaners (F20-F29) ------------------------------------------------------------------

def _per_feature(qdf: DataFrame, prob: float) -> dict:
    return {r["feature"]: r["value"] for r in qdf.where(F.col("prob") == prob).collect()}


@dataclass
class FittedColumns:
    """Per-column constants applied as one projection (fitted medians, bounds, scales, ...)."""
    kind: str
    params: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c, p in self.params.items():
            if c not in df.columns:
                continue
            x = col(c)
            if self.kind == "fill":
                exprs[c] = x if p is None else F.coalesce(clean_double(x) if _is_num(df, c) else x, F.lit(p))
            elif self.kind == "replace":
                sentinel, value = p
                exprs[c] = F.when(x == sentinel, F.lit(value)).otherwise(x.cast("double"))
            elif self.kind == "clip":
                lo, hi = p
                exprs[c] = clip(x.cast("double"), lo, hi)
            elif self.kind == "scale":
                center, scale = p
                exprs[c] = (x.cast("double") - F.lit(center)) / F.lit(scale)
            else:
                raise ValueError(self.kind)
        return df.select(*[exprs[c].alias(c) if c in exprs else col(c) for c in df.columns])

    def table(self, spark) -> DataFrame:
        rows = [(c, str(p)) for c, p in self.params.items()]
        return spark.createDataFrame(rows, "feature string, param string")


def _is_num(df, c):
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


class MedianImputer:
    """exact training medians fill nulls (NaN counts as null) in any frame."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> FittedColumns:
        med = _per_feature(exact_quantiles(df, self.cols, [0.5]), 0.5)
        return FittedColumns("fill", {c: med.get(c) for c in self.cols})


class MixedImputer:
    """median for numeric columns, most frequent value for the others."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> FittedColumns:
        num = [c for c in self.cols if _is_num(df, c)]
        other = [c for c in self.cols if c not in num]
        params = {}
        if num:
            params.update(MedianImputer(num).fit(df).params)
        for c in other:  # text columns: mode per column (smallest value on ties)
            r = (df.where(col(c).isNotNull()).groupBy(col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.min_by("v", F.struct(-F.col("n"), F.col("v")))).first())
            params[c] = r[0]
        return FittedColumns("fill", params)


def fill_constants(df: DataFrame, mapping: dict) -> DataFrame:
    """F22."""
    return df.na.fill({k: v for k, v in mapping.items() if k in df.columns})


class SentinelImputer:
    """median over rows where the column is not the sentinel; sentinel -> that median."""

    def __init__(self, cols, sentinel=999):
        self.cols, self.sentinel = list(cols), sentinel

    def fit(self, df: DataFrame) -> FittedColumns:
        masked = df.select(*[F.when(col(c) != self.sentinel, col(c)).alias(c) for c in self.cols])
        med = _per_feature(exact_quantiles(masked, self.cols, [0.5]), 0.5)
        return FittedColumns("replace", {c: (self.sentinel, med.get(c)) for c in self.cols})


def sentinel_flags(df: DataFrame, cols, sentinel=999, suffix="_is_999") -> DataFrame:
    """indicator per column, total sentinel count and share of columns."""
    flags = [flag(col(c) == sentinel).alias(f"{c}{suffix}") for c in cols]
    total = reduce(lambda a, b: a + b, [flag(col(c) == sentinel) for c in cols])
    return df.select("*", *flags, total.alias("n_sentinel"), (total / len(cols)).alias("sentinel_share"))


class ConstantDropper:
    """columns with at most one distinct non-null value on training data are dropped."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> list[str]:
        kinds = feature_kinds(df, self.cols)
        return [r["feature"] for r in kinds.where(F.col("n_unique") <= 1).collect()]

    @staticmethod
    def transform(df: DataFrame, dropped) -> DataFrame:
        return drop_cols(df, dropped)


class Winsorizer:
    """clip to the training quantiles (1 % / 99 % by default)."""

    def __init__(self, cols, lower=0.01, upper=0.99):
        self.cols, self.lower, self.upper = list(cols), lower, upper

    def fit(self, df: DataFrame) -> FittedColumns:
        qs = exact_quantiles(df, self.cols, [self.lower, self.upper]).collect()
        b = {}
        for r in qs:
            b.setdefault(r["feature"], {})[r["prob"]] = r["value"]
        return FittedColumns("clip", {c: (b.get(c, {}).get(self.lower), b.get(c, {}).get(self.upper))
                                      for c in self.cols})


class IqrCapper:
    """cap to [Q1 - k IQR, Q3 + k IQR] the columns whose outlier share exceeds ``min_pct``."""

    def __init__(self, cols, k=1.5, min_pct=10.0):
        self.cols, self.k, self.min_pct = list(cols), k, min_pct

    def fit(self, df: DataFrame) -> FittedColumns:
        from .profile import iqr_outliers
        out = iqr_outliers(df, self.cols, self.k).where(F.col("outlier_pct") > self.min_pct).collect()
        return FittedColumns("clip", {r["feature"]: (r["lower"], r["upper"]) for r in out})


class ZScaler:
    """(x - mean) / population std; a zero std scales by 1."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> FittedColumns:
        st = fused_stats(df, self.cols, {"mean": F.avg, "std": F.stddev_pop}).collect()
        return FittedColumns("scale", {r["feature"]: (r["mean"], r["std"] if r["std"] else 1.0) for r in st})


class IqrScaler:
    """(x - median) / (Q3 - Q1) with exact quantiles; a zero IQR scales by 1."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> FittedColumns:
        b = {}
        for r in exact_quantiles(df, self.cols, [0.25, 0.5, 0.75]).collect():
            b.setdefault(r["feature"], {})[r["prob"]] = r["value"]
        params = {}
        for c in self.cols:
            q = b.get(c, {})
            iqr = (q.get(0.75) or 0.0) - (q.get(0.25) or 0.0)
            params[c] = (q.get(0.5) or 0.0, iqr if iqr else 1.0)
        return FittedColumns("scale", params)