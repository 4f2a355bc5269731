"""Profiling and statistics (A1-A29, P1, A11-A16 tests and scores).

Per-column statistics are fused into one aggregate over all columns (partial aggregation on the
map side, one tiny row back) and then reshaped into one row per feature. Distribution statistics
that need order (quantiles, medians, modes, top-value shares) run on the long form
``(feature, value)`` after counting each distinct value once, so repeated values never travel
more than once per partition and no column is ever gathered into a single buffer.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import keep, limit_generated_code
from ..spec import NUMERIC_TYPES
from .joins import sized_join
from .stats import clean_double, dealt, exact_quantiles, to_long


def _c(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


# One aggregate over more columns than this outgrows generated code; the long form is used instead.
FUSED_COLUMNS = 16
# Up to so many columns, all pairs are one aggregate of the built-in correlation.
CORR_COLUMNS = 8


def fused_stats(df: DataFrame, cols, metrics: dict, by=(), extra=()) -> DataFrame:
    """``metrics[m](column)`` for every column in one aggregate; one row per (by, feature).

    ``metrics`` maps an output name to a function Column -> aggregate Column; ``extra`` names other
    columns that they read. Wide frames are unpivoted once and aggregated by feature, so the plan does
    not grow with the columns."""
    cols = list(cols)
    by = list(by)
    if len(cols) > FUSED_COLUMNS:
        longf = to_long(dealt(df.select(*by, *extra, *[_c(c) for c in cols])), cols, keep=[*by, *extra], drop_nulls=False)
        return longf.groupBy(*by, "feature").agg(*[fn(F.col("value")).alias(m) for m, fn in metrics.items()])
    aggs = [fn(clean_double(_c(c))).alias(f"_{i}__{m}") for i, c in enumerate(cols) for m, fn in metrics.items()]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"),
                              *[F.col(f"_{i}__{m}").alias(m) for m in metrics]) for i, c in enumerate(cols)])
    return wide.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.*")


def counted_values(df: DataFrame, cols, held: int = 1 << 20) -> DataFrame:
    """``(feature, value, c)``: rows of each distinct number of each column. Wide frames are not unpivoted: a task counts the
    values of its Arrow batches column by column and passes on at most about ``held`` distinct ones at a time."""
    cols = list(cols)
    if len(cols) <= FUSED_COLUMNS:
        longf = to_long(dealt(df.select(*[_c(c) for c in cols])), cols)
        return longf.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))

    def kernel(batches):
        seen = [(np.zeros(0), np.zeros(0, np.int64)) for _ in cols]
        size = 0

        def rows():
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(cols), dtype=np.int32), [len(v) for v, _ in seen])),
                                              pa.array(np.concatenate([v for v, _ in seen])), pa.array(np.concatenate([c for _, c in seen]))], names=["i", "value", "c"])
        for b in batches:
            size = 0
            for k in range(len(cols)):
                x = b.column(k).to_numpy(zero_copy_only=False).astype(np.float64)
                x = x[np.isfinite(x)]
                new, n = np.unique(x, return_counts=True)  # a plain sort; only distinct values are merged by places
                v, where = np.unique(np.concatenate([seen[k][0], new]), return_inverse=True)
                seen[k] = v, np.bincount(where, np.concatenate([seen[k][1], n]), len(v)).astype(np.int64)
                size += len(v)
            if size > held:
                yield from rows()
                seen = [(np.zeros(0), np.zeros(0, np.int64)) for _ in cols]
        yield from rows()

    limit_generated_code(df.sparkSession)
    src = dealt(df.select(*[_c(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]))
    found = src.mapInArrow(kernel, "i int, value double, c bigint").groupBy("i", "value").agg(F.sum("c").alias("c"))
    return found.select(F.get(F.array(*[F.lit(c) for c in cols]), F.col("i")).alias("feature"), "value", "c")


def value_moments(df: DataFrame, cols) -> DataFrame:
    """``(feature, n, n_unique, mean, m2, m3, m4)`` per column from one pass over the data: rows are
    counted per (feature, value), and the distinct values give the distinct count and the central sums.
    Several exact distinct counts in one aggregate would expand every row by the number of columns and
    keep it. A column without a number has n = 0."""
    cols = list(cols)
    counts = keep(counted_values(df, cols))
    c, v = F.col("c").cast("double"), F.col("value")
    means = counts.groupBy("feature").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_unique"), (F.sum(c * v) / F.sum(c)).alias("mean"))
    d = v - F.col("mean")
    found = (sized_join(counts, means, "feature", "inner").groupBy("feature", "n", "n_unique", "mean")
             .agg(*[F.sum(c * reduce(lambda x, y: x * y, [d] * k)).alias(f"m{k}") for k in (2, 3, 4)]))
    names = df.sparkSession.createDataFrame([(x,) for x in cols], "feature string")
    return names.join(found, "feature", "left").withColumns({x: F.coalesce(x, F.lit(0)) for x in ("n", "n_unique")})


# --- A1, A22, A24: value counts, crosstab, mode --------------------------------------------

def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A1: rows per value (nulls excluded) and share of non-null rows."""
    counts = keep(df.where(_c(col).isNotNull()).groupBy(_c(col).alias("value")).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.withColumn("share", F.col("n") / F.lit(float(total) if total else None))


def crosstab_long(df: DataFrame, cat: str, label_col: str) -> DataFrame:
    """Category x class counts (long form)."""
    return df.groupBy(_c(cat).alias("category"), _c(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def mode_value(df: DataFrame, cols) -> DataFrame:
    """Most frequent value per column, smallest value on ties (as pandas ``mode()[0]``)."""
    longf = to_long(df, cols)
    counts = longf.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"),
                                         F.max("n").alias("mode_count"))


# --- A2, A3, A4, A6, A7, A19: per-column summaries ------------------------------------------

def describe_exact(df: DataFrame, cols, by=()) -> DataFrame:
    """A2: count, mean, sample std, min, exact quartiles, max per column (nulls skipped)."""
    by = list(by)
    base = fused_stats(df, cols, {"count": F.count, "mean": F.avg, "std": F.stddev_samp,
                                  "min": F.min, "max": F.max}, by)
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by=by)
    piv = qs.groupBy(*by, "feature").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                           for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return base.join(piv, by + ["feature"], "left").select(*by, "feature", "count", "mean", "std", "min",
                                                            "q25", "q50", "q75", "max")


def moments(df: DataFrame, cols) -> DataFrame:
    """A3: sample variance, bias-corrected skewness (G1) and excess kurtosis (G2), distinct count."""
    n, m2 = F.col("n").cast("double"), F.col("m2")
    var = F.when(n > 1, m2 / (n - 1))
    g1 = F.when(m2 > 0, (F.col("m3") / n) / F.pow(m2 / n, 1.5))
    g2 = F.when(m2 > 0, (F.col("m4") / n) / F.pow(m2 / n, 2) - 3)
    skew = F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return value_moments(df, cols).select("feature", var.alias("var"), skew.alias("skewness"), kurt.alias("kurtosis"), "n_unique")


def null_counts(df: DataFrame, cols) -> DataFrame:
    """A4: nulls per column (NaN counts as missing), their share of rows."""
    stats = fused_stats(df, cols, {"nulls": lambda c: F.count_if(c.isNull()), "rows": lambda c: F.count(F.lit(1))})
    return stats.select("feature", "nulls", (F.col("nulls") / F.col("rows")).alias("null_share"))


def null_total(df: DataFrame, cols) -> DataFrame:
    """A4: missing values of the whole table and their share of all its values."""
    return null_counts(df, cols).agg(F.sum("nulls").alias("nulls"), F.avg("null_share").alias("null_share"))


def feature_kinds(df: DataFrame, cols, low_var: float = 0.01) -> DataFrame:
    """Constant (1 distinct), binary (2), few (<10) or many values; low variance (< low_var)."""
    n = F.col("n").cast("double")
    st = value_moments(df, cols).withColumn("var", F.when(n > 1, F.col("m2") / (n - 1)))
    kind = (F.when(F.col("n_unique") == 1, "constant").when(F.col("n_unique") == 2, "binary")
            .when(F.col("n_unique") < 10, "few").when(F.col("n_unique") == 0, "empty").otherwise("many"))
    return st.select("feature", "n_unique", "var", kind.alias("kind"),
                     F.coalesce((F.col("var") < low_var).cast("int"), F.lit(0)).alias("low_variance"))


def near_constant(df: DataFrame, cols, cut: float = 0.99) -> DataFrame:
    """Share of the most frequent value among non-null values; flag above ``cut``."""
    counts = to_long(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("feature").agg((F.max("n") / F.sum("n")).alias("top_share"))
    return top.withColumn("near_constant", (F.col("top_share") > cut).cast("int"))


def quantiles(df: DataFrame, cols, probs, by=()) -> DataFrame:
    """Exact quantiles (linear interpolation) per column."""
    return exact_quantiles(df, cols, probs, by=by)


# --- A5, R4: sentinel profile -----------------------------------------------------------------

def sentinel_row_type(cols, sentinel=999) -> Column:
    """P8: 'all' when every column equals the sentinel, 'partial' when some do, else 'none'."""
    hits = reduce(lambda a, b: a + b, [F.coalesce((_c(c) == sentinel).cast("int"), F.lit(0)) for c in cols])
    return F.when(hits == len(cols), "all").when(hits > 0, "partial").otherwise("none")


def sentinel_profile(df: DataFrame, cols, sentinel=999) -> DataFrame:
    """A5: rows holding the sentinel per column and their percentage; only columns with any."""
    st = fused_stats(df, cols, {"sentinel_count": lambda c: F.count_if(c == sentinel),
                                "rows": lambda c: F.count(F.lit(1))})
    return (st.where(F.col("sentinel_count") > 0)
            .select("feature", "sentinel_count", (F.col("sentinel_count") * 100.0 / F.col("rows")).alias("sentinel_pct")))


def sentinel_class_counts(df: DataFrame, cols, sentinel=999, label_col: str | None = None) -> DataFrame:
    """Rows per sentinel class (none / partial / all), optionally by label."""
    keys = [sentinel_row_type(cols, sentinel).alias("row_type")]
    if label_col:
        keys.append(_c(label_col).alias("label"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# --- A8, A21: outliers and box summaries ---------------------------------------------------

def _quartile_bounds(df, cols, by, k):
    qs = exact_quantiles(df, cols, [0.25, 0.75], by=by)
    return (qs.groupBy(*by, "feature")
            .agg(F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
                 F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
            .withColumn("lower", F.col("q1") - k * (F.col("q3") - F.col("q1")))
            .withColumn("upper", F.col("q3") + k * (F.col("q3") - F.col("q1"))))


def iqr_outliers(df: DataFrame, cols, k: float = 1.5, keep_zero: bool = False) -> DataFrame:
    """Rows strictly outside [Q1 - k IQR, Q3 + k IQR]; count, share of all rows in %.

    Pass 1 computes the bounds (exact quartiles), pass 2 counts with the bounds joined per feature
    (a table of one row per feature)."""
    bounds = _quartile_bounds(df, cols, [], k)
    longf = to_long(df, cols, drop_nulls=False)
    counted = (longf.join(F.broadcast(bounds), "feature")  # one row per feature
               .groupBy("feature", "lower", "upper")
               .agg(F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("outliers"),
                    F.count(F.lit(1)).alias("rows")))
    out = counted.select("feature", "outliers", (F.col("outliers") * 100.0 / F.col("rows")).alias("outlier_pct"),
                         "lower", "upper")
    return out if keep_zero else out.where(F.col("outliers") > 0)


def box_summary(df: DataFrame, cols, by=(), k: float = 1.5) -> DataFrame:
    """Quartiles, median, whiskers (most extreme values inside the fences), outlier count."""
    by = list(by)
    qs = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by=by)
    b = (qs.groupBy(*by, "feature")
         .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
         .withColumn("lower", F.col("q1") - k * (F.col("q3") - F.col("q1")))
         .withColumn("upper", F.col("q3") + k * (F.col("q3") - F.col("q1"))))
    longf = to_long(df, cols, keep=by)
    v, lo, hi = F.col("value"), F.col("lower"), F.col("upper")
    joined = sized_join(longf, b, by + ["feature"], "inner") if by else longf.join(F.broadcast(b), "feature")
    agg = (joined  # bounds: one row per (by, feature); broadcast after counting when grouped
           .groupBy(*by, "feature", "q1", "median", "q3")
           .agg(F.min(F.when(v >= lo, v)).alias("whisker_low"), F.max(F.when(v <= hi, v)).alias("whisker_high"),
                F.count_if((v < lo) | (v > hi)).alias("outliers")))
    return agg


# --- A9, A10, A11, A16: by-class statistics -------------------------------------------------

def class_ranges(df: DataFrame, cols, label_col: str) -> DataFrame:
    """Per class min / max / mean / exact median / sample std."""
    st = fused_stats(df, cols, {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp},
                     by=[label_col])
    med = exact_quantiles(df, cols, [0.5], by=[label_col]).select(label_col, "feature", F.col("value").alias("median"))
    return st.join(med, [label_col, "feature"], "left").select(
        F.col(label_col).alias("label"), "feature", "min", "max", "mean", "median", "std")


def class_variance_ratio(df: DataFrame, cols, label_col: str) -> DataFrame:
    """A10: sample variance per class and max / (min + 1e-10)."""
    st = fused_stats(df, cols, {"var": F.var_samp}, by=[label_col])
    return (st.groupBy("feature")
            .agg(F.max(F.when(F.col(label_col) == 0, F.col("var"))).alias("var_0"),
                 F.max(F.when(F.col(label_col) == 1, F.col("var"))).alias("var_1"),
                 (F.max("var") / (F.min("var") + 1e-10)).alias("variance_ratio")))


def class_moments(df: DataFrame, cols, label_col: str) -> DataFrame:
    """(feature, label, n, mean, var) in one aggregate: the basis of the t-test and ANOVA F."""
    return fused_stats(df, cols, {"n": F.count, "mean": F.avg, "var": F.var_samp}, by=[label_col])


def ttest(df: DataFrame, cols, label_col: str, classes=(0, 1)) -> DataFrame:
    """Pooled two-sample t statistic, class 0 minus class 1, with both means."""
    a, b = classes
    cm = class_moments(df, cols, label_col)
    g = cm.groupBy("feature").agg(
        *[F.max(F.when(F.col(label_col) == cls, F.col(m))).alias(f"{m}_{i}")
          for i, cls in enumerate((a, b)) for m in ("n", "mean", "var")])
    n0, n1 = F.col("n_0").cast("double"), F.col("n_1").cast("double")
    sp2 = ((n0 - 1) * F.col("var_0") + (n1 - 1) * F.col("var_1")) / (n0 + n1 - 2)
    t = (F.col("mean_0") - F.col("mean_1")) / F.sqrt(sp2 * (1 / n0 + 1 / n1))
    return g.select("feature", F.col("mean_0").alias("mean_class_0"), F.col("mean_1").alias("mean_class_1"),
                    t.alias("t_statistic"), (n0 + n1 - 2).alias("dof"))


def t_pvalues(tt: DataFrame) -> DataFrame:
    """Two-sided p-values for a (small, per-feature) t-test table via the JVM's t distribution."""
    spark = tt.sparkSession
    jvm = spark.sparkContext._jvm
    rows = []
    for r in tt.collect():  # one row per feature
        t, dof = r["t_statistic"], r["dof"]
        if t is None or dof is None or dof <= 0 or math.isnan(t):
            p = None
        else:
            dist = jvm.org.apache.commons.math3.distribution.TDistribution(float(dof))
            p = 2.0 * dist.cumulativeProbability(-abs(float(t)))
        rows.append((r["feature"], t, p, None if p is None else int(p < 0.05)))
    return spark.createDataFrame(rows, "feature string, t_statistic double, p_value double, significant int")


def anova_f(df: DataFrame, cols, label_col: str) -> DataFrame:
    """One-way ANOVA F per feature from per-class (n, mean, var)."""
    cm = class_moments(df, cols, label_col).where(F.col("n") > 0)
    n, m, v = F.col("n").cast("double"), F.col("mean"), F.coalesce(F.col("var"), F.lit(0.0))
    g = cm.groupBy("feature").agg(F.sum(n).alias("N"), F.count(F.lit(1)).alias("k"),
                                  F.sum(n * m).alias("S"), F.sum(n * m * m).alias("SS"),
                                  F.sum((n - 1) * v).alias("ssw"))
    ssb = F.col("SS") - F.col("S") * F.col("S") / F.col("N")
    return g.select("feature", ((ssb / (F.col("k") - 1)) / (F.col("ssw") / (F.col("N") - F.col("k")))).alias("f_score"))


# --- A12, A13: correlation ---------------------------------------------------------------

def corr_pairs(df: DataFrame, cols, min_abs: float = 0.0) -> DataFrame:
    """Pearson r of every column pair (i < j) over the rows that have both; pairs with |r| > min_abs.

    One pass. A few columns are one aggregate of the built-in correlation. Beyond, every Arrow batch adds four products of the
    centred columns and their presence masks (a Gram matrix with nulls), every task returns its p x p sums, and those
    are added up by pair."""
    cols = list(cols)
    if len(cols) <= CORR_COLUMNS:
        clean = df.select(*[clean_double(_c(c)).alias(f"c{i}") for i, c in enumerate(cols)])
        pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
        if not pairs:
            return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, corr double")
        got = clean.agg(*[F.corr(f"c{i}", f"c{j}").alias(f"r{i}_{j}") for i, j in pairs])
        rows = F.array(*[F.struct(F.lit(cols[i]).alias("feature_a"), F.lit(cols[j]).alias("feature_b"),
                                  F.when(~F.isnan(f"r{i}_{j}"), F.col(f"r{i}_{j}")).alias("corr")) for i, j in pairs])
        return got.select(F.explode(rows).alias("r")).select("r.*").where(F.abs(F.col("corr")) > min_abs)
    limit_generated_code(df.sparkSession)
    src = dealt(df.select(*[_c(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]))
    # any constant may be taken off a column; the mean of some rows keeps the sums small
    some = src.limit(1000).toPandas().to_numpy(dtype=float)
    mean = np.array([v[np.isfinite(v)].mean() if np.isfinite(v).any() else 0.0 for v in some.T]) if len(some) else np.zeros(len(cols))

    def sums(batches):
        total = None
        for b in batches:
            x = np.column_stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(b.num_columns)]).astype(float) - mean
            m = np.isfinite(x)
            x, m = np.where(m, x, 0.0), m.astype(float)
            part = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(cols), 1)
            n, sx, sxx, sxy = total
            out = (i, j, n[i, j], sx[i, j], sx[j, i], sxx[i, j], sxx[j, i], sxy[i, j])
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    parts = src.mapInArrow(sums, "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double")
    t = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    var = (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")) * (F.col("n") * F.col("syy") - F.col("sy") * F.col("sy"))
    names = F.array(*[F.lit(c) for c in cols])
    r = F.when((F.col("n") > 1) & (var > 0), (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(var))
    out = t.select(F.get(names, F.col("i").cast("int")).alias("feature_a"), F.get(names, F.col("j").cast("int")).alias("feature_b"), r.alias("corr"))
    return out.where(F.abs(F.col("corr")) > min_abs)


def target_corr(df: DataFrame, cols, label_col: str) -> DataFrame:
    """Pearson r of each feature with the label and its absolute value."""
    st = fused_stats(df.withColumn("_y", _c(label_col).cast("double")), cols,
                     {"corr": lambda c: F.corr(c, F.col("_y"))}, extra=["_y"])
    return st.select("feature", "corr", F.abs("corr").alias("abs_corr"))


# --- A15, A17, A18: MI on codes, target statistics, group means ----------------------------

def mutual_info_discrete(df: DataFrame, cols, label_col: str) -> DataFrame:
    """Plug-in mutual information (nats) between each coded feature and the label."""
    longf = to_long(df, cols, keep=[label_col]).withColumnRenamed(label_col, "y")
    joint = longf.groupBy("feature", "value", "y").agg(F.count(F.lit(1)).alias("nxy"))
    nx = joint.groupBy("feature", "value").agg(F.sum("nxy").alias("nx"))
    ny = joint.groupBy("feature", "y").agg(F.sum("nxy").alias("ny"))   # features x classes rows
    n = ny.groupBy("feature").agg(F.sum("ny").alias("n"))             # one row per feature
    j = sized_join(sized_join(joint.join(nx, ["feature", "value"]), ny, ["feature", "y"], "inner"), n, "feature", "inner")
    nxy, nx, ny, n = (F.col(c).cast("double") for c in ("nxy", "nx", "ny", "n"))  # long products overflow at scale
    term = nxy / n * F.log(nxy / nx * (n / ny))
    return j.groupBy("feature").agg(F.sum(term).alias("mi"))


def target_stats(df: DataFrame, col: str, label_col: str) -> DataFrame:
    """Mean and sample std of the label per feature value."""
    y = _c(label_col).cast("double")
    return df.groupBy(_c(col).alias("value")).agg(F.avg(y).alias("target_mean"), F.stddev_samp(y).alias("target_std"),
                                                  F.count(F.lit(1)).alias("n"))


def group_means(df: DataFrame, keys, cols) -> DataFrame:
    """Mean of ``cols`` per key combination."""
    return df.groupBy(*[_c(k) for k in keys]).agg(*[F.avg(clean_double(_c(c))).alias(f"mean_{c}") for c in cols])


# --- A20, A28: histograms ------------------------------------------------------------------

def histogram(df: DataFrame, cols, bins: int = 10, by=None, density: bool = False) -> DataFrame:
    """Equal-width bins between each column's min and max (last bin closed).

    ``density`` divides the count by the (class) total and by the bin width."""
    keep = [by] if by else []
    rng = fused_stats(df, cols, {"lo": F.min, "hi": F.max})
    longf = to_long(df, cols, keep=keep)
    w = (F.col("hi") - F.col("lo")) / bins
    idx = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / w).cast("int"), F.lit(bins - 1)))
    grp = ([F.col(by).alias("label")] if by else [])
    h = (longf.join(F.broadcast(rng), "feature")  # one row per feature
         .groupBy("feature", *grp, idx.alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("n")))
    out = h.select("feature", *(["label"] if by else []), "bin",
                   (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_lo"),
                   (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_hi"), "n")
    if not density:
        return out
    part = ["feature"] + (["label"] if by else [])
    tot = out.groupBy(*part).agg(F.sum("n").alias("_tot"))
    width = F.col("bin_hi") - F.col("bin_lo")
    return (out.join(tot, part)
            .withColumn("density", F.when(width > 0, F.col("n") / F.col("_tot") / width)).drop("_tot"))


# --- A23, A25-A27, A29, P1 -------------------------------------------------------------------

def pair_sample(df: DataFrame, id_col: str, label_col: str, cols, n: int, seed=42) -> DataFrame:
    """At most n rows per class, chosen by ``md5(seed:id)`` order (exact, reproducible)."""
    from .order import hash_rank
    ranked = hash_rank(df.select(id_col, label_col, *cols), id_col, seed, by=[label_col])
    return ranked.where(F.col("rank") <= n)


def error_feature_gap(df: DataFrame, cols, wrong_col: str) -> DataFrame:
    """Mean of each feature on wrong and right rows, absolute difference."""
    wrong = _c(wrong_col).cast("boolean")
    st = fused_stats(df.withColumn("_w", wrong), cols,
                     {"error_mean": lambda c: F.avg(F.when(F.col("_w"), c)),
                      "correct_mean": lambda c: F.avg(F.when(~F.col("_w"), c))})
    return st.withColumn("abs_diff", F.abs(F.col("error_mean") - F.col("correct_mean")))


def prob_summary(df: DataFrame, prob_col: str) -> DataFrame:
    """Min / mean / max of a probability column."""
    return df.agg(F.min(prob_col).alias("min"), F.avg(prob_col).alias("mean"), F.max(prob_col).alias("max"))


def range_check(df: DataFrame, cols, max_abs: float = 10_000) -> DataFrame:
    """Min and max per column; flag when either exceeds ``max_abs`` in absolute value."""
    st = fused_stats(df, cols, {"min": F.min, "max": F.max})
    return st.withColumn("too_large", ((F.abs("min") > max_abs) | (F.abs("max") > max_abs)).cast("int"))


def column_kinds(df: DataFrame) -> list[tuple[str, str, str]]:
    """(column, type, numeric|other) from the schema."""
    return [(f.name, f.dataType.simpleString(), "numeric" if isinstance(f.dataType, NUMERIC_TYPES) else "other")
            for f in df.schema.fields]


def table_summary(df: DataFrame) -> DataFrame:
    """Rows, per-column type, kind and non-null count, in one aggregate."""
    kinds = column_kinds(df)
    aggs = [F.count(_c(name)).alias(f"_{i}") for i, (name, _, _) in enumerate(kinds)]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.lit(typ).alias("type"), F.lit(kind).alias("kind"),
                              F.col(f"_{i}").alias("non_null")) for i, (name, typ, kind) in enumerate(kinds)])
    return wide.select(F.col("_rows").alias("rows"), F.explode(rows).alias("r")).select("r.*", "rows")
