"""Feature builders.

Generated feature packs are one ``select`` each (never a chain of ``withColumn``), so a wide pack
stays a single projection inside whole-stage codegen. Fitted builders (bins, encoders, group
statistics, clusters, components) are fitted once on training rows and applied unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col, safe_ratio, unary
from .joins import sized_join
from .stats import clean_double, exact_quantiles

# --- F30-F32: interactions and unary packs ---------------------------------------------------

OPS = {
    "mul": ("x", lambda a, b: col(a).cast("double") * col(b).cast("double")),
    "add": ("plus", lambda a, b: col(a).cast("double") + col(b).cast("double")),
    "sub": ("minus", lambda a, b: col(a).cast("double") - col(b).cast("double")),
    "div": ("div", lambda a, b: safe_ratio(a, b, 1e-8)),
}


def band_interactions(df: DataFrame, ranked, n: int, w: int, ops=("mul",)) -> DataFrame:
    """for i < j < i + w among the first n ranked features, one column per op."""
    top = [c for c in ranked if c in df.columns][:n]
    new = []
    for i, a in enumerate(top):
        for b in top[i + 1:i + w]:
            for op in ops:
                tag, fn = OPS[op]
                new.append(fn(a, b).alias(f"{a}_{tag}_{b}"))
    return df.select("*", *new)


def pair_interactions(df: DataFrame, pairs, op: str = "mul") -> DataFrame:
    """named pairs, only where both columns exist."""
    tag, fn = OPS[op]
    have = set(df.columns)
    return df.select("*", *[fn(a, b).alias(f"{a}_{tag}_{b}") for a, b in pairs if a in have and b in have])


def unary_pack(df: DataFrame, cols, kinds=("log1p_abs", "sqrt_abs", "square")) -> DataFrame:
    """F32: unary transforms of the chosen columns."""
    return df.select("*", *[unary(c, k).alias(f"{c}_{k}") for c in cols if c in df.columns for k in kinds])


# --- F33-F35: binning ------------------------------------------------------------------------

def bin_expr(c, edges, include_lowest: bool = True, labels=None, default=None) -> Column:
    """Right-closed bins (e_i, e_{i+1}]; ``include_lowest`` closes the first bin on the left.
    Values outside every bin get ``default`` (null if none)."""
    x = col(c)
    labels = list(range(len(edges) - 1)) if labels is None else list(labels)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = ((x >= lo) if (i == 0 and include_lowest) else (x > lo)) & (x <= hi)
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def bin_fixed(c, edges, labels=None, include_lowest: bool = False, default=None) -> Column:
    """fixed edges, right-closed, optional labels and default code."""
    return bin_expr(c, edges, include_lowest, labels, default)


@dataclass
class Binned:
    edges: dict  # column -> edge list

    def transform(self, df: DataFrame, suffix: str) -> DataFrame:
        return df.select("*", *[bin_expr(c, e, True).alias(f"{c}{suffix}") for c, e in self.edges.items()])


class QuantileBinner:
    """equal-frequency bins from exact training quantiles, duplicate edges dropped."""

    def __init__(self, cols, q: int = 5):
        self.cols, self.q = list(cols), q

    def fit(self, df: DataFrame) -> Binned:
        probs = [i / self.q for i in range(self.q + 1)]
        per = {}
        for r in exact_quantiles(df, self.cols, probs).collect():
            per.setdefault(r["feature"], {})[r["prob"]] = r["value"]
        edges = {c: sorted(set(per[c][p] for p in probs)) for c in self.cols if c in per}
        return Binned(edges)


class WidthBinner:
    """equal-width bins between the training min and max (low edge widened by 0.1 %)."""

    def __init__(self, cols, n: int = 5):
        self.cols, self.n = list(cols), n

    def fit(self, df: DataFrame) -> Binned:
        row = df.agg(*[F.min(col(c)).alias(f"lo{i}") for i, c in enumerate(self.cols)],
                     *[F.max(col(c)).alias(f"hi{i}") for i, c in enumerate(self.cols)]).first()
        edges = {}
        for i, c in enumerate(self.cols):
            mn, mx = float(row[f"lo{i}"]), float(row[f"hi{i}"])
            if mn == mx:
                adj = 0.001 * abs(mn) if mn != 0 else 0.001
                e = list(np.linspace(mn - adj, mx + adj, self.n + 1))
            else:
                e = list(np.linspace(mn, mx, self.n + 1))
                e[0] = e[0] - (mx - mn) * 0.001
            edges[c] = [float(x) for x in e]
        return Binned(edges)


# --- F36: one-hot with the first level dropped ------------------------------------------------

@dataclass
class Dummies:
    levels: dict  # column -> sorted levels

    def transform(self, df: DataFrame, drop_source: bool = True) -> DataFrame:
        new = [F.coalesce((col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
               for c, lv in self.levels.items() for v in lv[1:]]
        base = [col(x) for x in df.columns if not (drop_source and x in self.levels)]
        return df.select(*base, *new)


class DummyEncoder:
    """levels seen at fit (sorted); indicator per level except the first.

    Levels come back to the driver (they become column names), so the caller says how many are at most expected:
    a column with more than ``max_levels`` distinct values is refused with an error instead of collected."""

    def __init__(self, cols, max_levels: int):
        self.cols, self.max_levels = list(cols), max_levels

    def fit(self, df: DataFrame) -> Dummies:
        levels = {}
        for c in self.cols:
            distinct = df.select(col(c)).where(col(c).isNotNull()).distinct()
            got = distinct.limit(self.max_levels + 1).collect()
            if len(got) > self.max_levels:
                raise ValueError(f"{c}: more than {self.max_levels} levels; use TargetStatEncoder instead")
            levels[c] = sorted(r[0] for r in got)
        return Dummies(levels)


# --- F37: target statistics encoding ------------------------------------------------------

def _y_sums(df, c, label_col, by=()):
    y = col(label_col).cast("double")
    return df.groupBy(*by, col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_s"),
                                                   F.sum(y * y).alias("_ss"))


def _mean_std(n, s, ss):
    mean = s / n
    var = F.when(n > 1, (ss - s * s / n) / (n - 1))
    return mean, F.sqrt(F.greatest(var, F.lit(0.0)))


class TargetStatEncoder:
    """per value the label mean and sample std; unseen values get the global ones.

    With ``fold_col`` the statistics for a row come only from the other folds (leak-free
    out-of-fold encoding): fold statistics are total minus own fold, so one aggregate serves
    every fold."""

    def __init__(self, cols, label_col: str, fold_col: str | None = None):
        self.cols, self.label_col, self.fold_col = list(cols), label_col, fold_col

    def fit_transform(self, df: DataFrame) -> DataFrame:
        out = df
        y = col(self.label_col).cast("double")
        g = df.agg(F.avg(y).alias("m"), F.stddev_samp(y).alias("s")).first()
        for c in self.cols:
            tot = _y_sums(df, c, self.label_col)
            if self.fold_col is None:
                m, s = _mean_std(F.col("_n"), F.col("_s"), F.col("_ss"))
                stats = tot.select(F.col("_v").alias(c), m.alias(f"{c}_target_mean"), s.alias(f"{c}_target_std"))
                out = sized_join(out, stats, [c], "left")
            else:
                per = _y_sums(df, c, self.label_col, by=[self.fold_col])
                oof = (per.join(tot.withColumnRenamed("_n", "_tn").withColumnRenamed("_s", "_ts")
                                .withColumnRenamed("_ss", "_tss"), "_v")
                       .select(self.fold_col, "_v", (F.col("_tn") - F.col("_n")).alias("_n"),
                               (F.col("_ts") - F.col("_s")).alias("_s"), (F.col("_tss") - F.col("_ss")).alias("_ss")))
                m, s = _mean_std(F.col("_n"), F.col("_s"), F.col("_ss"))
                stats = oof.select(self.fold_col, F.col("_v").alias(c),
                                   F.when(F.col("_n") > 0, m).alias(f"{c}_target_mean"), s.alias(f"{c}_target_std"))
                out = sized_join(out, stats, [self.fold_col, c], "left")
            out = out.withColumn(f"{c}_target_mean", F.coalesce(F.col(f"{c}_target_mean"), F.lit(g["m"]))) \
                     .withColumn(f"{c}_target_std", F.coalesce(F.col(f"{c}_target_std"), F.lit(g["s"])))
        return out

    def fit(self, df: DataFrame):
        """Training statistics for scoring frames (the full-data encoding)."""
        y = col(self.label_col).cast("double")
        g = df.agg(F.avg(y).alias("m"), F.stddev_samp(y).alias("s")).first()
        tables = {}
        for c in self.cols:
            m, s = _mean_std(F.col("_n"), F.col("_s"), F.col("_ss"))
            tables[c] = _y_sums(df, c, self.label_col).select(
                F.col("_v").alias(c), m.alias(f"{c}_target_mean"), s.alias(f"{c}_target_std"))
        return FittedLookups(tables, {"mean": g["m"], "std": g["s"]})


@dataclass
class FittedLookups:
    tables: dict
    defaults: dict

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, t in self.tables.items():
            out = sized_join(out, t, [c], "left")
            out = out.withColumn(f"{c}_target_mean", F.coalesce(F.col(f"{c}_target_mean"), F.lit(self.defaults["mean"]))) \
                     .withColumn(f"{c}_target_std", F.coalesce(F.col(f"{c}_target_std"), F.lit(self.defaults["std"])))
        return out


class OrderedTargetEncoder:
    """Per category the label's mean over the rows before a row, in the order of ``md5(seed:id)``, drawn to the overall
    mean by ``smoothing`` rows of it: ``(sum + smoothing * mean) / (n + smoothing)``. A null category is one of its own. The running sums
    are the bucketed prefix sum per category, so a category that holds most rows is not one task."""

    def __init__(self, cols, label_col: str, id_col: str, seed=42, smoothing: float = 1.0):
        self.cols, self.label_col, self.id_col, self.seed, self.smoothing = list(cols), label_col, id_col, seed, float(smoothing)

    def _mean(self, df: DataFrame) -> float:
        return df.agg(F.avg(col(self.label_col).cast("double"))).first()[0] or 0.0

    def _drawn(self, total, n, mean: float):
        return (F.coalesce(total, F.lit(0.0)) + self.smoothing * mean) / F.when(F.coalesce(n, F.lit(0)) + self.smoothing > 0, F.coalesce(n, F.lit(0)) + self.smoothing)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        """Training rows with ``<col>_ordered_mean``; rows without a label are not counted."""
        from .order import hash_key, prefix_sum
        mean = self._mean(df)
        digest, number = hash_key(self.id_col, self.seed)
        y = col(self.label_col).cast("double")
        out = df.select("*", digest.alias("_ord_md5"), number.alias("_ord_num"), F.coalesce(y, F.lit(0.0)).alias("_ord_y"), y.isNotNull().cast("int").alias("_ord_one"))
        for c in self.cols:
            out = prefix_sum(out, "_ord_num", ["_ord_y", "_ord_one"], part_cols=[c], tie_cols=["_ord_md5", self.id_col], inclusive=False, prefix="_before")
            out = out.withColumn(f"{c}_ordered_mean", F.coalesce(self._drawn(F.col("_before_ord_y"), F.col("_before_ord_one"), mean), F.lit(mean)))
            out = out.drop("_before_ord_y", "_before_ord_one")
        return out.drop("_ord_md5", "_ord_num", "_ord_y", "_ord_one")

    def fit(self, df: DataFrame) -> "FittedOrdered":
        """Statistics over all training rows, for scoring frames."""
        mean, y = self._mean(df), col(self.label_col).cast("double")
        tables = {c: df.where(y.isNotNull()).groupBy(col(c).alias("_v")).agg(F.sum(y).alias("_s"), F.count(F.lit(1)).alias("_n"))
                  .select("_v", self._drawn(F.col("_s"), F.col("_n"), mean).alias(f"{c}_ordered_mean")) for c in self.cols}
        return FittedOrdered(tables, mean)


@dataclass
class FittedOrdered:
    tables: dict
    mean: float

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with ``<col>_ordered_mean``, the overall mean for an unseen category."""
        out = df
        for c, t in self.tables.items():
            out = sized_join(out, t, col(c).eqNullSafe(F.col("_v"))).drop("_v")
            out = out.withColumn(f"{c}_ordered_mean", F.coalesce(F.col(f"{c}_ordered_mean"), F.lit(self.mean)))
        return out


# --- F38, F39: deviations from training means -------------------------------------------

@dataclass
class GroupMeans:
    keys: list
    cols: list
    table: DataFrame

    def transform(self, df: DataFrame, names: dict | None = None) -> DataFrame:
        names = names or {c: f"{c}_deviation" for c in self.cols}
        j = sized_join(df, self.table, self.keys, "left")
        return j.select(*[col(c) for c in df.columns],
                        *[(col(c) - F.col(f"_gm_{c}")).alias(names[c]) for c in self.cols])


class GroupDeviation:
    """value minus the training mean of its key group (null for an unseen group)."""

    def __init__(self, keys, cols):
        self.keys, self.cols = list(keys), list(cols)

    def fit(self, df: DataFrame) -> GroupMeans:
        t = df.groupBy(*[col(k) for k in self.keys]).agg(*[F.avg(col(c)).alias(f"_gm_{c}") for c in self.cols])
        return GroupMeans(self.keys, self.cols, t)


class MeanDeviation:
    """value minus the training mean (the mean is passed on to scoring frames)."""

    def __init__(self, c):
        self.c = c

    def fit(self, df: DataFrame) -> float:
        return df.agg(F.avg(col(self.c))).first()[0]

    def transform(self, df: DataFrame, mean: float, name: str | None = None) -> DataFrame:
        return df.withColumn(name or f"{self.c}_m_diff", col(self.c) - F.lit(mean))


# --- F40-F43: cluster labels, distances, principal and independent components -----------

def complete_rows(df: DataFrame, cols) -> DataFrame:
    """Rows whose ``cols`` are all numbers."""
    ok = None
    for c in cols:
        t = clean_double(col(c)).isNotNull()
        ok = t if ok is None else ok & t
    return df.where(ok)


def fit_fill(df: DataFrame, cols) -> dict:
    """Training medians of ``cols``, 0 for a column without a number."""
    found = {r["feature"]: r["value"] for r in exact_quantiles(df, list(cols), [0.5]).collect()}
    return {c: found.get(c, 0.0) for c in cols}


def filled(c: str, fill: dict):
    """The column as a double, nulls and NaN replaced by its fill value."""
    return F.coalesce(clean_double(col(c)), F.lit(float(fill[c])))


def assemble(df: DataFrame, cols, out: str = "features", fill: dict | None = None) -> DataFrame:
    """Vector column of ``cols``; with ``fill`` nulls and NaN are replaced first and no row is lost."""
    from pyspark.ml.feature import VectorAssembler
    if fill is None:
        return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)
    tmp = [f"_fill_{i}" for i in range(len(cols))]
    src = df.select("*", *[filled(c, fill).alias(t) for c, t in zip(cols, tmp)])
    return VectorAssembler(inputCols=tmp, outputCol=out, handleInvalid="error").transform(src).drop(*tmp)


@dataclass
class FittedClusters:
    cols: list
    fill: dict
    model: object

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(assemble(df, self.cols, "_km_raw", self.fill))
        return out.drop(*[c for c in ("_km_raw", "_km_vec") if c in out.columns])


class ClusterLabel:
    """k-means cluster id (Spark ML k-means||, seeded), optionally on z-scaled columns. Fitted on
    complete rows; every row is scored, its nulls replaced by training medians."""

    def __init__(self, cols, k: int, scale: bool = False, seed: int = 42, max_iter: int = 20):
        self.cols, self.k, self.scale, self.seed, self.max_iter = list(cols), k, scale, seed, max_iter

    def fit(self, df: DataFrame) -> FittedClusters:
        from pyspark.ml import Pipeline
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.feature import StandardScaler
        fill = fit_fill(df, self.cols)
        stages, vec = [], "_km_raw"
        if self.scale:
            stages.append(StandardScaler(inputCol="_km_raw", outputCol="_km_vec", withMean=True, withStd=True))
            vec = "_km_vec"
        stages.append(KMeans(k=self.k, seed=self.seed, maxIter=self.max_iter, featuresCol=vec,
                             predictionCol=f"kmeans_{self.k}"))
        train = assemble(complete_rows(df, self.cols), self.cols, "_km_raw", fill)
        return FittedClusters(self.cols, fill, Pipeline(stages=stages).fit(train))

    @staticmethod
    def transform(model: FittedClusters, df: DataFrame) -> DataFrame:
        return model.transform(df)


def centroid_distances(df: DataFrame, centers, cols, prefix: str = "dist_c", fill: dict | None = None) -> DataFrame:
    """Euclidean distance to every centroid (a handful of literals) and the nearest id. Nulls
    take their ``fill`` value; without one the distances and the cluster of such a row are null."""
    dists = []
    for j, ctr in enumerate(centers):
        sq = None
        for c, v in zip(cols, ctr):
            x = (filled(c, fill) if fill else clean_double(col(c))) - F.lit(float(v))
            sq = x * x if sq is None else sq + x * x
        dists.append(F.sqrt(sq).alias(f"{prefix}{j}"))
    out = df.select("*", *dists)
    arr = F.array(*[F.struct(F.col(f"{prefix}{j}").alias("d"), F.lit(j).alias("j")) for j in range(len(centers))])
    return out.withColumn("cluster", F.when(F.col(f"{prefix}0").isNotNull(), F.array_min(arr)["j"]))


class ClusterDistances:
    """k-means fit on complete rows, then label and distance to every centre of every row."""

    def __init__(self, cols, k: int, seed: int = 42):
        self.cols, self.k, self.seed, self.fill = list(cols), k, seed, None

    def fit(self, df: DataFrame) -> list:
        from pyspark.ml.clustering import KMeans
        self.fill = fit_fill(df, self.cols)
        m = KMeans(k=self.k, seed=self.seed, featuresCol="_cd_vec").fit(
            assemble(complete_rows(df, self.cols), self.cols, "_cd_vec", self.fill))
        return [list(map(float, c)) for c in m.clusterCenters()]

    def transform(self, df: DataFrame, centers) -> DataFrame:
        return centroid_distances(df, centers, self.cols, fill=self.fill)


class CenteredPCA:
    """PCA scores of mean-centred columns (Spark's PCA does not centre its output). Fitted on complete
    rows; a null is scored as the mean."""

    def __init__(self, cols, n: int):
        self.cols, self.n = list(cols), n

    def fit(self, df: DataFrame):
        from pyspark.ml.feature import PCA
        train = complete_rows(df, self.cols)
        means = train.agg(*[F.avg(col(c)).alias(c) for c in self.cols]).first()
        centred = train.select(*[(col(c) - F.lit(means[c])).alias(c) for c in self.cols])
        model = PCA(k=self.n, inputCol="_pca_in", outputCol="_pca_out").fit(assemble(centred, self.cols, "_pca_in"))
        return {"means": [means[c] for c in self.cols], "pc": model.pc.toArray().tolist()}

    def transform(self, df: DataFrame, fitted, prefix: str = "pca_") -> DataFrame:
        return project_linear(df, self.cols, fitted["means"], np.array(fitted["pc"]).T, prefix)


def project_linear(df: DataFrame, cols, means, weights, prefix: str) -> DataFrame:
    """Linear scores of centred columns, one for each row of ``weights``; a null counts as the mean."""
    centred = [F.coalesce(clean_double(col(c)) - F.lit(float(m)), F.lit(0.0)) for c, m in zip(cols, means)]
    outs = []
    for r, w in enumerate(weights):
        s = None
        for x, v in zip(centred, w):
            s = x * F.lit(float(v)) if s is None else s + x * F.lit(float(v))
        outs.append(s.alias(f"{prefix}{r}"))
    return df.select("*", *outs)


class IndependentComponents:
    """FastICA (logcosh, symmetric decorrelation). Whitening from the distributed covariance;
    every fixed-point step is one distributed mean over rows; the p x n matrices live on the driver.
    Fitted on complete rows, a null is scored as the mean. Lineage of the whitened frame is cut with a
    reliable checkpoint, which the steps read."""

    def __init__(self, cols, n: int, max_iter: int = 200, tol: float = 1e-4, seed: int = 42):
        self.cols, self.n, self.max_iter, self.tol, self.seed = list(cols), n, max_iter, tol, seed

    def fit(self, df: DataFrame):
        from ..session import cut_lineage
        p = len(self.cols)
        df = complete_rows(df, self.cols)
        means = df.agg(*[F.avg(col(c)).alias(c) for c in self.cols]).first()
        mu = np.array([means[c] for c in self.cols], dtype=float)
        cov_aggs = [F.covar_pop(col(a), col(b)).alias(f"c{i}_{j}") for i, a in enumerate(self.cols)
                    for j, b in enumerate(self.cols) if j >= i]
        crow = df.agg(*cov_aggs).first()
        cov = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                cov[i, j] = cov[j, i] = crow[f"c{i}_{j}"]
        d, e = np.linalg.eigh(cov)
        order = np.argsort(d)[::-1][:self.n]
        d, e = d[order], e[:, order]
        K = (e / np.sqrt(d)).T  # n x p whitening
        white = df.select(*[sum(((col(c).cast("double") - F.lit(mu[i])) * F.lit(float(K[r, i])))
                                for i, c in enumerate(self.cols)).alias(f"z{r}") for r in range(self.n)])
        white = cut_lineage(white)
        rng = np.random.RandomState(self.seed)
        W = self._sym(rng.normal(size=(self.n, self.n)))
        for _ in range(self.max_iter):
            exprs = []
            for r in range(self.n):
                wx = sum(F.col(f"z{k}") * F.lit(float(W[r, k])) for k in range(self.n))
                g = F.tanh(wx)
                exprs += [F.avg(g * F.col(f"z{k}")).alias(f"gz{r}_{k}") for k in range(self.n)]
                exprs.append(F.avg(1 - g * g).alias(f"gp{r}"))
            row = white.agg(*exprs).first()
            W1 = np.array([[row[f"gz{r}_{k}"] - row[f"gp{r}"] * W[r, k] for k in range(self.n)]
                           for r in range(self.n)])
            W1 = self._sym(W1)
            lim = max(abs(abs(np.diag(W1 @ W.T)) - 1))
            W = W1
            if lim < self.tol:
                break
        return {"mean": mu.tolist(), "unmixing": (W @ K).tolist()}

    @staticmethod
    def _sym(W):
        s, u = np.linalg.eigh(W @ W.T)
        return (u * (1.0 / np.sqrt(s))) @ u.T @ W

    def transform(self, df: DataFrame, fitted, prefix: str = "ica_") -> DataFrame:
        return project_linear(df, self.cols, fitted["mean"], np.array(fitted["unmixing"]), prefix)
