"""M1: gradient boosting of second order, with L1 and L2 leaf penalties and early stopping.

Every feature is cut into bins once. A tree grows level by level: each task adds up gradients and hessians of its
rows by (node, feature, bin), one aggregate sums the tasks' cells, windows over the cells turn them into left and right
sums of every cut, and the best cut of each node (a row a node) comes back to the driver. Rows hold their bins as
bytes and their margin; the tree so far is small and travels with the kernel, so no row is shuffled or
rewritten while a tree grows.

    leaf = -S(G) / (H + l2),   S(G) = sign(G) max(|G| - l1, 0)
    gain = (S(GL)^2 / (HL + l2) + S(GR)^2 / (HR + l2) - S(G)^2 / (H + l2)) / 2

Missing values have a bin of their own and go to the side that gains more, left on ties. Equal gains (to nine
places) go to the first feature, then the lowest cut.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, guard_union_partitioning
from .trees import LEAF, PackedTrees, as_matrix, feature_matrix, importance, score_column, tree_table

STATE = "bins binary, y double, w double, valid boolean, h bigint, m double"


def in_sample(h: np.ndarray, round_no: int, share: float) -> np.ndarray:
    """Rows of a round's sample, by the hash of the row and the number of the round."""
    if share >= 1:
        return np.ones(len(h), bool)
    z = h.view(np.uint64) ^ np.uint64((round_no + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53 < share


def to_bins(x: np.ndarray, cuts: list, kind) -> np.ndarray:
    """Bins of a matrix: 0 for a missing value, else 1 + the number of cuts below the value."""
    out = np.empty(x.shape, kind)
    for j, c in enumerate(cuts):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(c, x[:, j], "left") + 1)
    return out


class GradientBoosting:
    """M1 estimator: ``fit(df)`` gives a model whose ``transform`` adds the probability of class 1 as ``prediction``.

    Reads the vector column ``features``, or plain columns ``feature_cols``, whose nulls and NaN are missing values. Bins come from
    approximate quantiles (``max_bins`` at most), or from ``cuts``, a sorted list for each feature. ``row_share`` and ``column_share``
    sample rows (by hash of ``id_col``, else of the features) and columns for each tree. Rows where ``validation_col`` is
    true are not learned from; with ``patience`` rounds stop when their log loss has not fallen for so many, and the model keeps
    the rounds up to the best. A training part of one class, or without rows, gives a constant."""

    def __init__(self, rounds: int = 100, depth: int = 6, rate: float = 0.1, l1: float = 0.0, l2: float = 1.0, min_gain: float = 0.0,
                 min_hessian: float = 1.0, row_share: float = 1.0, column_share: float = 1.0, max_bins: int = 64, cuts=None, feature_cols=None,
                 label_col: str = "label", weight_col: str | None = None, validation_col: str | None = None, patience: int | None = None,
                 id_col: str | None = None, seed: int = 42, checkpoint_every: int = 10):
        self.rounds, self.depth, self.rate, self.l1, self.l2 = rounds, depth, rate, l1, l2
        self.min_gain, self.min_hessian, self.row_share, self.column_share = min_gain, min_hessian, row_share, column_share
        self.max_bins, self.cuts, self.feature_cols, self.label_col, self.weight_col = max_bins, cuts, feature_cols, label_col, weight_col
        self.validation_col, self.patience, self.id_col, self.seed, self.checkpoint_every = validation_col, patience, id_col, seed, checkpoint_every

    # --- rows -----------------------------------------------------------------------------------

    def _rows(self, df: DataFrame) -> tuple:
        """``(x, y, w, valid, h)`` of every row with a label, and the names of the features."""
        x = feature_matrix(self.feature_cols)
        w = F.col(self.weight_col).cast("double") if self.weight_col else F.lit(1.0)
        valid = F.coalesce(F.col(self.validation_col).cast("boolean"), F.lit(False)) if self.validation_col else F.lit(False)
        rows = df.select(x.alias("x"), F.col(self.label_col).cast("double").alias("y"), w.alias("w"), valid.alias("valid"),
                         F.xxhash64(F.lit(self.seed), F.col(self.id_col) if self.id_col else x).alias("h")).where("y is not null and w > 0")
        if self.feature_cols is not None:
            return rows, list(self.feature_cols)
        n = (df.select(F.size(x).alias("n")).first() or [0])[0]
        attrs = (df.schema["features"].metadata or {}).get("ml_attr", {}).get("attrs", {})
        named = {a["idx"]: a.get("name", f"f{a['idx']}") for part in attrs.values() for a in part}
        return rows, [named.get(k, f"f{k}") for k in range(n)]

    def _fit_cuts(self, rows: DataFrame, n: int) -> list:
        """Approximate quantiles of each feature over the training rows: at most ``max_bins`` - 1 cuts."""
        if self.cuts is not None:
            return [np.array(sorted(set(map(float, c)))) for c in self.cuts]
        value = lambda k: F.when(~F.isnan(F.col("x")[k]), F.col("x")[k])
        probs = [k / self.max_bins for k in range(1, self.max_bins)]
        got = rows.where("not valid").select(*[value(k).alias(f"x{k}") for k in range(n)]).approxQuantile([f"x{k}" for k in range(n)], probs, 0.25 / self.max_bins)
        return [np.array(sorted(set(c))) for c in got]

    # --- one tree ---------------------------------------------------------------------------------

    def _cells(self, state: DataFrame, trees: tuple, root: int, open_nodes: list, columns: list, n_bins: int, kind, n_features: int, round_no: int) -> DataFrame:
        """``(node, f, b, g, h, n)``: sums of gradients and hessians of the open nodes' rows, by feature and bin."""
        share = self.row_share
        slot = np.full(len(trees[0]), -1, np.int64)
        slot[open_nodes] = np.arange(len(open_nodes))

        def kernel(batches):
            total = np.zeros((3, len(open_nodes), len(columns), n_bins))
            for b in batches:
                bins = np.frombuffer(b"".join(b.column(0).to_pylist()), kind).reshape(-1, n_features)
                y, w, m = (b.column(k).to_numpy() for k in (1, 2, 5))
                use = ~b.column(3).to_numpy(zero_copy_only=False) & in_sample(b.column(4).to_numpy(), round_no, share)
                at = slot[route_bins(bins, trees, root)]
                use &= at >= 0
                p = 1 / (1 + np.exp(-m[use]))
                parts = ((p - y[use]) * w[use], p * (1 - p) * w[use], None)
                for j, f in enumerate(columns):
                    key = at[use] * n_bins + bins[use, f]
                    for k, v in enumerate(parts):
                        total[k, :, j] += np.bincount(key, v, len(open_nodes) * n_bins).reshape(-1, n_bins)
            s, j, bin_no = np.nonzero(total[2])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(open_nodes, np.int32)[s]), pa.array(np.array(columns, np.int32)[j]), pa.array(bin_no.astype(np.int32)),
                 pa.array(total[0][s, j, bin_no]), pa.array(total[1][s, j, bin_no]), pa.array(total[2][s, j, bin_no].astype(np.int64))],
                names=["node", "f", "b", "g", "h", "n"])

        cells = state.mapInArrow(kernel, "node int, f int, b int, g double, h double, n bigint")
        return cells.groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))

    def _best_cuts(self, cells: DataFrame, n_cuts: list) -> list:
        """The best cut of each node (one row a node), with the sums of both sides; ``gain`` null where none is allowed."""
        whole = Window.partitionBy("node", "f")
        run = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        sums = cells.select("node", "f", "b", *[F.sum(c).over(run).alias(f"{c}_l") for c in "ghn"], *[F.sum(c).over(whole).alias(f"{c}_t") for c in "ghn"],
                            *[F.coalesce(F.sum(F.when(F.col("b") == 0, F.col(c))).over(whole), F.lit(0)).alias(f"{c}_m") for c in "ghn"])
        both = sums.select("*", F.explode(F.array(F.lit(1), F.lit(0))).alias("missing_left"))
        for c in "ghn":  # the missing bin comes first, so every running sum holds it
            both = both.withColumn(f"{c}_l", F.col(f"{c}_l") - F.when(F.col("missing_left") == 0, F.col(f"{c}_m")).otherwise(0))
        soft = lambda g: F.signum(g) * F.greatest(F.abs(g) - F.lit(float(self.l1)), F.lit(0.0))
        part = lambda g, h: soft(g) * soft(g) / (h + F.lit(float(self.l2)))
        left, right = (F.col("g_l"), F.col("h_l")), (F.col("g_t") - F.col("g_l"), F.col("h_t") - F.col("h_l"))
        gain = 0.5 * (part(*left) + part(*right) - part(F.col("g_t"), F.col("h_t")))
        cuts = F.array(*[F.lit(n) for n in n_cuts])
        allowed = ((F.col("b") >= 1) & (F.col("b") <= cuts[F.col("f")]) & (left[1] >= self.min_hessian) & (right[1] >= self.min_hessian)
                   & (F.col("n_l") > 0) & (F.col("n_t") > F.col("n_l")))
        scored = both.withColumn("gain", F.when(allowed, F.round(gain, 9)))
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.col("gain").desc_nulls_last(), "f", "b", F.col("missing_left").desc()))
        return scored.withColumn("place", place).where(F.col("place") == 1).collect()

    def _leaf(self, g: float, h: float) -> float:
        s = math.copysign(max(abs(g) - self.l1, 0.0), g)
        return -self.rate * s / (h + self.l2) if h + self.l2 > 0 else 0.0

    def _grow(self, state: DataFrame, trees: PackedTrees, cuts: list, kind, n_bins: int, round_no: int) -> None:
        """Add one tree."""
        n = len(cuts)
        columns = list(range(n))
        if self.column_share < 1:
            rng = np.random.default_rng([self.seed, round_no])
            columns = sorted(rng.choice(n, max(1, math.ceil(self.column_share * n)), replace=False).tolist())
        root = trees.add_tree(0.0, 0)
        open_nodes = [root]
        for level in range(self.depth):
            arrays = _bin_arrays(trees, cuts, root)
            cells = self._cells(state, arrays, 0, [k - root for k in open_nodes], columns, n_bins, kind, n, round_no)
            best = {r["node"] + root: r for r in self._best_cuts(cells, [len(c) for c in cuts])}
            if level == 0 and root in best:
                trees.value[root], trees.rows[root] = self._leaf(best[root]["g_t"], best[root]["h_t"]), best[root]["n_t"]
            split = []
            for k in open_nodes:
                r = best.get(k)
                if r is None or r["gain"] is None or r["gain"] <= max(self.min_gain, 0.0):
                    continue
                gr, hr, nr = (r[f"{c}_t"] - r[f"{c}_l"] for c in "ghn")
                split += trees.split(k, r["f"], cuts[r["f"]][r["b"] - 1], r["missing_left"] == 1, r["gain"], (self._leaf(r["g_l"], r["h_l"]), r["n_l"]),
                                     (self._leaf(gr, hr), nr))
            open_nodes = split
            if not open_nodes:
                return

    # --- all rounds -------------------------------------------------------------------------------

    def fit(self, df: DataFrame) -> "BoostedModel":
        guard_union_partitioning(df.sparkSession)
        rows, names = self._rows(df)
        n = len(names)
        cuts = self._fit_cuts(rows, n)
        n_bins = max([0, *map(len, cuts)]) + 2
        kind = np.uint8 if n_bins <= 256 else np.uint16 if n_bins <= 65536 else np.uint32
        total = rows.where("not valid").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy")).first()
        share = total["wy"] / total["w"] if total["w"] else 0.5
        base = math.log(min(max(share, 1e-12), 1 - 1e-12) / (1 - min(max(share, 1e-12), 1 - 1e-12)))
        trees = PackedTrees()
        if not n or not total["w"] or share in (0.0, 1.0):
            return BoostedModel(trees, base, names, self.feature_cols, [])

        def binned(batches):
            for b in batches:
                x = to_bins(as_matrix(b.column(0), n), cuts, kind)
                blobs = [r.tobytes() for r in x]
                yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), b.column(1), b.column(2), b.column(3), b.column(4), pa.array(np.full(len(x), base))],
                                                 names=["bins", "y", "w", "valid", "h", "m"])

        state = cut_lineage(rows.mapInArrow(binned, STATE)).persist()
        losses, best = [], 0
        for r in range(self.rounds):
            self._grow(state, trees, cuts, kind, n_bins, r)
            nxt = state.mapInArrow(_advance(_bin_arrays(trees, cuts, trees.roots[-1]), kind, n), STATE)
            nxt = (cut_lineage(nxt) if (r + 1) % self.checkpoint_every == 0 else nxt).persist()
            p = F.col("w") * (F.log1p(F.exp(-F.abs("m"))) + F.greatest(F.col("m"), F.lit(0.0)) - F.col("m") * F.col("y"))
            got = nxt.agg((F.sum(F.when(F.col("valid"), p)) / F.sum(F.when(F.col("valid"), F.col("w")))).alias("held"),
                          (F.sum(F.when(~F.col("valid"), p)) / F.sum(F.when(~F.col("valid"), F.col("w")))).alias("own")).first()
            state.unpersist()
            state = nxt
            losses.append((got["own"], got["held"]))
            if got["held"] is not None and got["held"] < losses[best][1]:
                best = r
            if self.patience and got["held"] is not None and r - best >= self.patience:
                break
        state.unpersist()
        kept = best + 1 if self.patience and losses and losses[0][1] is not None else len(losses)
        return BoostedModel(trees.first(kept), base, names, self.feature_cols, losses)


def route_bins(bins: np.ndarray, arrays: tuple, root: int) -> np.ndarray:
    """Nodes that rows reach by their bins; the cut of a node is the last bin that goes left."""
    feature, last, missing_left, left, right = arrays[:5]
    at = np.full(len(bins), root, np.int64)
    rows = np.arange(len(bins))
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        b = bins[rows, np.maximum(f, 0)]
        go_left = np.where(b == 0, missing_left[at], b <= last[at])
        at = np.where(inner, np.where(go_left, left[at], right[at]), at)


def _bin_arrays(trees: PackedTrees, cuts: list, root: int) -> tuple:
    """The arrays of the tree that begins at ``root`` (the last one), with bins in place of cuts and places from 0."""
    feature = np.array(trees.feature[root:], np.int32)
    last = np.array([0 if f == LEAF else int(np.searchsorted(cuts[f], c)) + 1 for f, c in zip(trees.feature[root:], trees.cut[root:])], np.int64)
    shift = lambda a: np.array([LEAF if k == LEAF else k - root for k in a[root:]], np.int64)
    return feature, last, np.array(trees.missing_left[root:], bool), shift(trees.left), shift(trees.right), np.array(trees.value[root:])


def _advance(arrays: tuple, kind, n_features: int):
    def kernel(batches):
        for b in batches:
            bins = np.frombuffer(b"".join(b.column(0).to_pylist()), kind).reshape(-1, n_features)
            m = b.column(5).to_numpy() + arrays[5][route_bins(bins, arrays, 0)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(5)), pa.array(m)], names=b.schema.names)
    return kernel


class BoostedModel:
    """Trees over raw values; ``losses`` holds (training, validation) log loss of every round that ran."""

    def __init__(self, trees: PackedTrees, base: float, names: list, feature_cols, losses: list):
        self.trees, self.base, self.names, self.feature_cols, self.losses = trees, base, names, feature_cols, losses

    def transform(self, df: DataFrame) -> DataFrame:
        margin = F.lit(self.base)
        if self.trees.roots:
            margin = margin + score_column(feature_matrix(self.feature_cols), self.trees)
        return df.withColumn("prediction", 1 / (1 + F.exp(-margin)))

    def table(self, spark) -> DataFrame:
        return tree_table(spark, self.trees, self.names)

    def importance(self) -> list:
        return importance(self.trees, self.names)


def second_order(**params):
    """M1 factory for cross-fitting: ``make()`` gives an unfitted ``GradientBoosting``."""
    return lambda: GradientBoosting(**params)
