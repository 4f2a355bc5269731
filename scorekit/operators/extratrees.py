"""M3: extra-randomised trees, grown level by level.

A node looks at a few features (the square root of their number), each with one random cut between the least and the largest value that the
node's rows have of it. All trees grow together, and a level takes two aggregates whatever the number of trees: the ranges of
each node's features, then the class counts on both sides of each cut. Choices come from ``md5(seed:tree:node:feature)``, so any
partitioning gives the same trees. The cut with the largest fall in Gini impurity wins, the first feature on ties.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, guard_union_partitioning
from .trees import PackedTrees, as_matrix, by_feature, descend, feature_matrix, hash_unit, importance, score_column, tree_table, walkable


class ExtraTrees:
    """M3 estimator: ``transform`` of the model adds the mean share of class 1 as ``prediction``.

    Reads the vector column ``features``, or plain columns ``feature_cols``. Every tree sees all rows (no bagging). Missing values take no part in a
    node's ranges and go right. ``per_node`` features are tried at a node; null: the square root of their number. A node is
    split if it has ``min_split`` rows or more and both sides keep ``min_leaf``."""

    def __init__(self, n_trees: int = 100, depth: int = 10, min_split: int = 2, min_leaf: int = 1, per_node: int | None = None, feature_cols=None,
                 label_col: str = "label", seed: int = 42):
        self.n_trees, self.depth, self.min_split, self.min_leaf, self.per_node = n_trees, depth, min_split, min_leaf, per_node
        self.feature_cols, self.label_col, self.seed = feature_cols, label_col, seed

    def _candidates(self, tree: int, heap: int, n: int) -> list:
        k = min(n, self.per_node or max(1, math.isqrt(n)))
        return sorted(sorted(range(n), key=lambda f: (hash_unit(self.seed, tree, heap, "pick", f), f))[:k])

    def fit(self, df: DataFrame) -> "ExtraTreesModel":
        guard_union_partitioning(df.sparkSession)
        x = feature_matrix(self.feature_cols)
        rows = cut_lineage(df.select(x.alias("x"), F.col(self.label_col).cast("int").alias("y")).where("y is not null")).persist()
        n = len(self.feature_cols) if self.feature_cols is not None else (rows.select(F.size("x")).first() or [0])[0]
        names = list(self.feature_cols) if self.feature_cols is not None else [f"f{k}" for k in range(n)]
        whole = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("ones")).first()
        trees, open_nodes = PackedTrees(), []
        for t in range(self.n_trees):
            open_nodes.append((t, trees.add_tree(whole["ones"] / whole["n"] if whole["n"] else 0.5, whole["n"])))
        for _ in range(self.depth if n and whole["n"] else 0):
            open_nodes = [(t, k) for t, k in open_nodes if trees.rows[k] >= self.min_split and 0 < trees.value[k] < 1]
            if not open_nodes:
                break
            tried = [(t, k, f) for t, k in open_nodes for f in self._candidates(t, trees.heap[k], n)]
            ranges = {(r["node"], r["f"]): (r["lo"], r["hi"]) for r in self._ranges(rows, trees, tried, n).collect()}  # a row for each node and tried feature
            cuts = []
            for t, k, f in tried:
                lo, hi = ranges.get((k, f), (0.0, 0.0))
                if hi > lo:
                    cut = lo + hash_unit(self.seed, t, trees.heap[k], f) * (hi - lo)
                    cuts.append((t, k, f, min(cut, math.nextafter(hi, lo))))
            if not cuts:
                break
            best = self._best(rows, trees, cuts, n).collect()  # a row for each node
            tree_of, cut_of, grown = dict((k, t) for t, k in open_nodes), {(k, f): c for _, k, f, c in cuts}, []
            for r in sorted(best, key=lambda r: r["node"]):
                k, rest, ones = r["node"], r["n_t"] - r["n_l"], r["ones_t"] - r["ones_l"]
                kids = trees.split(k, r["f"], cut_of[k, r["f"]], False, r["gain"], (r["ones_l"] / r["n_l"], r["n_l"]), (ones / rest, rest))
                grown += [(tree_of[k], kid) for kid in kids]
            open_nodes = grown
        rows.unpersist()
        return ExtraTreesModel(trees, names, self.feature_cols)

    def _slots(self, trees: PackedTrees, tried: list) -> tuple:
        """Kernel pieces: the trees to descend, and for each with open nodes its number, its nodes' numbers among the open ones (their
        count: closed), and for each of a node's features its place in ``tried`` (-1: the node has fewer) and the feature."""
        per_tree: dict = {}
        for at, (t, k, f, *_) in enumerate(tried):
            per_tree.setdefault(t, {}).setdefault(k, []).append((at, f))
        out = []
        for t, nodes in per_tree.items():
            wide = max(map(len, nodes.values()))
            # 8 and 16 bits are sorted by counting
            number = np.full(len(trees.feature), len(nodes), np.min_scalar_type(len(nodes)))
            number[list(nodes)] = np.arange(len(nodes))
            pairs = np.array([p + [(-1, 0)] * (wide - len(p)) for p in nodes.values()], np.int64)
            out.append((t, number, pairs[:, :, 0].T.copy(), pairs[:, :, 1].T.copy()))
        return walkable(trees.arrays()), out

    def _ranges(self, rows: DataFrame, trees: PackedTrees, tried: list, n: int) -> DataFrame:
        walk, slots = self._slots(trees, tried)
        keys = np.array([(k, f) for _, k, f in tried], np.int32)

        def kernel(batches):
            lo, hi = np.full(len(keys), np.nan), np.full(len(keys), np.nan)
            for b in batches:
                x = by_feature(as_matrix(b.column(0), n))
                for t, number, places, features in slots:
                    rows_of, nodes, starts, sizes = rows_by_node(number.take(descend(x, walk, t)), len(places[0]))
                    for place, f in zip(places, features) if len(nodes) else ():
                        at = place[nodes]
                        v = x.take(rows_of + np.repeat(f[nodes] * x.shape[1], sizes))
                        ok = at >= 0
                        for best, least in ((lo, np.fmin), (hi, np.fmax)):  # a missing value is neither
                            best[at[ok]] = least(best[at[ok]], least.reduceat(v, starts)[ok])
            ok = ~np.isnan(lo)
            yield pa.RecordBatch.from_arrays([pa.array(keys[ok, 0]), pa.array(keys[ok, 1]), pa.array(lo[ok]), pa.array(hi[ok])], names=["node", "f", "lo", "hi"])

        return rows.mapInArrow(kernel, "node int, f int, lo double, hi double").groupBy("node", "f").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def _best(self, rows: DataFrame, trees: PackedTrees, cuts: list, n: int) -> DataFrame:
        walk, slots = self._slots(trees, cuts)
        keys = np.array([(k, f) for _, k, f, _ in cuts], np.int32)
        cut = np.array([c for *_, c in cuts])

        def kernel(batches):
            total = np.zeros((4, len(keys)), np.int64)  # rows and ones, left and in all
            for b in batches:
                x, y = by_feature(as_matrix(b.column(0), n)), b.column(1).to_numpy().astype(np.int64)
                for t, number, places, features in slots:
                    rows_of, nodes, starts, sizes = rows_by_node(number.take(descend(x, walk, t)), len(places[0]))
                    if not len(nodes):
                        continue
                    own = y.take(rows_of)
                    ones = np.add.reduceat(own, starts)
                    for place, f in zip(places, features):
                        at = place[nodes]
                        left = x.take(rows_of + np.repeat(f[nodes] * x.shape[1], sizes)) <= np.repeat(cut[at], sizes)  # a missing value is not
                        ok = at >= 0
                        sums = np.add.reduceat(left, starts, dtype=np.int64), np.add.reduceat(own * left, starts), sizes, ones
                        for of_all, v in zip(total, sums):
                            of_all[at[ok]] += v[ok]
            ok = total[2] > 0
            yield pa.RecordBatch.from_arrays([pa.array(keys[ok, 0]), pa.array(keys[ok, 1]), *(pa.array(v[ok]) for v in total)],
                                             names=["node", "f", "n_l", "ones_l", "n_t", "ones_t"])

        names = ("n_l", "ones_l", "n_t", "ones_t")
        sums = rows.mapInArrow(kernel, "node int, f int, n_l bigint, ones_l bigint, n_t bigint, ones_t bigint").groupBy("node", "f").agg(
            *[F.sum(c).alias(c) for c in names])
        gini = lambda k, m: 2 * (k / m) * (1 - k / m)
        rest, ones = F.col("n_t") - F.col("n_l"), F.col("ones_t") - F.col("ones_l")
        gain = gini(F.col("ones_t"), F.col("n_t")) - (F.col("n_l") * gini(F.col("ones_l"), F.col("n_l")) + rest * gini(ones, rest)) / F.col("n_t")
        ok = sums.where((F.col("n_l") >= max(1, self.min_leaf)) & (rest >= max(1, self.min_leaf))).withColumn("gain", F.round(gain, 9))
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.col("gain").desc(), "f"))
        return ok.withColumn("place", place).where("place = 1")


def rows_by_node(number: np.ndarray, n_nodes: int) -> tuple:
    """Rows of the nodes 0 to ``n_nodes`` - 1, node after node; the nodes that have any; the start of each among the rows, and its size."""
    sizes = np.bincount(number, minlength=n_nodes)[:n_nodes]
    nodes = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[nodes])
    return np.argsort(number, kind="stable")[:ends[-1] if len(nodes) else 0], nodes, ends - sizes[nodes], sizes[nodes]


class ExtraTreesModel:
    def __init__(self, trees: PackedTrees, names: list, feature_cols):
        self.trees, self.names, self.feature_cols = trees, names, feature_cols

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", score_column(feature_matrix(self.feature_cols), self.trees) / len(self.trees.roots))

    def table(self, spark) -> DataFrame:
        return tree_table(spark, self.trees, self.names)

    def importance(self) -> list:
        return importance(self.trees, self.names)


def randomised(**params):
    """M3 factory for cross-fitting: ``make()`` gives an unfitted ``ExtraTrees``."""
    return lambda: ExtraTrees(**params)
