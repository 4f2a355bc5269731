"""Trees as packed arrays: routing rows, scoring whole ensembles in one projection, shared by the growers.

All trees of an ensemble lie in the same few arrays, one entry for each node, so a model of a thousand trees is
scored by one Arrow projection and the plan does not grow with it. A row goes left where its value is at most the
node's cut; a missing value goes where the node says.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import q

LEAF = -1


@dataclass
class PackedTrees:
    """Nodes of all trees; ``roots`` has the first node of each, ``tree`` the tree of each node, and ``heap`` numbers a
    tree's nodes: 0, children 2i + 1 and 2i + 2."""

    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    missing_left: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    rows: list = field(default_factory=list)
    heap: list = field(default_factory=list)
    tree: list = field(default_factory=list)
    roots: list = field(default_factory=list)

    def add_tree(self, value: float, rows: int) -> int:
        """A new tree of one leaf; returns the leaf's place."""
        self.roots.append(self.add(value, rows, 0, len(self.roots)))
        return self.roots[-1]

    def add(self, value: float, rows: int, heap: int, tree: int) -> int:
        """A new leaf; returns its place."""
        for name, v in (("feature", LEAF), ("cut", 0.0), ("missing_left", True), ("left", LEAF), ("right", LEAF), ("value", float(value)),
                        ("gain", 0.0), ("rows", int(rows)), ("heap", heap), ("tree", tree)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: float, missing_left: bool, gain: float, left: tuple, right: tuple) -> tuple:
        """Turn a leaf into a node with two leaves, given as ``(value, rows)``; returns their places."""
        h, t = self.heap[node], self.tree[node]
        self.feature[node], self.cut[node], self.missing_left[node], self.gain[node] = feature, float(cut), bool(missing_left), float(gain)
        self.left[node], self.right[node] = self.add(*left, 2 * h + 1, t), self.add(*right, 2 * h + 2, t)
        return self.left[node], self.right[node]

    def arrays(self) -> tuple:
        return (np.array(self.feature, np.int32), np.array(self.cut, np.float64), np.array(self.missing_left, bool), np.array(self.left, np.int32),
                np.array(self.right, np.int32), np.array(self.value, np.float64), np.array(self.roots, np.int32))

    def first(self, n_trees: int) -> "PackedTrees":
        """The first trees alone, of an ensemble whose trees were grown one after the other."""
        end = self.roots[n_trees] if n_trees < len(self.roots) else len(self.feature)
        parts = {n: getattr(self, n)[:end] for n in ("feature", "cut", "missing_left", "left", "right", "value", "gain", "rows", "heap", "tree")}
        return PackedTrees(**parts, roots=self.roots[:n_trees])


def by_feature(x: np.ndarray) -> np.ndarray:
    """A matrix (rows x features) laid out feature after feature, for ``descend``."""
    return np.ascontiguousarray(x.T)


def walkable(arrays: tuple) -> tuple:
    """Nodes for ``descend``: feature, cut, both children (right, left) and where a missing value goes, leaves being their own children;
    the roots, and the steps from each to its lowest leaf."""
    feature, cut, missing_left, left, right, _, roots = arrays
    inner, own = feature >= 0, np.arange(len(feature))
    kids = np.stack([np.where(inner, right, own), np.where(inner, left, own)], axis=1).astype(np.int64)
    steps = []
    for root in roots:
        level, n = np.array([root]), 0
        while len(level := level[inner[level]]):
            level, n = kids[level].ravel(), n + 1
        steps.append(n)
    return np.maximum(feature, 0).astype(np.int64), cut, kids.ravel(), missing_left & inner, roots, steps


def descend(x: np.ndarray, walk: tuple, tree: int) -> np.ndarray:
    """Leaves that rows reach in a tree; their values lie ``by_feature``."""
    feature, cut, kids, missing_left, roots, steps = walk
    at, rows, values, place = np.full(x.shape[1], roots[tree], np.int64), np.arange(x.shape[1]), x.ravel(), feature * x.shape[1]
    gaps = missing_left.any()
    for _ in range(steps[tree]):
        v = values.take(place.take(at) + rows)
        go_left = v <= cut.take(at)
        if gaps:
            go_left |= np.isnan(v) & missing_left.take(at)
        at = kids.take(2 * at + go_left)
    return at


def sum_of_trees(x: np.ndarray, walk: tuple, value: np.ndarray, at_once: int = 1 << 20) -> np.ndarray:
    """Sum of the values of all trees for each row."""
    values, n_trees, out = by_feature(x), len(walk[4]), np.zeros(len(x))
    step = max(1, at_once // max(1, len(x)))
    for k in range(0, n_trees, step):
        out += np.stack([value.take(descend(values, walk, t)) for t in range(k, min(k + step, n_trees))], axis=1).sum(axis=1)
    return out


def feature_matrix(feature_cols=None, features_col: str = "features") -> Column:
    """One array of doubles for each row, gaps as NaN: of plain columns, or of a vector column."""
    if feature_cols is None:
        from pyspark.ml.functions import vector_to_array
        return vector_to_array(F.col(features_col))
    return F.array(*[F.coalesce(F.col(q(c)).cast("double"), F.lit(float("nan"))) for c in feature_cols])


def as_matrix(values, n_features: int) -> np.ndarray:
    """An Arrow list column as a matrix."""
    values = values.combine_chunks() if hasattr(values, "combine_chunks") else values
    return np.asarray(values.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, n_features)


def score_column(matrix: Column, trees: PackedTrees) -> Column:
    """Sum of all trees' values as one Arrow projection."""
    arrays = trees.arrays()
    walk, value = walkable(arrays), arrays[5]

    @F.arrow_udf("double")
    def total(x: pa.Array) -> pa.Array:
        values = np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.float64)
        return pa.array(sum_of_trees(values.reshape(len(x), -1), walk, value) if len(x) else [], pa.float64())
    return total(matrix)


def from_spark(models, values) -> PackedTrees | None:
    """Fitted decision trees of Spark ML as packed arrays; the value of a tree's leaf is ``values(tree number, predicted class)``.
    None where a tree splits on a set of categories, which has no cut."""
    out = PackedTrees()
    for t, model in enumerate(models):
        todo = [(model._java_obj.rootNode(), out.add_tree(values(t, model._java_obj.rootNode().prediction()), 0))]
        while todo:
            node, at = todo.pop()
            if node.subtreeDepth() == 0:
                continue
            split = node.split()
            if not split.getClass().getSimpleName().startswith("Continuous"):
                return None
            kids = node.leftChild(), node.rightChild()
            # a missing value is not at most any cut
            places = out.split(at, split.featureIndex(), split.threshold(), False, node.gain(), *((values(t, k.prediction()), 0) for k in kids))
            todo += zip(kids, places)
    return out


def tree_table(spark, trees: PackedTrees, names) -> DataFrame:
    """``(tree, node, feature, cut, missing_left, gain, value, rows)``: every node, numbered in its tree as a heap."""
    rows = [(trees.tree[k], trees.heap[k], None if trees.feature[k] == LEAF else names[trees.feature[k]], None if trees.feature[k] == LEAF else trees.cut[k],
             None if trees.feature[k] == LEAF else int(trees.missing_left[k]), trees.gain[k], trees.value[k], trees.rows[k])
            for k in range(len(trees.feature))]
    return spark.createDataFrame(rows, "tree int, node long, feature string, cut double, missing_left int, gain double, value double, rows long")


def importance(trees: PackedTrees, names) -> list:
    """``(feature, share of the total gain)``, largest first, features without gain included."""
    total = dict.fromkeys(names, 0.0)
    for f, g in zip(trees.feature, trees.gain):
        if f != LEAF:
            total[names[f]] += g * 1.0
    whole = sum(total.values()) or 1.0
    return sorted(((n, v / whole) for n, v in total.items()), key=lambda x: (-x[1], x[0]))


def hash_unit(*parts) -> float:
    """A number from 0 to 1 by ``md5(part:part:...)``: its first 52 bits (the same in SQL)."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2.0**52
