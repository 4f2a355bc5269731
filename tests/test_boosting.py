"""Second-order boosting and extra-randomised trees against plain numpy growers; packed scoring."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.operators import extratrees as et
from scorekit.operators import trees as tr
from scorekit.operators.boosting import GradientBoosting
from scorekit.operators.crossfit import cross_fit, positive_prob


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    n = 600
    x = rng.normal(size=(n, 4)).round(1)
    x[:, 2] = rng.integers(0, 3, n)
    y = ((x[:, 0] + (x[:, 2] == 1) * 2 - 0.5 * x[:, 1] + rng.normal(size=n) * .5) > 0.3).astype(int)
    x[rng.random(n) < .15, 0] = np.nan
    w = rng.choice([1.0, 2.0], n)
    return x, y, w


COLS = ["a", "b", "c", "d"]
CUTS = [[-1.0, -.3, 0.0, .5, 1.0], [-.5, 0.0, .7], [0.0, 1.0], [-2.0, 0.0, 2.0]]


def frame(spark, rows):
    x, y, w = rows
    data = [(i, *[None if math.isnan(v) else float(v) for v in r], int(t), float(u), i % 4 == 0) for i, (r, t, u) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, label int, w double, held boolean")


def boost_by_hand(x, y, w, cuts, rounds, depth, rate, l1, l2, min_gain, min_hessian):
    share = (w * y).sum() / w.sum()
    m = np.full(len(y), math.log(share / (1 - share)))
    out = []
    soft = lambda g: math.copysign(max(abs(g) - l1, 0), g)
    part = lambda g, h: soft(g) ** 2 / (h + l2)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-m))
        g, h = (p - y) * w, p * (1 - p) * w
        node = np.zeros(len(y), int)
        for level in range(depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                own = node == k
                best = None
                for f, c in enumerate(cuts):
                    for b, cut in enumerate(c):
                        for left_too in (1, 0):
                            go = np.where(np.isnan(x[:, f]), left_too == 1, x[:, f] <= cut)
                            a, z = own & go, own & ~go
                            if not a.any() or not z.any() or h[a].sum() < min_hessian or h[z].sum() < min_hessian:
                                continue
                            gain = round(.5 * (part(g[a].sum(), h[a].sum()) + part(g[z].sum(), h[z].sum()) - part(g[own].sum(), h[own].sum())), 9)
                            if best is None or (-gain, f, b, -left_too) < best[0]:
                                best = (-gain, f, b, -left_too), go
                if best and -best[0][0] > min_gain:
                    (gain, f, b, left_too), go = best
                    node[own] = np.where(go[own], 2 * k + 1, 2 * k + 2)
                    out.append((r, k, COLS[f], cuts[f][b], -left_too, round(-gain, 6)))
        for k in np.unique(node):
            own = node == k
            v = -rate * soft(g[own].sum()) / (h[own].sum() + l2)
            m[own] += v
            out.append((r, int(k), round(v, 9), int(own.sum())))
    return sorted(out, key=str), 1 / (1 + np.exp(-m))


@pytest.mark.parametrize("l1,l2,min_gain,min_hessian", [(0.0, 1.0, 0.0, 1.0), (3.0, 5.0, 0.5, 4.0), (0.0, 0.0, 0.0, 0.0)])
def test_same_trees_as_by_hand(spark, rows, l1, l2, min_gain, min_hessian):
    x, y, w = rows
    df = frame(spark, rows).repartition(5)
    m = GradientBoosting(rounds=3, depth=3, rate=.3, l1=l1, l2=l2, min_gain=min_gain, min_hessian=min_hessian, cuts=CUTS, feature_cols=COLS, weight_col="w").fit(df)
    want, prob = boost_by_hand(x, y, w, CUTS, 3, 3, .3, l1, l2, min_gain, min_hessian)
    t = m.table(spark).collect()
    got = [(r.tree, r.node, r.feature, r.cut, r.missing_left, round(r.gain, 6)) if r.feature else (r.tree, r.node, round(r.value, 9), r.rows) for r in t]
    assert sorted(got, key=str) == want
    scored = {r.id: r.prediction for r in m.transform(df).collect()}
    assert [scored[i] for i in range(len(y))] == pytest.approx(prob.tolist(), abs=1e-9)


def test_penalties_change_leaves(spark, rows):
    df = frame(spark, rows)
    sizes = []
    for l1, l2 in ((0, 0.0), (0, 50.0), (20, 50.0)):
        m = GradientBoosting(rounds=1, depth=2, l1=l1, l2=l2, cuts=CUTS, feature_cols=COLS).fit(df)
        sizes.append(max(abs(r.value) for r in m.table(spark).collect() if not r.feature))
    assert sizes[0] > sizes[1] > sizes[2]


def test_early_stopping_keeps_the_best_rounds(spark, rows):
    df = frame(spark, rows).withColumn("label", F.when(F.col("held"), 1 - F.col("label")).otherwise(F.col("label")))  # held rows say the contrary
    m = GradientBoosting(rounds=12, depth=3, rate=.5, feature_cols=COLS, validation_col="held", patience=3).fit(df)
    held = [b for _, b in m.losses]
    assert len(m.losses) == held.index(min(held)) + 4 < 12 and len(m.trees.roots) == held.index(min(held)) + 1
    own = [a for a, _ in m.losses]
    assert own == sorted(own, reverse=True)


def test_samples_do_not_depend_on_partitions(spark, rows):
    df = frame(spark, rows)
    make = lambda: GradientBoosting(rounds=4, depth=3, row_share=.6, column_share=.5, cuts=CUTS, feature_cols=COLS, id_col="id", checkpoint_every=2)
    a, b = make().fit(df).table(spark).collect(), make().fit(df.repartition(7)).table(spark).collect()
    assert [(r.tree, r.node, r.feature, r.cut, r.rows) for r in a] == [(r.tree, r.node, r.feature, r.cut, r.rows) for r in b]
    assert [r.value for r in a] == pytest.approx([r.value for r in b], abs=1e-9)
    first = [r.rows for r in a if r.node == 0]
    assert all(250 < n < 470 for n in first) and len(set(first)) > 1


def test_odd_frames(spark, rows):
    df = frame(spark, rows)
    for d in (df.limit(0), df.where("label = 1"), df.withColumn("label", F.lit(None).cast("int"))):
        m = GradientBoosting(rounds=2, feature_cols=COLS).fit(d)
        assert not m.trees.roots and m.transform(df).count() == len(rows[1])
    flat = GradientBoosting(rounds=2, feature_cols=["k"]).fit(df.withColumn("k", F.lit(7)))
    assert all(r.feature is None for r in flat.table(spark).collect())
    names = df.withColumnRenamed("a", "a b.c")
    assert GradientBoosting(rounds=1, depth=2, feature_cols=["a b.c", "b"]).fit(names).transform(names).where("prediction between 0 and 1").count() == len(rows[1])


def test_vectors_and_cross_fitting(spark, rows):
    from scorekit.operators.features import assemble
    df = assemble(frame(spark, rows).withColumn("fold", (F.col("id") % 3).cast("int")), COLS, fill=dict.fromkeys(COLS, 0.0))
    oof, _ = cross_fit(df, lambda: GradientBoosting(rounds=2, depth=3, rate=.5), "id", "label")
    got = oof.collect()
    assert len(got) == len(rows[1]) and np.mean([(r.prob > .5) == r.label for r in got]) > .8
    m = GradientBoosting(rounds=2, depth=2).fit(df)
    assert len(m.importance()) == 4 and m.importance()[0][1] > .3


def test_plan_of_scoring_does_not_grow(spark, rows):
    df = frame(spark, rows)
    small, large = (GradientBoosting(rounds=r, depth=2, feature_cols=COLS).fit(df) for r in (1, 6))
    size = lambda m: len(m.transform(df)._jdf.queryExecution().executedPlan().toString())
    assert abs(size(small) - size(large)) < 60


def extra_by_hand(x, y, n_trees, depth, per_node, min_split, min_leaf, seed):
    out = []
    gini = lambda v: 2 * v.mean() * (1 - v.mean())
    for t in range(n_trees):
        node = np.zeros(len(y), int)
        for level in range(depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                own = node == k
                if own.sum() < min_split or y[own].min() == y[own].max():
                    continue
                order = sorted(range(x.shape[1]), key=lambda f: (tr.hash_unit(seed, t, k, "pick", f), f))
                best = None
                for f in sorted(order[:per_node]):
                    v = x[own, f]
                    v = v[~np.isnan(v)]
                    if not len(v) or v.min() == v.max():
                        continue
                    cut = v.min() + tr.hash_unit(seed, t, k, f) * (v.max() - v.min())
                    go = own & (x[:, f] <= cut)
                    rest = own & ~go
                    if go.sum() < min_leaf or rest.sum() < min_leaf:
                        continue
                    gain = round(gini(y[own]) - (go.sum() * gini(y[go]) + rest.sum() * gini(y[rest])) / own.sum(), 9)
                    if best is None or gain > best[0]:
                        best = gain, f, cut, go
                if best:
                    gain, f, cut, go = best
                    out.append((t, k, COLS[f], round(cut, 9), round(gain, 6)))
                    node[own] = np.where(go[own], 2 * k + 1, 2 * k + 2)
        out += [(t, int(k), round(float(y[node == k].mean()), 9), int((node == k).sum())) for k in np.unique(node)]
    return sorted(out, key=str)


def test_extra_trees_as_by_hand(spark, rows):
    x, y, _ = rows
    df = frame(spark, rows).repartition(4)
    m = et.ExtraTrees(n_trees=3, depth=4, per_node=2, min_split=10, min_leaf=3, feature_cols=COLS, seed=5).fit(df)
    t = m.table(spark).collect()
    got = [(r.tree, r.node, r.feature, round(r.cut, 9), round(r.gain, 6)) if r.feature else (r.tree, r.node, round(r.value, 9), r.rows) for r in t]
    assert sorted(got, key=str) == extra_by_hand(x, y, 3, 4, 2, 10, 3, 5)
    prob = [r.prediction for r in m.transform(df).collect()]
    assert min(prob) >= 0 and max(prob) <= 1 and len(prob) == len(y)


def test_extra_trees_learn(spark, rows):
    df = frame(spark, rows)
    m = et.ExtraTrees(n_trees=15, depth=6, feature_cols=COLS).fit(df)
    got = positive_prob(m.transform(df)).collect()
    assert np.mean([(r.prob > .5) == r.label for r in got]) > .8
    assert et.ExtraTrees(n_trees=2, feature_cols=COLS).fit(df.limit(0)).transform(df).where("prediction = 0.5").count() == len(rows[1])


def test_saved_trees_score_the_same(spark, rows):
    import uuid

    from scorekit.session import ensure_checkpoint_dir
    from scorekit.sources import io
    df = frame(spark, rows)
    for m in (GradientBoosting(rounds=2, depth=2, cuts=CUTS, feature_cols=COLS).fit(df), et.ExtraTrees(n_trees=2, depth=2, feature_cols=COLS).fit(df)):
        loaded = io.load_model(io.save_model(m, f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"))
        assert [r.prediction for r in loaded.transform(df).collect()] == [r.prediction for r in m.transform(df).collect()]


def test_adaboost_in_one_projection(spark, rows):
    from scorekit.operators import models as mdl
    from scorekit.operators.features import assemble
    df = assemble(frame(spark, rows), COLS, fill=dict.fromkeys(COLS, 0.0))
    few, many = (mdl.AdaBoost(depth=2, rounds=r, rate=.5).fit(df) for r in (2, 5))
    assert [r.prob for r in many.transform(df).orderBy("id").collect()] == pytest.approx([r.prob for r in many._chained(df).orderBy("id").collect()], abs=1e-12)
    size = lambda m: len(m.transform(df)._jdf.queryExecution().executedPlan().toString())
    assert abs(size(few) - size(many)) < 60


def test_descent_and_nodes_as_row_by_row():
    """Rows reach the leaves that a walk of each row reaches, and are dealt to nodes by one sort, nodes without rows left out."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 50, (400, 3)).astype(float)
    x[::7, 1] = np.nan
    trees = tr.PackedTrees()
    for t in range(4):
        level = [trees.add_tree(0.5, 400)]
        for _ in range(t):  # the first tree is a leaf
            level = [kid for node in level[:3] for kid in trees.split(node, int(rng.integers(3)), float(rng.integers(50)), bool(rng.integers(2)), 1.0, (rng.random(), 1), (rng.random(), 1))]
    feature, cut, missing_left, left, right, value, roots = trees.arrays()

    def leaf(row, at):
        while feature[at] >= 0:
            v = row[feature[at]]
            at = left[at] if (missing_left[at] if np.isnan(v) else v <= cut[at]) else right[at]
        return at
    walk = tr.walkable(trees.arrays())
    want = np.array([[leaf(row, root) for root in roots] for row in x])
    got = np.stack([tr.descend(tr.by_feature(x), walk, t) for t in range(4)], axis=1)
    assert (got == want).all()
    assert np.allclose(tr.sum_of_trees(x, walk, value, at_once=900), tr.sum_of_trees(x, walk, value), rtol=1e-15)
    assert np.allclose(tr.sum_of_trees(x, walk, value), value[want].sum(axis=1), rtol=1e-15)
    number = rng.integers(0, 300, 400)
    number[number % 5 == 0] = 300  # closed
    rows_of, nodes, starts, sizes = et.rows_by_node(number.astype(np.uint16), 300)
    assert nodes.tolist() == sorted(set(number.tolist()) - {300})
    assert [sorted(rows_of[a:a + n]) for a, n in zip(starts, sizes)] == [np.flatnonzero(number == k).tolist() for k in nodes]
    assert [len(v) for v in et.rows_by_node(np.full(5, 2, np.uint8), 2)] == [0, 0, 0, 0]
