"""A14 against the brute-force estimator; J7 against numpy brute force."""

import math

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorekit.operators import knn


def mutual_info_knn_local(x: np.ndarray, y: np.ndarray, k: int = 3) -> float:
    """The same estimator by brute force."""
    def psi(v):
        v = np.asarray(v, dtype=float)
        out = np.zeros_like(v)
        for i, t in enumerate(v.flat):
            s = 0.0
            while t < 6:
                s -= 1.0 / t
                t += 1
            inv = 1 / t
            inv2 = inv * inv
            out.flat[i] = s + math.log(t) - 0.5 * inv - inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
        return out

    labels, cnt = np.unique(y, return_counts=True)
    keep = np.isin(y, labels[cnt > 1])
    x, y = x[keep], y[keep]
    n = len(x)
    r = np.zeros(n)
    kk = np.zeros(n)
    ny = np.zeros(n)
    for lab in np.unique(y):
        idx = np.nonzero(y == lab)[0]
        kp = min(k, len(idx) - 1)
        for i in idx:
            d = np.sort(np.abs(x[idx] - x[i]))
            r[i] = d[kp]  # d[0] is the point itself
        kk[idx] = kp
        ny[idx] = len(idx)
    m = np.array([np.sum(np.abs(x - x[i]) < r[i]) if r[i] > 0 else np.sum(x == x[i]) for i in range(n)])
    return max(0.0, float(psi([n])[0] + psi(kk).mean() - psi(ny).mean() - psi(m).mean()))


def test_mutual_info_knn_matches_bruteforce(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        y = int(rnd.random() < 0.4)
        x = rnd.gauss(1.0 if y else 0.0, 1.0)
        z = float(rnd.randint(0, 8))  # heavy ties
        rows.append((x, z, y))
    rows.append((5.0, 3.0, 2))  # a class with one row is left out
    df = spark.createDataFrame(rows, "x double, z double, y int").repartition(4)
    got = {r["feature"]: r["mi"] for r in knn.mutual_info_knn(df, ["x", "z"], "y", k=3, rows_per_bucket=40).collect()}
    arr = np.array(rows)
    for i, name in enumerate(["x", "z"]):
        want = mutual_info_knn_local(arr[:, i], arr[:, 2].astype(int), k=3)
        assert got[name] == pytest.approx(want, abs=1e-9)


def test_knn_join_matches_numpy(spark):
    rnd = np.random.RandomState(0)
    base = rnd.normal(size=(120, 5))
    qs = rnd.normal(size=(15, 5))
    bdf = spark.createDataFrame([(int(i), [float(v) for v in row], int(i % 3)) for i, row in enumerate(base)],
                                "id long, embedding array<double>, label int")
    qdf = spark.createDataFrame([(int(1000 + i), [float(v) for v in row], 0) for i, row in enumerate(qs)],
                                "id long, embedding array<double>, label int")
    for metric in ("euclidean", "manhattan", "cosine"):
        got = knn.knn_join(qdf, bdf.repartition(6), 4, metric, block_rows=4).orderBy("qid", "rank").collect()
        for i, q in enumerate(qs):
            d = knn._distances(q[None, :], base, metric)[0]
            want = list(np.lexsort((np.arange(len(base)), d))[:4])
            have = [r["bid"] for r in got if r["qid"] == 1000 + i]
            assert have == want, metric


def test_soft_vote_prefix_equals_separate_joins(spark):
    rnd = np.random.RandomState(3)
    base = spark.createDataFrame([(int(i), [float(v) for v in rnd.normal(size=4)], int(i % 3)) for i in range(80)],
                                 "id long, embedding array<double>, label int")
    qs = spark.createDataFrame([(int(500 + i), [float(v) for v in rnd.normal(size=4)], 0) for i in range(10)],
                               "id long, embedding array<double>, label int")
    got = {(r["qid"], r["label"]): r["prob"] for r in knn.knn_soft_vote(qs, base, [(3, "euclidean"), (5, "euclidean")]).collect()}
    sep = {}
    for k in (3, 5):
        for r in knn.knn_vote(knn.knn_join(qs, base, k, "euclidean")).collect():
            sep[(r["qid"], r["label"])] = sep.get((r["qid"], r["label"]), 0.0) + r["share"] / 2
    assert got.keys() == sep.keys()
    assert all(abs(got[x] - sep[x]) < 1e-12 for x in got)


def _frames(spark, rnd, n_base, n_q, dim=6, clusters=12):
    centres = rnd.normal(size=(clusters, dim)) * 6
    make = lambda n, at: [(int(at + i), [float(v) for v in centres[rnd.randint(clusters)] + rnd.normal(size=dim)], int(i % 3)) for i in range(n)]
    kind = "id long, embedding array<double>, label int"
    return spark.createDataFrame(make(n_q, 100_000), kind), spark.createDataFrame(make(n_base, 0), kind).repartition(5)


def test_knn_cells_do_not_change_the_result(spark):
    q, b = _frames(spark, np.random.RandomState(1), 700, 40)
    b = b.unionByName(spark.createDataFrame([(9000, None, 1), (9001, None, 0)], b.schema))
    want = sorted(map(tuple, knn.knn_join(q, b, 3, "manhattan").collect()))
    assert len(want) == 120
    assert sorted(map(tuple, knn.knn_join(q, b, 3, "manhattan", block_rows=7, cell_bytes=5000).collect())) == want
    assert knn.knn_join(q.limit(0), b, 3).count() == 0 and knn.knn_join(q, b.limit(0), 3).count() == 0
    assert len(knn.knn_join(q, b.limit(2), 3).collect()) == 80


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "minkowski"])
def test_pruned_join_is_exact_and_measures_less(spark, metric):
    q, b = _frames(spark, np.random.RandomState(2), 1500, 30)
    want = sorted((r.qid, r["rank"], r.bid, round(r.distance, 9), r.label) for r in knn.knn_join(q, b, 4, metric).collect())
    got, counts = knn.knn_pruned(q, b, 4, metric, pivots=40, cell_rows=60)
    assert sorted((r.qid, r["rank"], r.bid, round(r.distance, 9), r.label) for r in got.collect()) == want
    measured = [r.measured for r in counts.collect()]
    assert len(measured) == 30 and sum(measured) < 0.35 * 30 * 1500


def test_approximate_join_recall(spark):
    for seed, kw in ((3, {}), (4, {"cell_rows": 50})):
        q, b = _frames(spark, np.random.RandomState(seed), 3000, 60, dim=16)
        exact = {(r.qid, r.bid) for r in knn.knn_join(q, b, 5).collect()}
        rows = knn.knn_approx(q, b, 5, bucket_rows=150, **kw).collect()
        assert len({(r.qid, r.bid) for r in rows} & exact) >= 0.9 * len(exact)
        vec = {r.id: np.array(r.embedding) for r in q.union(b).collect()}
        assert all(abs(np.linalg.norm(vec[r.qid] - vec[r.bid]) - r.distance) < 1e-9 for r in rows)
    assert knn.knn_approx(q, b.limit(0), 5).count() == 0


def test_no_row_of_the_queries_reaches_the_driver(spark, monkeypatch):
    from pyspark.sql import DataFrame
    q, b = _frames(spark, np.random.RandomState(5), 300, 20)
    monkeypatch.setattr(DataFrame, "collect", lambda self: (_ for _ in ()).throw(AssertionError("collected")))
    monkeypatch.setattr(DataFrame, "toPandas", lambda self: (_ for _ in ()).throw(AssertionError("collected")))
    assert knn.knn_join(q, b, 3).count() == 60


@pytest.mark.parametrize("metric", knn.METRICS)
def test_nearest_rows_screen_loses_nothing(metric):
    """Copies, near copies, zeros and large scales against a full sort; memory in small pieces."""
    rnd = np.random.RandomState(6)
    for scale in (1.0, 1e-9, 1e12):
        b = np.concatenate([rnd.normal(size=(3000, 7)), np.repeat(rnd.normal(size=(1, 7)), 500, axis=0), np.zeros((2, 7))]) * scale
        q = np.concatenate([rnd.normal(size=(20, 7)), b[3100:3101] / scale, b[:5] / scale + 1e-9, np.zeros((1, 7))]) * scale
        ids = rnd.permutation(len(b)) * 3
        d, at = knn.nearest_rows(q, ids, b, 6, metric, 3.0, cells=2000)
        for i in range(len(q)):
            want = knn._measured(np.repeat(q[i:i + 1], len(b), axis=0), b, metric, 3.0)
            order = np.lexsort((ids, want))[:6]
            assert at[i].tolist() == order.tolist() and np.array_equal(d[i], want[order])
    few = knn.nearest_rows(q, ids[:2], b[:2], 6, metric, 3.0)[0]
    assert np.isfinite(few[:, :2]).all() and np.isinf(few[:, 2:]).all()


def test_nearest_rows_needs_little_memory():
    import tracemalloc
    rnd = np.random.RandomState(7)
    q, b = rnd.normal(size=(300, 64)), rnd.normal(size=(6000, 64))
    for metric in knn.METRICS:
        tracemalloc.start()
        knn.nearest_rows(q, np.arange(6000), b, 5, metric, 3.0)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40 << 20


def test_pruned_queries_travel_once_to_a_part(spark, monkeypatch):
    """Small cell_rows must not send a query to a task for each of them: parts are bounded by bytes."""
    q, b = _frames(spark, np.random.RandomState(8), 2000, 40)
    sent, kind = [], type(q)
    plain = kind.groupBy

    def watched(self, *cols):
        if "reach" in self.columns:
            sent.append(self.count())
        return plain(self, *cols)
    want = sorted((r.qid, r["rank"], r.bid, round(r.distance, 9)) for r in knn.knn_join(q, b, 3).collect())
    monkeypatch.setattr(kind, "groupBy", watched)
    got = knn.knn_pruned(q, b, 3, pivots=4, cell_rows=10)[0]
    assert sorted((r.qid, r["rank"], r.bid, round(r.distance, 9)) for r in got.collect()) == want
    assert len(sent) == 1 and sent[0] <= 40 * 4
    split = knn.knn_pruned(q, b, 3, pivots=4, cell_rows=10, cell_bytes=8000)[0]  # several parts of queries and of cells
    assert sorted((r.qid, r["rank"], r.bid, round(r.distance, 9)) for r in split.collect()) == want


def test_kth_radius_as_row_by_row():
    """The radius of a value counts the rows of equal and near values on both sides, at the ends too."""
    rng = np.random.default_rng(3)
    for n, k in ((1, 3), (2, 3), (5, 3), (60, 1), (60, 4)):
        value = np.sort(rng.choice(200, n, replace=False)).astype(float)
        c = rng.integers(1, 4, n)
        rows = np.repeat(value, c)
        kp = np.full(n, min(k, len(rows) - 1))
        want = [np.sort(np.abs(rows - v))[kp[0]] for v in value]  # the first is the row itself
        assert knn.kth_radius(value, c, kp, k).tolist() == want


def test_mutual_info_sorts_a_bucket_without_windows_of_neighbours(spark, monkeypatch):
    """Radii come from one pass over a bucket's arrays: no window looks at a neighbour's row, and none sorts downwards."""
    seen = []
    monkeypatch.setattr(knn.F, "lag", lambda *a: seen.append("lag"))
    monkeypatch.setattr(knn.F, "lead", lambda *a: seen.append("lead"))
    df = spark.createDataFrame([(float(i * 7 % 50), i % 2) for i in range(200)], "x double, y int")
    got = knn.mutual_info_knn(df, ["x"], "y", k=3, rows_per_bucket=20).collect()
    arr = np.array([(i * 7 % 50, i % 2) for i in range(200)], float)
    assert not seen and got[0]["mi"] == pytest.approx(mutual_info_knn_local(arr[:, 0], arr[:, 1].astype(int)), abs=1e-6)
