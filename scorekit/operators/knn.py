"""k-nearest-neighbour operators: exact k-NN join and vote (J7, M9) and the k-NN mutual
information estimator for a continuous feature against a class (A14).

k-NN join. Both sides are dealt into packed cells of bounded size; every query cell meets every base
cell in a co-grouped task (numpy; pairs are never rows), and the best k of the cells' candidates are
merged by a ``row_number`` per query. Nothing of either side reaches the driver. ``knn_pruned`` visits only the
cells around pivots that the triangle inequality leaves; ``knn_approx`` only buckets of random projections.

Mutual information (Ross 2014, the estimator behind the reference's selection). In one dimension
the k nearest neighbours of a value inside its class are among the k distinct values before and
after it, so per distinct ``(feature, class, value)``: lag/lead 1..k inside value buckets (with a
halo of k values from neighbouring buckets), radius = k'-th neighbour distance. The count m of
all values strictly inside the radius is two rank lookups on the value order, computed by the
bucketed prefix sum over data values and query bounds together, never a range join.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, guard_union_partitioning, keep
from .joins import sized_join
from .order import add_group_value_bucket, prefix_sum, session_bucket_rows
from .stats import to_long

METRICS = ("euclidean", "manhattan", "minkowski", "cosine")


def _distances(q: np.ndarray, b: np.ndarray, metric: str, p: float = 3.0, budget: int = 50_000_000) -> np.ndarray:
    """Dense query x base distances. Element-wise metrics run in sub-chunks so the temporary
    (queries x base x dims) array stays within ``budget`` elements."""
    if metric == "euclidean":
        d2 = (q * q).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * q @ b.T
        return np.sqrt(np.maximum(d2, 0.0))
    if metric == "cosine":
        qn = np.linalg.norm(q, axis=1)[:, None]
        bn = np.linalg.norm(b, axis=1)[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            sim = (q @ b.T) / (qn * bn)
        return 1.0 - np.nan_to_num(sim)
    if metric not in ("manhattan", "minkowski"):
        raise ValueError(metric)
    step = max(1, budget // max(1, b.shape[0] * b.shape[1]))
    out = np.empty((q.shape[0], b.shape[0]))
    for s in range(0, q.shape[0], step):
        diff = np.abs(q[s:s + step, None, :] - b[None, :, :])
        out[s:s + step] = diff.sum(2) if metric == "manhattan" else (diff ** p).sum(2) ** (1.0 / p)
    return out


def _measured(qv: np.ndarray, bv: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Distances of a few (query, base) pairs, rows of ``qv`` against rows of ``bv``: each pair by itself, whatever else is measured."""
    if metric == "cosine":
        with np.errstate(invalid="ignore", divide="ignore"):
            return 1.0 - np.nan_to_num((qv * bv).sum(1) / (np.linalg.norm(qv, axis=1) * np.linalg.norm(bv, axis=1)))
    if metric == "euclidean":
        return np.sqrt(((qv - bv) ** 2).sum(1))
    diff = np.abs(qv - bv)
    return diff.sum(1) if metric == "manhattan" else (diff ** p).sum(1) ** (1.0 / p)


class _Screen:
    """Cheap distances of query rows to base rows with a bound of their error, in a form that grows with the distance: squares by a matrix product,
    sums of powers coordinate by coordinate (in single precision where the values allow it). ``level`` turns a distance into that form."""

    def __init__(self, q: np.ndarray, b: np.ndarray, metric: str, p: float):
        self.metric, self.p = metric, p
        if metric == "euclidean":
            self.q, self.b, self.qq, self.bb = q, b, (q * q).sum(1), (b * b).sum(1)
            self.slack = 4e-16 * (q.shape[1] + 8) * (self.qq + self.bb.max(initial=0.0))
        elif metric == "cosine":
            with np.errstate(invalid="ignore", divide="ignore"):
                self.q, self.b = (np.nan_to_num(x / np.linalg.norm(x, axis=1)[:, None], posinf=0.0, neginf=0.0) for x in (q, b))
            self.slack = np.full(len(q), 4e-16 * (q.shape[1] + 8))
        else:
            top = max(np.abs(q).max(initial=0.0), np.abs(b).max(initial=0.0))
            kind = np.float32 if 1e-4 < top < 1e10 and (metric == "manhattan" or p == 3) else np.float64
            self.q, self.b = np.ascontiguousarray(q.T, kind), np.ascontiguousarray(b.T, kind)
            self.slack = 2 * np.finfo(kind).eps * (q.shape[1] + 8) * (np.abs(q).sum(1) + np.abs(b).sum(1).max(initial=0.0))

    def level(self, distance: np.ndarray, rows: slice) -> np.ndarray:
        if self.metric == "euclidean":
            return distance ** 2 + self.slack[rows]
        wide = distance + self.slack[rows]
        return wide ** self.p if self.metric == "minkowski" else wide

    def distance(self, level: np.ndarray, rows: slice) -> np.ndarray:
        """An upper bound of the distance behind a level."""
        if self.metric == "euclidean":
            return np.sqrt(np.maximum(level, 0.0) + self.slack[rows])
        return (level ** (1.0 / self.p) if self.metric == "minkowski" else level) + self.slack[rows]

    def __call__(self, rows: slice, cols: slice) -> np.ndarray:
        if self.metric == "euclidean":
            out = self.q[rows] @ self.b[cols].T
            out *= -2
            out += self.qq[rows, None]
            out += self.bb[None, cols]
            return out
        if self.metric == "cosine":
            out = self.q[rows] @ self.b[cols].T
            return np.subtract(1.0, out, out=out)
        q, b = self.q[:, rows], self.b[:, cols]
        out = np.zeros((q.shape[1], b.shape[1]), q.dtype)
        diff, power = np.empty_like(out), np.empty_like(out)
        for x, y in zip(q, b):
            np.subtract(x[:, None], y[None, :], out=diff)
            np.abs(diff, out=diff)
            if self.metric == "minkowski":
                if self.p == 3:
                    np.multiply(diff, diff, out=power)
                    diff *= power
                else:
                    np.power(diff, self.p, out=diff)
            out += diff
        return out


def nearest_rows(q_vec: np.ndarray, b_id: np.ndarray, b_vec: np.ndarray, k: int, metric: str, p: float, cells: int = 1 << 16) -> tuple:
    """For each query the ``k`` nearest base rows: distances and places in ``b_id``, padded with infinity; ties by base id.
    Pairs are screened in pieces of at most about ``cells``; only those within the k-th distance so far are measured and sorted."""
    if metric not in METRICS:
        raise ValueError(metric)
    nq, nb = len(q_vec), len(b_id)
    best_d, best_b = np.full((nq, k), np.inf), np.zeros((nq, k), np.int64)
    if not nq or not nb:
        return best_d, best_b
    step_b = max(1, min(nb, 1024, cells))
    step_q = max(1, cells // step_b)
    strip = 1 << 14  # base rows whose screen is prepared at a time
    for lo in range(0, nb, strip):
        part = b_vec[lo:lo + strip]
        for at_q in range(0, nq, 1 << 12):
            some = q_vec[at_q:at_q + (1 << 12)]
            screen = _Screen(some, part, metric, p)
            for s in range(0, len(some), step_q):
                rows = slice(s, min(len(some), s + step_q))
                own = slice(at_q + rows.start, at_q + rows.stop)
                for at in range(0, len(part), step_b):
                    d = screen(rows, slice(at, at + step_b))
                    level = screen.level(best_d[own, -1], rows)
                    if d.shape[1] >= k and not np.isfinite(level).all():
                        kth = np.partition(d, k - 1, axis=1)[:, k - 1].astype(np.float64)
                        level = np.minimum(level, screen.level(screen.distance(kth, rows), rows))
                    rr, cc = np.nonzero(~(d > level[:, None]))
                    if not len(rr):
                        continue
                    cc = cc + at
                    found = _measured(some[rows][rr], part[cc], metric, p)
                    n = rows.stop - rows.start
                    # merge the running best with what was found: distance, then base id
                    row = np.concatenate([np.repeat(np.arange(n), k), rr])
                    dist = np.concatenate([best_d[own].ravel(), found])
                    place = np.concatenate([best_b[own].ravel(), cc + lo])
                    order = np.lexsort((b_id[place], dist, row))
                    first = np.searchsorted(row[order], np.arange(n))
                    take = order[(first[:, None] + np.arange(k)[None, :]).ravel()]
                    best_d[own], best_b[own] = dist[take].reshape(n, k), place[take].reshape(n, k)
    return best_d, best_b


def _packed(rows: DataFrame, cells: int, id_col: str, vec_col: str, label_col: str | None, salt: int) -> DataFrame:
    """``(cell, ids, vecs, labels)``: the rows dealt to ``cells`` by hash of the id, each partition's share of a cell in one row."""
    src = rows.select(F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), F.lit(cells)).alias("cell"), F.col(id_col).cast("bigint").alias("id"),
                      F.col(vec_col).cast("array<double>").alias("vec"), (F.col(label_col) if label_col else F.lit(0)).cast("bigint").alias("label"))
    src = src.where("vec is not null")

    def kernel(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cell, ids, labels = (np.asarray(b.column(k)) for k in (0, 1, 3))
            vecs = np.asarray(b.column(2).flatten()).reshape(len(ids), -1)
            for c in np.unique(cell):
                own = cell == c
                yield pa.RecordBatch.from_arrays([pa.array([int(c)], pa.int64()), pa.array([ids[own].tobytes()], pa.binary()), pa.array([vecs[own].tobytes()], pa.binary()),
                                                  pa.array([labels[own].tobytes()], pa.binary())], names=["cell", "ids", "vecs", "labels"])
    return src.mapInArrow(kernel, "cell bigint, ids binary, vecs binary, labels binary")


def _unpacked(table: pa.Table) -> tuple:
    """Ids, vectors and labels of packed rows, in order of the id; the vectors are copied once."""
    ids, labels = (np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table[c]]) for c in ("ids", "labels"))
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    packs = [np.frombuffer(x.as_buffer(), np.float64) for x in table["vecs"]]
    vecs, at = np.empty((len(ids), sum(map(len, packs)) // max(1, len(ids)))), 0
    for x in packs:
        n = len(x) // vecs.shape[1] if vecs.shape[1] else 0
        vecs[place[at:at + n]] = x.reshape(n, -1) if n else x.reshape(0, vecs.shape[1])
        at += n
    return ids[order], vecs, labels[order]


FOUND = "qid bigint, bid bigint, distance double, label bigint"


def _found(qid, bid, distance, label) -> pa.Table:
    return pa.table({"qid": pa.array(qid, pa.int64()), "bid": pa.array(bid, pa.int64()), "distance": pa.array(distance, pa.float64()),
                     "label": pa.array(label, pa.int64())})


def _merged(found: DataFrame, k: int, label_col: str | None) -> DataFrame:
    """The best ``k`` of every query's candidates: ``(qid, bid, distance[, label], rank)``."""
    w = Window.partitionBy("qid").orderBy("distance", "bid")
    out = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out if label_col else out.drop("label")


def knn_join(queries: DataFrame, base: DataFrame, k: int, metric: str = "euclidean", p: float = 3.0,
             id_col: str = "id", vec_col: str = "embedding", label_col: str | None = "label",
             block_rows: int | None = None, cell_bytes: int = 32 << 20) -> DataFrame:
    """The k nearest base rows of every query row (ties by base id), exact.

    Both sides are dealt by hash of the id into cells of about ``cell_bytes`` (queries of at most about ``block_rows`` rows) and packed,
    one row for each cell and partition. Every query cell meets every base cell in one co-grouped task, which returns k rows for each
    query; a window per query keeps the best k of at most k x base cells. No row of either side reaches the driver, and a
    task holds two cells, however many rows there are. Shuffled: queries x base cells + base x query cells.

    Returns ``(qid, rank, bid, distance[, label])``."""
    spark = queries.sparkSession
    guard_union_partitioning(spark)
    n_q, n_b = queries.count(), base.count()
    width = 8 * ((base.select(F.size(vec_col)).where(F.col(vec_col).isNotNull()).first() or [1])[0] + 2)
    at_once = max(1, cell_bytes // width)
    q_cells = max(1, math.ceil(n_q / min(at_once, block_rows or at_once)))
    # few rows still go to as many tasks as the session has cores
    b_cells = max(1, math.ceil(n_b / at_once), min(math.ceil(spark.sparkContext.defaultParallelism / q_cells), n_b // 256))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = _packed(queries, q_cells, id_col, vec_col, None, 1).withColumnRenamed("cell", "q_cell").withColumn("b_cell", each(b_cells))
    right = _packed(base, b_cells, id_col, vec_col, label_col, 2).withColumnRenamed("cell", "b_cell").withColumn("q_cell", each(q_cells))

    def meet(lt: pa.Table, rt: pa.Table) -> pa.Table:
        if not lt.num_rows or not rt.num_rows:
            return _found([], [], [], [])
        (q_id, q_vec, _), (b_id, b_vec, b_lab) = _unpacked(lt), _unpacked(rt)
        d, at = nearest_rows(q_vec, b_id, b_vec, k, metric, p)
        ok = np.isfinite(d)
        return _found(np.broadcast_to(q_id[:, None], d.shape)[ok], b_id[at[ok]], d[ok], b_lab[at[ok]])

    # the literal makes every (k, metric) plan distinct, so no subplan of one variant is reused for another
    # (Python functions do not take part in plan equality)
    tag = F.lit(f"{metric}:{k}:{p}")
    found = (left.withColumn("tag", tag).groupBy("tag", "q_cell", "b_cell").cogroup(right.withColumn("tag", tag).groupBy("tag", "q_cell", "b_cell"))
             .applyInArrow(meet, FOUND))
    return _merged(found, k, label_col)


# --- J7 at scale: exact with pruning, and approximate ------------------------------------------

def _pivots(base: DataFrame, n: int, id_col: str, vec_col: str, seed: int) -> np.ndarray:
    """At most ``n`` base vectors, the first by hash of the id."""
    rows = base.where(F.col(vec_col).isNotNull()).orderBy(F.xxhash64(F.lit(seed), F.col(id_col)), F.col(id_col)).limit(n).select(F.col(vec_col).cast("array<double>")).collect()
    return np.array([r[0] for r in rows], np.float64)


def _rows_of(vecs: pa.ChunkedArray, n: int) -> np.ndarray:
    return np.concatenate([np.asarray(c.flatten(), np.float64) for c in vecs.chunks]).reshape(n, -1)


def _vectors(b: pa.RecordBatch, name: str = "vec") -> np.ndarray:
    return np.asarray(b.column(b.schema.get_field_index(name)).flatten(), np.float64).reshape(b.num_rows, -1)


def knn_pruned(queries: DataFrame, base: DataFrame, k: int, metric: str = "euclidean", p: float = 3.0, id_col: str = "id",
               vec_col: str = "embedding", label_col: str | None = "label", pivots: int = 64, cell_rows: int = 50_000, seed: int = 42,
               cell_bytes: int = 32 << 20) -> tuple:
    """J7, exact, with pruning by the triangle inequality (not for cosine): ``(neighbours, counts)``.

    Base rows belong to the nearest of ``pivots`` sample rows and keep their distance from it; a cell keeps its largest and its k
    smallest distances. Those give each query an upper bound of its k-th distance, so it visits only cells that the
    bound reaches, and there only rows whose distance from the pivot is within the bound of its own. Cells are split by hash into
    parts of about ``cell_bytes``, at least ``cell_rows`` rows, and so are the queries: a task holds one part of each, and a query travels once to
    every part of the cells that it visits. ``counts(qid, measured)`` says how many distances were computed for each query, those to the
    pivots included; queries with nearly the same ring of a cell are measured together."""
    if metric not in ("euclidean", "manhattan", "minkowski"):
        raise ValueError(metric)
    guard_union_partitioning(base.sparkSession)
    pv = _pivots(base, pivots, id_col, vec_col, seed)
    n_dim = pv.shape[1] if len(pv) else 0

    def exact(a, b):
        d = _distances(a, b, metric, p)
        return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2)) if metric == "euclidean" and a.shape[0] * b.size <= 1 << 22 else d

    def assign(batches):
        for b in batches:
            v = _vectors(b)
            if not len(v):
                continue
            for s in range(0, len(v), 1024):
                d = exact(v[s:s + 1024], pv)
                near = d.argmin(axis=1)
                part = b.slice(s, 1024)
                yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near]), *part.columns], names=["cell", "far", "id", "vec", "label"])

    rows = base.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                                                         (F.col(label_col) if label_col else F.lit(0)).cast("bigint").alias("label"))
    placed = cut_lineage(rows.mapInArrow(assign, "cell int, far double, id bigint, vec array<double>, label bigint"))
    low = Window.partitionBy("cell", "part").orderBy("far")
    small = (placed.select("cell", "far", F.spark_partition_id().alias("part")).withColumn("at", F.row_number().over(low)).where(F.col("at") <= k)
             .groupBy("cell").agg(F.slice(F.array_sort(F.collect_list("far")), 1, k).alias("small")))  # at most k for each partition
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).join(small, "cell").collect()}  # a row for each pivot
    radius = np.array([cells[c]["radius"] if c in cells else -np.inf for c in range(len(pv))])
    small_d = np.full((len(pv), k), np.inf)
    for c, r in cells.items():
        small_d[c, :len(r["small"])] = r["small"]
    at_once = max(1, cell_bytes // (8 * (n_dim + 4)))
    parts = np.array([math.ceil(cells[c]["n"] / max(cell_rows, at_once)) if c in cells else 0 for c in range(len(pv))], np.int64)
    q_parts = max(1, math.ceil(queries.count() / at_once))
    slack = 1 + 1e-9

    def visit(batches):
        for b in batches:
            whole = _vectors(b)
            ids = np.asarray(b.column(0))
            for s in range(0, len(whole), 256):
                v = whole[s:s + 256]
                d = exact(v, pv)
                reach = np.partition((d[:, :, None] + small_d[None]).reshape(len(v), -1), k - 1, axis=1)[:, k - 1] * slack
                # nothing in a cell is nearer than its ring allows, nor than half of what its pivot is farther than the nearest one
                nearest = np.maximum(np.maximum(d - radius[None], small_d[None, :, 0] - d), (d - d.min(axis=1)[:, None]) / 2) / slack
                row, cell = np.nonzero((nearest <= reach[:, None]) & (parts > 0)[None])
                again = np.repeat(np.arange(len(row)), parts[cell])
                sub = np.arange(len(again)) - np.repeat(np.cumsum(parts[cell]) - parts[cell], parts[cell])
                row, cell = row[again], cell[again]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(sub.astype(np.int64)), pa.array(ids[s + row]), pa.array(d[row, cell]), pa.array(reach[row]),
                     pa.ListArray.from_arrays(np.arange(len(row) + 1, dtype=np.int32) * n_dim, v[row].ravel())], names=["cell", "sub", "id", "far", "reach", "vec"])

    asked = queries.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    visits = asked.mapInArrow(visit, "cell int, sub bigint, id bigint, far double, reach double, vec array<double>")
    visits = visits.withColumn("q_part", F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(q_parts)).cast("int"))
    split = F.create_map(*[F.lit(int(x)) for c, n in enumerate(parts) for x in (c, n)])[F.col("cell")] if len(pv) else F.lit(1)
    held = placed.withColumn("sub", F.pmod(F.xxhash64("id"), split.cast("bigint"))).withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1))))

    def meet(lt: pa.Table, rt: pa.Table) -> pa.Table:
        empty = _found([], [], [], []).append_column("measured", pa.array([], pa.int64()))
        if not lt.num_rows or not rt.num_rows:
            return empty
        rt = rt.sort_by([("far", "ascending"), ("id", "ascending")])
        far, b_id, b_lab = (rt[c].to_numpy() for c in ("far", "id", "label"))
        b_vec = _rows_of(rt["vec"], len(b_id))
        reach, q_far = (lt[c].to_numpy() for c in ("reach", "far"))
        lo, hi = np.searchsorted(far, (q_far - reach) / slack - 1e-12), np.searchsorted(far, (q_far + reach) * slack + 1e-12, "right")
        near = np.nonzero(lo < hi)[0]
        near = near[np.lexsort((hi[near], lo[near]))]
        q_id, q_vec = lt["id"].to_numpy(), _rows_of(lt["vec"], lt.num_rows)
        out, s = [], 0
        while s < len(near):
            # the next queries, as long as their common ring is at most a quarter larger than the smallest of them
            ahead = near[s:s + 256]
            wide, least = np.maximum.accumulate(hi[ahead]) - lo[ahead[0]], np.minimum.accumulate(hi[ahead] - lo[ahead])
            fits = 4 * wide <= 5 * least
            fits[0] = True
            js = ahead[:len(ahead) if fits.all() else int(np.argmin(fits))]
            s += len(js)
            own = slice(lo[js[0]], hi[js].max())
            d, at = nearest_rows(q_vec[js], b_id[own], b_vec[own], k, metric, p)
            row, place = np.nonzero(np.isfinite(d))
            here = at[row, place]
            out.append((q_id[js[row]], b_id[own][here], d[row, place], b_lab[own][here], np.where(place == 0, own.stop - own.start, 0)))
        if not out:
            return empty
        cols = [np.concatenate([x[c] for x in out]) for c in range(5)]
        return _found(*cols[:4]).append_column("measured", pa.array(cols[4].astype(np.int64)))

    found = cut_lineage(visits.groupBy("cell", "sub", "q_part").cogroup(held.groupBy("cell", "sub", "q_part")).applyInArrow(meet, FOUND + ", measured bigint"))
    counts = found.groupBy("qid").agg((F.sum("measured") + len(pv)).alias("measured"))
    return _merged(found.drop("measured"), k, label_col), counts


def _planes(n_dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables, bits, n_dim))


def knn_approx(queries: DataFrame, base: DataFrame, k: int, metric: str = "euclidean", p: float = 3.0, id_col: str = "id", vec_col: str = "embedding",
               label_col: str | None = "label", tables: int = 8, probes: int = 6, bucket_rows: int = 1_000, cell_rows: int = 20_000, seed: int = 42) -> DataFrame:
    """J7, approximate: random-projection buckets, exact re-rank of what they hold.

    Vectors are taken relative to the base's mean; the signs of ``bits`` random projections name a bucket, ``bits`` such that a bucket has about
    ``bucket_rows`` rows, in ``tables`` independent tables. A query looks into its own bucket of each table and the
    ``probes`` next ones, those that differ where its projections are closest to 0. Distances are exact; a bucket with over ``cell_rows``
    rows is split by hash, and the query goes to every part. Raise ``tables`` and ``probes`` for more recall."""
    spark = base.sparkSession
    guard_union_partitioning(spark)
    rows = base.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                                                         (F.col(label_col) if label_col else F.lit(0)).cast("bigint").alias("label"))
    asked = queries.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))

    def sums(batches):
        total, n = None, 0
        for b in batches:
            v = _vectors(b)
            if len(v):
                total, n = v.sum(axis=0) + (0 if total is None else total), n + len(v)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], names=["total", "n"])

    got = rows.select("vec").mapInArrow(sums, "total array<double>, n bigint").collect()  # one row for each partition
    n_b = sum(r["n"] for r in got)
    if not n_b:
        return _merged(spark.createDataFrame([], FOUND), k, label_col)
    mean = np.sum([r["total"] for r in got], axis=0) / n_b
    bits = max(0, math.ceil(math.log2(max(1, n_b / bucket_rows))))
    planes = _planes(len(mean), tables, bits, seed)
    flips = min(probes, 2**bits - 1)

    def keys(v: np.ndarray, more: int):
        """For each table the own bucket and ``more`` others of every vector, nearest planes flipped first."""
        for t in range(tables):
            x = (v - mean) @ planes[t].T
            own = ((x > 0) * (1 << np.arange(bits))).sum(axis=1).astype(np.int64)
            out = [own]
            if more:
                order = np.argsort(np.abs(x), axis=1)
                cost = np.sort(np.abs(x), axis=1)
                near = min(bits, 6)  # sets of flips among the six closest planes, cheapest first
                sets = np.arange(1, 1 << near)
                member = (sets[:, None] >> np.arange(near)) & 1
                price = cost[:, :near] ** 2 @ member.T
                for j in np.argsort(price, axis=1)[:, :more].T:
                    mask = (member[j] * (1 << order[:, :near])).sum(axis=1)
                    out.append(own ^ mask)
            yield t, np.stack(out, axis=1)

    def deal(batches):
        for b in batches:
            if b.num_rows:
                for t, own in keys(_vectors(b), 0):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t, np.int32)), pa.array(own[:, 0]), *b.columns], names=["t", "bucket", "id", "vec", "label"])

    def ask(batches):
        for b in batches:
            if b.num_rows:
                for t, own in keys(_vectors(b), flips):
                    again = np.repeat(np.arange(b.num_rows), own.shape[1])
                    part = b.take(pa.array(again))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(again), t, np.int32)), pa.array(own.ravel()), *part.columns], names=["t", "bucket", "id", "vec"])

    dealt = rows.mapInArrow(deal, "t int, bucket bigint, id bigint, vec array<double>, label bigint")
    sizes = keep(dealt.groupBy("t", "bucket").agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("bigint").alias("parts")))
    held = sized_join(dealt, sizes, ["t", "bucket"], "inner").withColumn("sub", F.pmod(F.xxhash64("id"), F.col("parts")))
    visits = sized_join(asked.mapInArrow(ask, "t int, bucket bigint, id bigint, vec array<double>"),
                        sizes.select("t", "bucket", F.col("parts").alias("among")), ["t", "bucket"], "inner")
    visits = visits.withColumn("sub", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("among") - 1)))

    def meet(lt: pa.Table, rt: pa.Table) -> pa.Table:
        if not lt.num_rows or not rt.num_rows:
            return _found([], [], [], [])
        rt = rt.sort_by("id")
        q_id, b_id, b_lab = lt["id"].to_numpy(), rt["id"].to_numpy(), rt["label"].to_numpy()
        q_vec, b_vec = (t["vec"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1) for t in (lt, rt))
        d, at = nearest_rows(q_vec, b_id, b_vec, k, metric, p)
        ok = np.isfinite(d)
        return _found(np.broadcast_to(q_id[:, None], d.shape)[ok], b_id[at[ok]], d[ok], b_lab[at[ok]])

    cols = ("t", "bucket", "sub")
    found = visits.groupBy(*cols).cogroup(held.groupBy(*cols)).applyInArrow(meet, FOUND)
    return _merged(found.dropDuplicates(["qid", "bid"]), k, label_col)


def knn_vote(neighbours: DataFrame) -> DataFrame:
    """Share of each label among a query's neighbours: ``(qid, label, share)``."""
    tot = neighbours.groupBy("qid").agg(F.count(F.lit(1)).alias("_n"))
    return (neighbours.groupBy("qid", "label").agg(F.count(F.lit(1)).alias("_c")).join(tot, "qid")
            .select("qid", "label", (F.col("_c") / F.col("_n")).alias("share")))


def knn_soft_vote(queries: DataFrame, base: DataFrame, variants, **kw) -> DataFrame:
    """M9: average of neighbour label shares over (k, metric) variants; prediction = arg max
    (smallest label on ties). Returns ``(qid, label, prob)`` and ``(qid, pred)`` rows in one frame."""
    shares = []
    # the k nearest are the first k of the largest k asked for the same metric: one join per metric
    by_metric: dict = {}
    for k, metric in variants:
        by_metric.setdefault(metric, []).append(k)
    for metric, ks in by_metric.items():
        nb = keep(knn_join(queries, base, max(ks), metric, **kw))  # read once per k below
        for k in ks:
            shares.append(knn_vote(nb.where(F.col("rank") <= k)).withColumn("variant", F.lit(f"{metric}_{k}")))
    allv = reduce(DataFrame.unionByName, shares)
    nvar = len(variants)
    probs = allv.groupBy("qid", "label").agg((F.sum("share") / nvar).alias("prob"))
    pred = probs.groupBy("qid").agg(F.min_by("label", F.struct(-F.round("prob", 9), F.col("label"))).alias("pred"))
    return probs.join(pred, "qid")


# --- A14: k-NN mutual information -------------------------------------------------------------

EULER = 0.5772156649015329


def digamma(x: Column) -> Column:
    """psi(x) for x > 0 as a Column: recurrence up to x + 6, then the asymptotic series."""
    x = x.cast("double")
    shift = reduce(lambda a, b: a + b, [F.lit(1.0) / (x + i) for i in range(6)])
    z = x + 6
    inv = F.lit(1.0) / z
    inv2 = inv * inv
    series = F.log(z) - 0.5 * inv - inv2 * (F.lit(1 / 12) - inv2 * (F.lit(1 / 120) - inv2 * (
        F.lit(1 / 252) - inv2 * (F.lit(1 / 240) - inv2 * F.lit(1 / 132)))))
    return series - shift


def kth_radius(value: np.ndarray, c: np.ndarray, kp: np.ndarray, k: int) -> np.ndarray:
    """For each of the sorted distinct values, of ``c`` rows each, the smallest distance d with at least ``kp`` other rows at distance <= d.

    Only the ``k`` values on either side can be that near: every row of them is tried, the two sides merged step by step."""
    n, far = len(value), np.inf
    side = lambda of, i, fill: np.concatenate([np.full(min(i, n), fill), of[:max(0, n - i)]])
    d = np.stack([np.abs(x - value) for i in range(1, k + 1) for x in (side(value, i, far), side(value[::-1], i, far)[::-1])])
    m = np.stack([x for i in range(1, k + 1) for x in (side(c, i, 0), side(c[::-1], i, 0)[::-1])])
    out = np.where(c - 1 >= kp, 0.0, far)
    for t in d:
        within = c - 1 + np.where(d <= t, m, 0).sum(axis=0)
        out = np.where((within >= kp) & (t < out), t, out)
    return out


def mutual_info_knn(df: DataFrame, cols, label_col: str, k: int = 3, rows_per_bucket: int | None = None) -> DataFrame:
    """Mutual information (nats) of each continuous column with the class, k-NN estimator.

    Rows whose class has a single row are left out, as in the reference library. Returns
    ``(feature, mi)``. Exact ties give a zero radius (the library adds seeded noise there). A bucket has
    250,000 rows, or the session-wide size where that is smaller, unless ``rows_per_bucket`` is given."""
    if rows_per_bucket is None:
        rows_per_bucket = min(250_000, session_bucket_rows())
    guard_union_partitioning(df.sparkSession)
    longf = to_long(df, cols, keep=[label_col]).withColumnRenamed(label_col, "y")
    # the estimator is a long chain of stages: its two wide intermediates are written to the
    # reliable checkpoint folder, which keeps plans small and lets a lost executor recompute
    # from the checkpoint instead of from the source
    base = cut_lineage(longf.groupBy("feature", "y", "value").agg(F.count(F.lit(1)).alias("c")))
    ny = keep(base.groupBy("feature", "y").agg(F.sum("c").alias("ny")))  # features x classes rows
    counts = sized_join(base, ny, ["feature", "y"], "inner").where(F.col("ny") > 1).select("feature", "y", "value", "c")
    bk, _ = add_group_value_bucket(counts, "value", "_b", ["feature", "y"], rows_per_bucket)
    part = ["feature", "y", "_b"]
    # halo: the k smallest / largest distinct values of every (feature, y, bucket) are copied into
    # the next / previous non-empty bucket (at most k buckets away, one value per bucket at least)
    whole = Window.partitionBy(*part)
    edge = bk.select("*", F.row_number().over(whole.orderBy("value")).alias("_ra"), F.count(F.lit(1)).over(whole).alias("_nb"))
    first, last = F.col("_ra") <= k, F.col("_ra") > F.col("_nb") - k
    ends = (edge.where(first | last)
            .groupBy(*part).agg(F.collect_list(F.when(first, F.struct("value", "c"))).alias("_first"),
                                F.collect_list(F.when(last, F.struct("value", "c"))).alias("_last")))
    wb = Window.partitionBy("feature", "y").orderBy("_b")
    halo_src = ends.select(
        "feature", "y", "_b",
        F.flatten(F.collect_list("_last").over(wb.rowsBetween(-k, -1))).alias("_prev"),
        F.flatten(F.collect_list("_first").over(wb.rowsBetween(1, k))).alias("_next"))
    halo = (halo_src.select("feature", "y", "_b", F.explode(F.concat("_prev", "_next")).alias("h"))
            .select("feature", "y", "_b", F.col("h.value").alias("value"), F.col("h.c").alias("c"),
                    F.lit(True).alias("halo")))
    body = bk.select("feature", "y", "_b", "value", "c", F.lit(False).alias("halo"))
    both = sized_join(body.unionByName(halo), ny, ["feature", "y"], "inner").withColumn("kp", F.least(F.lit(k), F.col("ny") - 1))

    def radii(t: pa.Table) -> pa.Table:
        t = t.sort_by("value")
        value, c, kp = (t[n].to_numpy() for n in ("value", "c", "kp"))
        return t.append_column("r", pa.array(kth_radius(value, c, kp, k))).filter(pc.invert(t["halo"])).select(names)

    names = ["feature", "y", "value", "c", "ny", "kp", "r"]
    kinds = {f.name: f.dataType.simpleString() for f in both.schema.fields} | {"r": "double"}
    rad = both.select("feature", "y", "_b", "value", "c", "ny", "kp", "halo").groupBy(*part).applyInArrow(radii, ", ".join(f"{n} {kinds[n]}" for n in names))
    rad = cut_lineage(rad)
    # m: values of the feature (all classes kept) strictly inside (x - r, x + r); r = 0 -> equal values
    allv = counts.groupBy("feature", "value").agg(F.sum("c").alias("w"))
    # query rows are keyed by (feature, qy, qv): (feature, class, value) is unique in ``rad``
    qs = rad.where(F.col("r") > 0).select("feature", F.col("y").alias("qy"), F.col("value").alias("qv"), F.col("c").alias("qc"), "r")
    # value + r need not be the neighbour's value to the last bit: the bounds are drawn in by a few ulps
    hair = (F.abs("qv") + F.col("r")) * F.lit(1e-13)
    hi = qs.select("feature", (F.col("qv") + F.col("r") - hair).alias("key"), F.lit(0).alias("_t"), "qy", "qv", "qc",
                   F.lit(0).cast("long").alias("w"))
    lo = qs.select("feature", (F.col("qv") - F.col("r") + hair).alias("key"), F.lit(2).alias("_t"), "qy", "qv", "qc",
                   F.lit(0).cast("long").alias("w"))
    data = allv.select("feature", F.col("value").alias("key"), F.lit(1).alias("_t"),
                       F.lit(None).cast(rad.schema["y"].dataType).alias("qy"), F.lit(None).cast("double").alias("qv"),
                       F.lit(None).cast("long").alias("qc"), "w")
    ranked = prefix_sum(hi.unionByName(lo).unionByName(data), "key", ["w"], part_cols=["feature"],
                        tie_cols=["_t"], rows_per_bucket=rows_per_bucket)
    m_pos = (ranked.where(F.col("_t") != 1).groupBy("feature", "qy", "qv", "qc")
             .agg((F.max(F.when(F.col("_t") == 0, F.col("cum_w"))) -
                   F.max(F.when(F.col("_t") == 2, F.col("cum_w")))).alias("m"))
             .select("feature", F.col("qc").alias("c"), "m"))
    m_zero = rad.where(F.col("r") == 0).join(allv, ["feature", "value"]).select("feature", "c", F.col("w").alias("m"))
    # the sums over the rows and over their m are taken apart, so no row is joined to its m
    sm = m_pos.unionByName(m_zero).groupBy("feature").agg(F.sum(F.col("c").cast("double") * digamma(F.col("m"))).alias("sm"))
    c = F.col("c").cast("double")
    agg = rad.groupBy("feature").agg(F.sum(c).alias("N"), F.sum(c * digamma(F.col("kp"))).alias("sk"),
                                     F.sum(c * digamma(F.col("ny"))).alias("sy")).join(sm, "feature")
    mi = digamma(F.col("N")) + (F.col("sk") - F.col("sy") - F.col("sm")) / F.col("N")
    return agg.select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))
