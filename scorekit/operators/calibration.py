"""Isotonic calibration without a gathering step.

Pooling adjacent violators gives the same steps in whatever order neighbours are pooled. So equal scores are pooled first, value
buckets are pooled each in a task of its own, and what is left is cut into pieces by position and pooled again, the pieces
shifted by half each time, until no two neighbours are out of order. Most buckets leave a handful of steps, so the
second round usually is one small piece. No score ever reaches the driver; it sees one row for each bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, guard_union_partitioning, keep
from .joins import sized_join
from .order import add_value_bucket, session_bucket_rows

STEPS = "part bigint, x_lo double, x_hi double, w double, wy double"


def pool(lo: np.ndarray, hi: np.ndarray, w: np.ndarray, wy: np.ndarray) -> tuple:
    """Pool adjacent violators of steps in order; equal neighbours become one step."""
    a, b, c, d = [], [], [], []
    for step in zip(lo.tolist(), hi.tolist(), w.tolist(), wy.tolist()):
        x0, x1, n, s = step
        while c and d[-1] * n >= s * c[-1]:
            x0, n, s = a.pop(), n + c.pop(), s + d.pop()
            b.pop()
        a.append(x0), b.append(x1), c.append(n), d.append(s)
    return tuple(np.array(v, np.float64) for v in (a, b, c, d))


def _pool_parts(steps: DataFrame) -> DataFrame:
    """Pool every part alone."""
    def kernel(table: pa.Table) -> pa.Table:
        x = [table[c].to_numpy() for c in ("x_lo", "x_hi", "w", "wy")]
        order = np.argsort(x[0], kind="stable")
        out = pool(*(v[order] for v in x))
        return pa.table({"part": pa.array(np.full(len(out[0]), table["part"][0].as_py(), np.int64)),
                         **{c: pa.array(v) for c, v in zip(("x_lo", "x_hi", "w", "wy"), out)}})
    return steps.groupBy("part").applyInArrow(kernel, STEPS)


def _summaries(steps: DataFrame) -> list:
    """One row for each part, in order of the scores: rows, mean of its first and of its last step."""
    mean = F.col("wy") / F.col("w")
    got = steps.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("x_lo").alias("x"), F.min_by(mean, "x_lo").alias("first"), F.max_by(mean, "x_lo").alias("last"))
    return sorted(got.collect(), key=lambda r: r["x"])


@dataclass
class IsotonicSteps:
    """``steps(x_lo, x_hi, value)``, a written table in which values rise with the scores."""

    steps: DataFrame
    n_steps: int


def calibrate_isotonic(oof: DataFrame, prob_col: str = "prob", label_col: str = "label", weight_col: str | None = None,
                       rows_per_bucket: int | None = None) -> IsotonicSteps:
    """Isotonic regression of the label on the score (rows without either are left out)."""
    spark = oof.sparkSession
    guard_union_partitioning(spark)
    rows_per_bucket = rows_per_bucket or session_bucket_rows()
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    x, y = F.col(prob_col).cast("double"), F.col(label_col).cast("double")
    pooled = keep(oof.where(x.isNotNull() & ~F.isnan(x) & y.isNotNull()).groupBy((x + F.lit(0.0)).alias("x_lo"))
                  .agg(F.sum(w).alias("w"), F.sum(w * y).alias("wy")))
    bucketed = add_value_bucket(pooled, "x_lo", "bucket", pooled.count(), rows_per_bucket)
    steps = cut_lineage(_pool_parts(bucketed.select(F.col("bucket").cast("bigint").alias("part"), "x_lo", F.col("x_lo").alias("x_hi"), "w", "wy")))
    shift = 0
    while True:
        parts = _summaries(steps)
        if all(a["last"] < b["first"] for a, b in zip(parts, parts[1:])):
            break
        before, n = {}, 0
        for r in parts:
            before[r["part"]], n = n, n + r["n"]
        size = max(2, rows_per_bucket)
        offsets = spark.createDataFrame(list(before.items()), "part bigint, before bigint")  # a row for each part
        place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("x_lo")) - 1
        placed = steps.join(F.broadcast(offsets), "part").withColumn("piece", F.floor((place + shift) / size).cast("bigint"))
        steps = cut_lineage(_pool_parts(placed.select(F.col("piece").alias("part"), "x_lo", "x_hi", "w", "wy")))
        shift = 0 if shift else size // 2
    return IsotonicSteps(steps.select("x_lo", "x_hi", (F.col("wy") / F.col("w")).alias("value")), sum(r["n"] for r in parts))


def apply_calibration(model: IsotonicSteps, df: DataFrame, prob_col: str = "prob", out_col: str = "calibrated",
                      rows_per_bucket: int | None = None) -> DataFrame:
    """Adds ``out_col``: the value of the score's step, between two steps on the line from one to the other, beyond the ends
    their values; null for a null or NaN score. Distinct scores and the ends of the steps are put in order bucket by bucket;
    a bucket knows the last end before it and the first one behind it."""
    guard_union_partitioning(df.sparkSession)
    spark = df.sparkSession
    x = F.col(prob_col).cast("double") + F.lit(0.0)
    asked = df.where(x.isNotNull() & ~F.isnan(x)).select(x.alias("x")).distinct().select("x", F.lit(None).cast("double").alias("y"), F.lit(1).alias("t"))
    ends = model.steps.select(F.explode(F.array_distinct(F.array("x_lo", "x_hi"))).alias("x"), F.col("value").alias("y"), F.lit(0).alias("t"))
    both = keep(asked.unionByName(ends))
    placed = keep(add_value_bucket(both, "x", "bucket", both.count(), rows_per_bucket or session_bucket_rows()))
    end = F.when(F.col("t") == 0, F.struct("x", "y"))
    edges = sorted(placed.groupBy("bucket").agg(F.min(end).alias("lo"), F.max(end).alias("hi")).collect(), key=lambda r: r["bucket"])  # a row for each bucket
    rows, last = [], None
    for r in edges:
        rows.append([r["bucket"], last, None])
        last = r["hi"] or last
    last = None
    for k in range(len(edges) - 1, -1, -1):
        rows[k][2] = last
        last = edges[k]["lo"] or last
    kind = "struct<x: double, y: double>"
    around = spark.createDataFrame([tuple(r) for r in rows], f"bucket double, earlier {kind}, later {kind}")
    upto = Window.partitionBy("bucket").orderBy("x", "t")
    below = F.last(end, ignorenulls=True).over(upto.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(end, ignorenulls=True).over(upto.rowsBetween(0, Window.unboundedFollowing))
    near = placed.select("x", "t", "bucket", below.alias("below"), above.alias("above")).join(F.broadcast(around), "bucket").where("t = 1")
    near = near.select("x", F.coalesce("below", "earlier").alias("p"), F.coalesce("above", "later").alias("n"))
    line = F.col("p.y") + (F.col("n.y") - F.col("p.y")) * (F.col("x") - F.col("p.x")) / (F.col("n.x") - F.col("p.x"))
    value = (F.when(F.col("p").isNull(), F.col("n.y")).when(F.col("n").isNull() | (F.col("p.x") == F.col("x")) | (F.col("p.y") == F.col("n.y")), F.col("p.y"))
             .otherwise(line))
    told = near.select(F.col("x").alias("_score"), value.alias("_value"))
    return (sized_join(df.withColumn("_score", F.when(~F.isnan(x), x)), told, "_score").withColumnRenamed("_value", out_col).drop("_score"))
