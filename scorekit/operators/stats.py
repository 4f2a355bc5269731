"""Shared statistics building blocks: long (unpivoted) form and exact distributed quantiles.

``exact_quantiles`` never gathers a column into one buffer (Spark's ``percentile`` does): a sketch encloses the
wanted order statistics, only what lies inside the enclosures is counted value by value, and
the bucketed prefix sum of ``order.prefix_sum`` per ``(group, feature)`` gives exact ranks
(linear interpolation, as ``numpy.quantile`` / pandas / DuckDB ``quantile_cont``). A value that
holds a third of all rows is one row after the aggregation, so it cannot skew a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES
from ..session import keep as keep_cached
from ..spec import q
from .joins import side_bytes
from .order import prefix_sum


def to_long(df: DataFrame, cols, keep=(), feature_col: str = "feature", value_col: str = "value",
            drop_nulls: bool = True) -> DataFrame:
    """Unpivot ``cols`` (cast to double, NaN and +-inf to null) into ``(keep..., feature, value)``."""
    cols = list(cols)
    keep = list(keep)
    casted = df.select(*[F.col(q(k)) for k in keep], *[clean_double(F.col(q(c))).alias(c) for c in cols])
    out = casted.unpivot([F.col(q(k)) for k in keep], [F.col(q(c)) for c in cols], feature_col, value_col)
    return out.where(F.col(value_col).isNotNull()) if drop_nulls else out


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as the session has cores, where its input has fewer than half (one
    file of one row group): for operators whose work per row far exceeds the cost of moving it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() < cores else df


def clean_double(c):
    """Cast to double; NaN and +-infinity become null (the library is NULL-only)."""
    d = c.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(d)


def exact_quantiles(df: DataFrame, cols, probs, by=(), long_input: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Exact linear-interpolation quantiles, by selection.

    Returns ``(by..., feature, prob, value)``; nulls are ignored; a feature without values gives
    no row. With ``long_input`` the frame already is ``(by..., feature, value)``.

    A first pass sketches, per (group, feature), two values that enclose each wanted order statistic. A second one counts the rows
    between the enclosures, where only their number and least value matter, and the distinct values inside them, a
    share of about 4 / ``accuracy`` of the rows for each probability. The ranks are then exact by a prefix sum over those few
    rows. Where a sketch has missed (its error is bounded, not its enclosure) the group's values are all counted."""
    by = list(by)
    probs = [float(p) for p in probs]
    longf = df if long_input else to_long(df, cols, keep=by)
    part = by + ["feature"]
    edges = [min(1.0, max(0.0, p + d / accuracy)) for p in probs for d in (-2, 2)]
    sketch = keep_cached(longf.groupBy(*part).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", edges, accuracy).alias("e")))
    value, e = F.col("value"), F.col("e")
    inside = reduce(lambda a, b: a | b, [(value >= e[2 * j]) & (value <= e[2 * j + 1]) for j in range(len(probs))])
    above = reduce(lambda a, b: a + b, [(value > e[j]).cast("int") for j in range(len(edges))])
    side = F.broadcast(sketch) if side_bytes(sketch) * len(edges) <= BROADCAST_MAX_BYTES else sketch
    cells = (longf.join(side, part).groupBy(*part, above.alias("gap"), F.when(inside, value).alias("at"))
             .agg(F.count(F.lit(1)).alias("cnt"), F.min("value").alias("least")))
    cum = prefix_sum(cells, "least", ["cnt"], part_cols=part)  # cum_cnt inclusive
    need = _order_statistics(sketch, part, probs)
    hit = (cum.join(F.broadcast(need) if side_bytes(sketch) * 4 * len(probs) <= BROADCAST_MAX_BYTES else need, part)
           .where((F.col("cum_cnt") - F.col("cnt") <= F.col("k")) & (F.col("k") < F.col("cum_cnt"))))
    # of the rows between two enclosures only the first is known
    known = F.when(F.col("at").isNotNull() | (F.col("k") == F.col("cum_cnt") - F.col("cnt")), F.col("least"))
    found = keep_cached(_interpolated(hit, part, known))
    missed = found.where(F.col("value").isNull()).select(*part).distinct()
    if missed.isEmpty():
        return found
    again = quantiles_by_counts(longf.join(missed, part, "left_semi"), part, probs)
    return found.join(missed, part, "left_anti").unionByName(again)


def _order_statistics(totals: DataFrame, part, probs) -> DataFrame:
    """Both order statistics of every target: ``(part..., pi, prob, h, k_lo, k, hi)`` from ``totals(part..., n)``.
    Ranks needed per probability: h = (n-1) q ; lo = floor(h) ; hi = lo + 1 (0-based)."""
    parr = F.array(*[F.lit(p) for p in probs])
    targets = (totals.select(*part, "n", F.posexplode(parr).alias("pi", "prob"))
               .withColumn("h", (F.col("n") - 1) * F.col("prob"))
               .withColumn("k_lo", F.floor("h").cast("long"))
               .withColumn("k_hi", F.least(F.col("k_lo") + 1, F.col("n") - 1)))
    need = targets.select(*part, "pi", "prob", "h", "k_lo",
                          F.explode(F.array(F.struct(F.col("k_lo").alias("k"), F.lit(0).alias("hi")),
                                            F.struct(F.col("k_hi").alias("k"), F.lit(1).alias("hi")))).alias("_r"))
    return need.select(*part, "pi", "prob", "h", "k_lo", F.col("_r.k").alias("k"), F.col("_r.hi").alias("hi"))


def _interpolated(hit: DataFrame, part, value) -> DataFrame:
    """``(part..., prob, value)`` between the two order statistics of every target; null where one is not known."""
    return (hit.groupBy(*part, "pi", "prob", "h", "k_lo")
            .agg(F.max(F.when(F.col("hi") == 0, value)).alias("v_lo"),
                 F.max(F.when(F.col("hi") == 1, value)).alias("v_hi"))
            .select(*part, "prob",
                    (F.col("v_lo") + (F.col("h") - F.col("k_lo")) * (F.col("v_hi") - F.col("v_lo"))).alias("value")))


def quantiles_by_counts(longf: DataFrame, part, probs) -> DataFrame:
    """Exact quantiles of ``(part..., value)`` from the counts of all distinct values."""
    counts = keep_cached(longf.groupBy(*part, "value").agg(F.count(F.lit(1)).alias("cnt")))
    totals = keep_cached(counts.groupBy(*part).agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("nd")))
    # distinct values per (group, feature) are the prefix sum's group sizes
    cum = prefix_sum(counts, "value", ["cnt"], part_cols=part, group_sizes=totals.select(*part, F.col("nd").alias("_n")))
    need = _order_statistics(totals, part, probs)
    side = F.broadcast(need) if side_bytes(totals) * 2 * len(probs) <= BROADCAST_MAX_BYTES else need
    # value of order statistic k: the distinct value with cum - cnt <= k < cum
    hit = (cum.join(side, part, "inner")
           .where((F.col("cum_cnt") - F.col("cnt") <= F.col("k")) & (F.col("k") < F.col("cum_cnt"))))
    return _interpolated(hit, part, F.col("value"))
