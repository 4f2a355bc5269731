"""Exact global order without a single-partition window (W1-W4) and sort/limit helpers.

W1 is the shared primitive behind ROC/AUC, average precision, folds and rank lookups:

1. cut the order key into value buckets from approximate quantiles (bounded number of cuts,
   one cut list per partition group, so every group is split by its own distribution);
   equal keys always land in the same bucket, so ties are never split;
2. total every bucket (``groupBy(part, bucket)``: at most |part| x buckets rows);
3. running offsets over that small table, joined back (broadcast only after its size is counted);
4. a window per ``(part, bucket)`` adds the in-bucket running sum to the offset.

Callers pass data whose order keys are distinct within a partition (aggregate equal scores
first) or a tie-break column list, so a hot value is a single row and no bucket is skewed.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES, keep
from .joins import sized_join

_ROWS_PER_BUCKET = [2_000_000]
_CUTS_AT_ONCE = 256
_RANKED_ROWS = 125_000


@contextmanager
def bucket_rows(n: int):
    """Rows per bucket for the plans built inside: small buckets take the path of large data."""
    _ROWS_PER_BUCKET.append(n)
    try:
        yield
    finally:
        _ROWS_PER_BUCKET.pop()


def session_bucket_rows() -> int:
    """Rows per bucket outside or inside ``bucket_rows``."""
    return _ROWS_PER_BUCKET[-1]


def _bucket_count(n: int, rows_per_bucket: int | None) -> int:
    """As many buckets as the rows need."""
    return max(1, math.ceil(n / max(1, rows_per_bucket or _ROWS_PER_BUCKET[-1])))


def add_value_bucket(df: DataFrame, key_col: str, out_col: str, n_rows: int | None = None,
                     rows_per_bucket: int | None = None) -> DataFrame:
    """Add a monotone bucket index of ``key_col`` (double) with balanced bucket sizes (global cuts)."""
    if n_rows is None:
        n_rows = df.count()
    nb = _bucket_count(n_rows, rows_per_bucket)
    if nb <= 1:
        return df.withColumn(out_col, F.lit(0.0))
    probs = [i / nb for i in range(1, nb)]
    cuts = df.approxQuantile(key_col, probs, 0.25 / nb)
    return _bucketize(df, key_col, out_col, _splits(cuts))


def _splits(cuts) -> list[float]:
    inner = sorted({c for c in cuts if c is not None and not math.isnan(c) and math.isfinite(c)})
    return [-math.inf] + inner + [math.inf]


def _bucketize(df: DataFrame, key_col: str, out_col: str, splits) -> DataFrame:
    """Bucket index (``Bucketizer``: a binary search in the JVM per row); nulls go to the last bucket."""
    tmp = out_col + "__in"
    bz = Bucketizer(splits=splits, inputCol=tmp, outputCol=out_col, handleInvalid="keep")
    return bz.transform(df.withColumn(tmp, F.coalesce(F.col(key_col), F.lit(float("nan"))))).drop(tmp)


def add_group_value_bucket(df: DataFrame, key_col: str, out_col: str, part_cols, rows_per_bucket: int | None = None,
                           group_sizes: DataFrame | None = None) -> tuple:
    """Bucket index with cut points per ``part_cols`` group, so a group whose values sit inside one
    global bucket (a feature with a small range next to one with a large range) is still split.

    The cuts are a small table, one row of sorted cut points for each group that needs more than one
    bucket; it is joined on the group, and a row's bucket is found by bisection of its group's cuts.
    Many buckets are cut in levels, each bucket of one level by cuts of its own in the next, so that a row
    meets some hundred cuts however many buckets there are. There is no limit on the number of groups. ``group_sizes`` (the partition columns and ``_n``) saves
    the counting job when the caller has it. Returns ``(frame, most buckets of a group)``."""
    part_cols = list(part_cols)
    sizes = group_sizes if group_sizes is not None else df.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("_n"))
    rows = _ROWS_PER_BUCKET[-1] if rows_per_bucket is None else max(1, rows_per_bucket)
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    nb = _bucket_count(largest, rows)
    if nb <= 1:
        return df.withColumn(out_col, F.lit(0.0)), 1
    names = [f"_gk{i}" for i in range(len(part_cols))]
    big = sizes.where(F.col("_n") > rows).select(*[F.col(p).alias(n) for p, n in zip(part_cols, names)])
    big = F.broadcast(big) if big.count() * len(names) * 64 <= 1 << 20 else big
    on = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(n)) for p, n in zip(part_cols, names)])
    # every row carries its cuts through the join, so they stay few: many buckets are found level by level
    levels = next(k for k in range(1, 64) if _CUTS_AT_ONCE ** k >= nb)
    fan = next(f for f in range(2, nb + 1) if f ** levels >= nb)
    acc = max(10_000, 4 * fan)
    probs = [i / fan for i in range(1, fan)]
    work = df.withColumn(out_col, F.lit(0.0))
    for _ in range(levels):
        # approximate quantiles of the large buckets so far in one grouped pass
        cuts = (work.join(big, on).groupBy(*names, F.col(out_col).alias("_gat"))
                .agg(F.count(F.lit(1)).alias("_gn"), F.array_distinct(F.percentile_approx(F.col(key_col), probs, acc)).alias("_cuts"))
                .where(F.col("_gn") > rows).drop("_gn"))
        width = 2 * (len(names) + 2)  # an array counts as one value where a side is measured
        both = sized_join(work, cuts, on & (F.col(out_col) == F.col("_gat")), max_bytes=BROADCAST_MAX_BYTES * width // (width + fan))
        at = F.col(out_col) * fan + _bisect(F.col("_cuts"), F.col(key_col), fan)
        work = both.withColumn(out_col, at).drop("_cuts", "_gat", *names)
    return work, nb


def _bisect(cuts: Column, key: Column, most: int) -> Column:
    """Number of sorted ``cuts`` at or below ``key``: one fixed step for each power of two up to ``most``.
    0 without cuts; a null key goes behind the last cut."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, most.bit_length())))])
    size = F.size(cuts)
    at = F.aggregate(steps, F.lit(0), lambda lo, s: F.when((lo + s <= size) & (F.get(cuts, lo + s - 1) <= key), lo + s).otherwise(lo))
    return F.when(cuts.isNull(), 0.0).when(key.isNull(), size.cast("double")).otherwise(at.cast("double"))


def prefix_sum(df: DataFrame, order_col: str, value_cols, part_cols=(), tie_cols=(),
               descending: bool = False, inclusive: bool = True, prefix: str = "cum_",
               rows_per_bucket: int | None = None, persist: bool = True, n_rows: int | None = None,
               group_sizes: DataFrame | None = None) -> DataFrame:
    """Running sums of ``value_cols`` in ``order_col`` order (then ``tie_cols``), per ``part_cols``.

    Output: the input columns plus ``prefix + v`` for every value column. ``inclusive`` counts the
    row itself. ``order_col`` must be numeric. Without partition columns a caller that knows the
    row count passes ``n_rows`` and saves the counting job. With partition columns every group
    gets its own cut points. The input is persisted only when it is read again.
    """
    value_cols = list(value_cols)
    part_cols = list(part_cols)
    key = F.col(order_col).cast("double")
    work = df.withColumn("_w1_key", -key if descending else key)
    if part_cols:
        if persist:
            work = keep(work)
        work, nb = add_group_value_bucket(work, "_w1_key", "_w1_b", part_cols, rows_per_bucket, group_sizes)
    else:
        if n_rows is None:
            if persist:
                work = keep(work)
            n_rows = work.count()
        nb = _bucket_count(n_rows, rows_per_bucket)
        if nb > 1 and persist and not work.is_cached:
            work = keep(work)
        work = add_value_bucket(work, "_w1_key", "_w1_b", n_rows, rows_per_bucket)
    w = (Window.partitionBy(*part_cols, "_w1_b")
         .orderBy(F.col("_w1_key").asc_nulls_last(), *[F.col(c).asc() for c in tie_cols])
         .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    if nb <= 1:
        # one bucket per group: offsets are zero, the window per partition key is the whole answer
        return work.select(*df.columns, *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(prefix + v)
                                          for v in value_cols])
    totals = work.groupBy(*part_cols, "_w1_b").agg(*[F.sum(v).alias(v) for v in value_cols])
    wt = Window.partitionBy(*part_cols).orderBy("_w1_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part_cols, "_w1_b",
                            *[F.coalesce(F.sum(v).over(wt), F.lit(0)).alias("_w1_off_" + v)
                              for v in value_cols])
    on = None
    offsets = offsets.select(*[F.col(c).alias(f"_off{i}") for i, c in enumerate([*part_cols, "_w1_b"])],
                             *[f"_w1_off_{v}" for v in value_cols])
    for i, c in enumerate([*part_cols, "_w1_b"]):  # groups may be null
        e = F.col(c).eqNullSafe(F.col(f"_off{i}"))
        on = e if on is None else on & e
    joined = sized_join(work, offsets, on)
    outs = []
    for v in value_cols:
        run = F.coalesce(F.sum(v).over(w), F.lit(0))
        outs.append((F.coalesce(F.col("_w1_off_" + v), F.lit(0)) + run).alias(prefix + v))
    return joined.select(*df.columns, *outs)


def hash_key(id_col: str, seed) -> tuple[Column, Column]:
    """Fold basis: ``md5(seed ':' id)`` (same text in DuckDB) and its first 52 bits as a double."""
    digest = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(id_col).cast("string")))
    num = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return digest, num


def hash_rank(df: DataFrame, id_col: str, seed, by=(), out_col: str = "rank") -> DataFrame:
    """1-based row number inside ``by`` in the order of ``md5(seed:id)``, ties by id.

    Models are fitted on the ranked rows as they lie, a bucket in one task: a bucket has 125,000 rows, or the
    session-wide size where that is smaller, so that two classes do not leave all rows to a few tasks."""
    digest, num = hash_key(id_col, seed)
    work = df.withColumn("_h_md5", digest).withColumn("_h_num", num).withColumn("_h_one", F.lit(1))
    ranked = prefix_sum(work, "_h_num", ["_h_one"], part_cols=by, tie_cols=["_h_md5", id_col],
                        rows_per_bucket=min(_RANKED_ROWS, session_bucket_rows()))
    return ranked.withColumnRenamed("cum__h_one", out_col).drop("_h_md5", "_h_num", "_h_one")


def global_rank(df: DataFrame, score_col: str, id_col: str, descending: bool = True,
                out_col: str = "rank") -> DataFrame:
    """Exact 1-based rank by score (desc by default), ties broken by id ascending."""
    work = df.withColumn("_r_one", F.lit(1))
    ranked = prefix_sum(work, score_col, ["_r_one"], tie_cols=[id_col], descending=descending)
    return ranked.withColumnRenamed("cum__r_one", out_col).drop("_r_one")


def top_k(df: DataFrame, score_col: str, id_col: str, k: int, small_k: int = 100_000) -> DataFrame:
    """The k highest scores, ties by id. Small k runs as TakeOrderedAndProject."""
    if k <= small_k:
        return df.orderBy(F.col(score_col).desc_nulls_last(), F.col(id_col).asc()).limit(k)
    return global_rank(df, score_col, id_col).filter(F.col("rank") <= k).drop("rank")


def neighbour_window(df: DataFrame, value_col: str, by, k: int, order_cols=()) -> DataFrame:
    """Values of the k preceding and k following rows in ``by`` order."""
    w = Window.partitionBy(*by).orderBy(F.col(value_col), *[F.col(c) for c in order_cols])
    cols = []
    for i in range(1, k + 1):
        cols.append(F.lag(value_col, i).over(w).alias(f"prev_{i}"))
        cols.append(F.lead(value_col, i).over(w).alias(f"next_{i}"))
    return df.select("*", *cols)


# --- sort / limit (L1-L7) ---------------------------------------------------------------

def rank_head(df: DataFrame, col: str, n: int, tie_col: str | None = None) -> DataFrame:
    """L1/L2: sort by ``col`` descending, first n (TakeOrderedAndProject)."""
    order = [F.col(col).desc_nulls_last()] + ([F.col(tie_col).asc()] if tie_col else [])
    return df.orderBy(*order).limit(n)


def nlargest(df: DataFrame, col: str, n: int, tie_col: str | None = None) -> DataFrame:
    return rank_head(df, col, n, tie_col)


def nsmallest(df: DataFrame, col: str, n: int, tie_col: str | None = None) -> DataFrame:
    order = [F.col(col).asc_nulls_last()] + ([F.col(tie_col).asc()] if tie_col else [])
    return df.orderBy(*order).limit(n)


def sort_abs(df: DataFrame, col: str, descending: bool = True, tie_col: str | None = None) -> DataFrame:
    """L3: order by absolute value."""
    a = F.abs(F.col(col))
    order = [a.desc_nulls_last() if descending else a.asc_nulls_last()]
    return df.orderBy(*order, *([F.col(tie_col)] if tie_col else []))


def order_ids(df: DataFrame, id_col: str) -> DataFrame:
    """L4: numeric order when the id casts to a number, text order otherwise (numbers first)."""
    num = F.col(id_col).cast("string").try_cast("long")
    return df.orderBy(num.asc_nulls_last(), F.col(id_col).cast("string"))


def unique_in_order(names, cap: int | None = None) -> list:
    """Order-preserving de-duplication of a (driver-side, small) name list."""
    out = list(dict.fromkeys(names))
    return out if cap is None else out[:cap]


def argmax_row(df: DataFrame, col: str, *tie_cols: str) -> DataFrame:
    """The row with the largest ``col``; on ties the smallest ``tie_cols`` (first listed)."""
    return df.orderBy(F.col(col).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_cols]).limit(1)


def preview(df: DataFrame, n: int, order_col: str) -> DataFrame:
    """First n rows in key order."""
    return df.orderBy(F.col(order_col)).limit(n)
