"""Keyed joins (J1-J6, J9) and set operations.

Rows have no position in Spark: every alignment of predictions, folds or labels is an equi-join
on the row id. Lookup tables that are aggregates of the data (group statistics, per-value
encodings) are broadcast only after measuring them; above the limit the join shuffles normally.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BROADCAST_MAX_BYTES, keep
from ..spec import q


def side_bytes(df: DataFrame) -> int:
    """Measured size of a frame: 16 bytes for each value and the length of every text."""
    texts = [F.coalesce(F.octet_length(F.col(q(f.name))), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    total = F.sum(reduce(lambda a, b: a + b, texts, F.lit(16 * len(df.columns))).cast("bigint"))
    return df.agg(total).first()[0] or 0


def sized_join(big: DataFrame, small: DataFrame, on, how: str = "left", max_bytes: int | None = None) -> DataFrame:
    """Join with a broadcast of ``small`` when its measured size is within the limit; beyond it a shuffle
    join, whose large partitions AQE splits. The small side is cached before it is measured, so it is
    computed once."""
    small = keep(small)
    side = F.broadcast(small) if side_bytes(small) <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes) else small
    return big.join(side, on, how)


def assert_unique(df: DataFrame, key: str) -> None:
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"duplicate values in key {key}")


def left_attach(ids: DataFrame, preds: DataFrame, id_col: str, check_unique: bool = True) -> DataFrame:
    """Keep every required id; null where no prediction exists."""
    if check_unique:
        assert_unique(preds, id_col)
    return ids.join(preds, id_col, "left")


def join_predictions(a: DataFrame, b: DataFrame, id_col: str, a_col: str, b_col: str,
                     a_name: str = "a", b_name: str = "b") -> DataFrame:
    """Inner join of two prediction sets on the id as text, value columns renamed."""
    return (a.select(F.col(id_col).cast("string").alias(id_col), F.col(a_col).alias(a_name))
            .join(b.select(F.col(id_col).cast("string").alias(id_col), F.col(b_col).alias(b_name)), id_col, "inner"))


def merge_scores(score_tables: dict) -> DataFrame:
    """Feature-score tables ``(feature, score)`` by method -> one row per feature (inner)."""
    frames = [df.select("feature", F.col("score").alias(name)) for name, df in score_tables.items()]
    return reduce(lambda x, y: x.join(y, "feature", "inner"), frames)


def lookup_stats(df: DataFrame, stats: DataFrame, keys, defaults: dict) -> DataFrame:
    """Attach group statistics by key, default for unseen keys."""
    j = sized_join(df, stats, list(keys), "left")
    return j.select(*[F.col(c) for c in df.columns],
                    *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])


def attach_oof(df: DataFrame, oof: DataFrame, id_col: str) -> DataFrame:
    """Re-attach out-of-fold predictions by id (never by position)."""
    return df.join(oof, id_col, "left")


def attach_labels(df: DataFrame, preds: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Give unlabelled rows the label of a prediction set (left join by id)."""
    return df.join(preds.select(id_col, F.col("label").alias(label_col)), id_col, "left")


def id_diff(old: DataFrame, new: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Ids removed (in old only) and added (in new only), each distinct."""
    o = old.select(id_col).distinct()
    n = new.select(id_col).distinct()
    return o.join(n, id_col, "left_anti"), n.join(o, id_col, "left_anti")


# --- set operations (U1-U5) --------------------------------------------------------------

def append(frames) -> DataFrame:
    """Union by column name, missing columns as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_with_origin(a: DataFrame, b: DataFrame, origin_col: str = "origin") -> DataFrame:
    """Rows of ``a`` get origin 0, rows of ``b`` origin 1."""
    return append([a.withColumn(origin_col, F.lit(0)), b.withColumn(origin_col, F.lit(1))])


def id_subtract(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """U3."""
    return a.select(id_col).distinct().join(b.select(id_col).distinct(), id_col, "left_anti")


def check_same_ids(frames: dict, id_col: str, order_col: str | None = None) -> DataFrame:
    """Per frame: rows, ids missing against the first frame, extra ids and, with an order
    column, ids whose position differs. Reports instead of stopping the job; one full outer
    join per frame, keyed by id."""
    names = list(frames)
    pos = [F.col(order_col)] if order_col else [F.lit(0)]
    base = frames[names[0]].select(id_col, pos[0].alias("_pos0"), F.lit(1).alias("_in0"))
    out = []
    for name in names:
        f = frames[name].select(id_col, pos[0].alias("_pos"), F.lit(1).alias("_in"))
        j = base.join(f, id_col, "full_outer")
        out.append(j.agg(F.lit(name).alias("name"),
                         F.count_if(F.col("_in").isNotNull()).alias("rows"),
                         F.count_if(F.col("_in").isNull()).alias("missing"),
                         F.count_if(F.col("_in0").isNull()).alias("extra"),
                         F.count_if(F.col("_in0").isNotNull() & F.col("_in").isNotNull()
                                    & (F.col("_pos") != F.col("_pos0"))).alias("moved")))
    return reduce(DataFrame.unionByName, out)
