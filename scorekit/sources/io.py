"""Sources and sinks (IO1-IO9).

Tables are read with an explicit schema when one is given (no inference pass over 100 TB), as CSV
with a header or as Parquet. Prediction sets keep their key; when the file order matters a
``row_no`` column is carried and the writer sorts by it inside one ordered write.
"""

from __future__ import annotations

import json
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import sized_join
from ..session import cut_lineage
from ..spec import TableSpec, q


def read_table(spark: SparkSession, path: str, spec: TableSpec | None = None, schema=None,
               fmt: str | None = None) -> DataFrame:
    """IO1: labelled or unlabelled table; CSV (header) or Parquet by extension or ``fmt``."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    if spec is not None and spec.id_col not in df.columns:
        raise ValueError(f"key column {spec.id_col} missing in {path}")
    return df


def read_in_order(spark: SparkSession, path: str, schema, fmt: str = "csv") -> DataFrame:
    """IO2, U5: a table with ``row_no`` from 0 in the order of its files (by path) and of the rows in them.

    Rows are numbered where they are read: a row's place in its file slice is its number in the task less that of
    the slice's first row, and only the slices, a row for each, are put in order and counted up. No row is shuffled."""
    reader = spark.read.schema(schema)
    raw = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    taken = {c.lower() for c in raw.columns}
    if "row_no" in taken:
        raise ValueError("the table has a column row_no")
    own = raw.select(F.struct(*[F.col(q(c)) for c in raw.columns]).alias("row"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    slices = own.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy("file", "start")) - F.col("n")  # a row for each file slice
    # written, so that no cached slices of an earlier read of the path are taken for these
    numbered = sized_join(own, cut_lineage(slices.select("file", "start", "first", before.alias("before"))), ["file", "start"], "inner")
    return numbered.select("row.*", (F.col("before") + F.col("at") - F.col("first")).alias("row_no"))


def write_bucketed(df: DataFrame, table: str, id_col: str, buckets: int, path: str) -> str:
    """A table stored in ``buckets`` hash buckets of its id, each sorted by it (predictions, out-of-fold scores,
    versions): tables written alike are joined and compared by id without a shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, id_col).sortBy(id_col).option("path", path).format("parquet").saveAsTable(table)
    return table


def write_predictions(df: DataFrame, path: str, id_col: str = "id", label_col: str = "label",
                      order_col: str | None = None, fmt: str = "csv") -> str:
    """IO2: ``(id, label)``; with ``order_col`` the rows are written in that order."""
    extra = [order_col] if order_col and order_col not in (id_col, label_col) else []
    out = df.select(id_col, F.col(label_col).cast("int").alias(label_col), *extra)
    if order_col:
        out = out.orderBy(order_col).drop(*extra)
    w = out.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
    return path


def write_probabilities(df: DataFrame, path: str, id_col: str = "id", prob_col: str = "prob", fmt: str = "parquet") -> str:
    """IO3."""
    out = df.select(id_col, F.col(prob_col).cast("double").alias(prob_col)).write.mode("overwrite")
    (out.option("header", True).csv(path) if fmt == "csv" else out.parquet(path))
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for any cluster store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def load_prediction_sets(spark: SparkSession, entries, id_col: str = "id", label_col: str = "label",
                         min_sets: int = 2, fmt: str = "csv") -> DataFrame:
    """IO4: load several prediction sets into long ``(id, model, ordinal, label)``; missing files are
    skipped; fewer than ``min_sets`` loaded is an error. ``entries``: (path, name[, score])."""
    frames = []
    for i, e in enumerate(entries):
        path, name = e[0], e[1]
        if not path_exists(spark, path):
            continue
        df = read_table(spark, path, fmt=fmt)
        frames.append(df.select(F.col(id_col).alias("id"), F.lit(name).alias("model"), F.lit(i + 1).alias("ordinal"),
                                F.col(label_col).cast("int").alias("label")))
    if len(frames) < min_sets:
        raise ValueError(f"need at least {min_sets} prediction sets, found {len(frames)}")
    return reduce(DataFrame.unionByName, frames)


def write_run(spark: SparkSession, record: dict, path: str) -> str:
    """IO5: run record (params, features, metrics, timestamp) as one JSON row."""
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(record)], 1))
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def _write_json(spark: SparkSession, record: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_model(model, path: str) -> str:
    """IO6: a Spark ML model or pipeline, fitted cleaners and scalers (``FittedColumns``), ``AdaBoostModel``, boosted or
    extra-randomised trees, or the ``(main, meta)`` pair of a ``RoutedModel``. ``load_model`` tells them apart by a header file."""
    from ..operators.boosting import BoostedModel
    from ..operators.clean import FittedColumns
    from ..operators.extratrees import ExtraTreesModel
    from ..operators.models import AdaBoostModel
    spark = SparkSession.active()
    if isinstance(model, FittedColumns):
        head = {"type": "columns", "kind": model.kind, "params": model.params}
        parts = []
    elif isinstance(model, AdaBoostModel):
        head, parts = {"type": "adaboost", "alphas": [a for _, a in model.learners]}, [m for m, _ in model.learners]
    elif isinstance(model, (BoostedModel, ExtraTreesModel)):
        base = {"base": model.base} if isinstance(model, BoostedModel) else {}
        head = {"type": "trees", "names": model.names, "feature_cols": model.feature_cols, "trees": asdict(model.trees)} | base
        parts = []
    elif isinstance(model, tuple):
        head, parts = {"type": "routed", "meta": model[1] is not None}, [m for m in model if m is not None]
    else:
        head, parts = {"type": "ml"}, [model]
    for k, m in enumerate(parts):
        m.write().overwrite().save(f"{path}/part-{k}")
    _write_json(spark, head | {"parts": len(parts)}, f"{path}/head")
    return path


def load_model(path: str):
    """What ``save_model`` wrote."""
    from pyspark.ml.util import DefaultParamsReader
    from ..operators.clean import FittedColumns
    from ..operators.models import AdaBoostModel
    spark = SparkSession.active()
    head = _read_json(spark, f"{path}/head")
    if head["type"] == "columns":
        return FittedColumns(head["kind"], {c: tuple(p) if isinstance(p, list) else p for c, p in head["params"].items()})
    if head["type"] == "trees":
        from ..operators.boosting import BoostedModel
        from ..operators.extratrees import ExtraTreesModel
        from ..operators.trees import PackedTrees
        trees = PackedTrees(**head["trees"])
        if "base" in head:
            return BoostedModel(trees, head["base"], head["names"], head["feature_cols"], [])
        return ExtraTreesModel(trees, head["names"], head["feature_cols"])
    parts = [DefaultParamsReader.loadParamsInstance(f"{path}/part-{k}", spark) for k in range(head["parts"])]
    if head["type"] == "adaboost":
        return AdaBoostModel(list(zip(parts, head["alphas"])))
    if head["type"] == "routed":
        return parts[0], parts[1] if head["meta"] else None
    return parts[0]


def write_oof(oof: DataFrame, path: str) -> str:
    """IO7: long OOF table partitioned by model."""
    oof.write.mode("overwrite").partitionBy("model").parquet(path)
    return path


def load_params(spark: SparkSession, path: str, defaults: dict) -> dict:
    """IO8: parameters from a saved JSON file override the defaults; a missing file keeps them."""
    if not path_exists(spark, path):
        return dict(defaults)
    row = spark.read.json(path).first()
    out = dict(defaults)
    if row is not None:
        out.update({k: v for k, v in row.asDict(recursive=True).items() if v is not None})
    return out


def write_errors(df: DataFrame, path: str, id_col: str, label_col: str, pred_col: str, prob_col: str) -> str:
    """IO9: misclassified rows ``(id, true, predicted, prob)``."""
    err = df.where(F.col(label_col) != F.col(pred_col)).select(
        id_col, F.col(label_col).alias("true_label"), F.col(pred_col).alias("predicted_label"),
        F.col(prob_col).alias("prediction_prob"))
    err.write.mode("overwrite").option("header", True).csv(path)
    return path


def misclassified(df: DataFrame, id_col: str, label_col: str, pred_col: str, prob_col: str) -> DataFrame:
    """IO9 frame before writing."""
    return df.where(F.col(label_col) != F.col(pred_col)).select(
        id_col, F.col(label_col).alias("true_label"), F.col(pred_col).alias("predicted_label"),
        F.col(prob_col).alias("prediction_prob"))
