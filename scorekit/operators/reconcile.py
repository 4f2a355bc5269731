"""Dataset reconciliation (R1-R3): version comparison and prediction-set validation.

Id sets are compared with anti-joins on distinct ids (one shuffle per side). Only counts and a
bounded number of example ids (the smallest, so the report is deterministic) reach the driver,
where the one-row report is assembled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import id_diff

REPORT_SCHEMA = ("table string, old_rows long, old_unique long, new_rows long, new_unique long, "
                 "removed long, removed_examples string, added long, added_examples string")


def _diff_stats(ids: DataFrame, id_col: str, examples: int) -> tuple:
    """Count and the ``examples`` smallest ids (a bounded top-k, never the whole set)."""
    n = ids.count()
    ex = [r[0] for r in ids.select(F.col(id_col)).orderBy(id_col).limit(examples).collect()]
    return n, ",".join(str(x) for x in ex)


def version_report_row(name: str, old: DataFrame, new: DataFrame, id_col: str, examples: int = 5) -> tuple:
    removed, added = id_diff(old, new, id_col)
    o = old.agg(F.count(F.lit(1)), F.countDistinct(id_col)).first()
    n = new.agg(F.count(F.lit(1)), F.countDistinct(id_col)).first()
    r = _diff_stats(removed, id_col, examples)
    a = _diff_stats(added, id_col, examples)
    return (name, o[0], o[1], n[0], n[1], r[0], r[1], a[0], a[1])


def compare_versions(old_tables: dict, new_tables: dict, id_col: str, examples: int = 5) -> DataFrame:
    """One report row per table name present in both versions."""
    rows = [version_report_row(n, old_tables[n], new_tables[n], id_col, examples) for n in old_tables if n in new_tables]
    spark = next(iter(old_tables.values())).sparkSession
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def validate_predictions(preds: DataFrame, required: DataFrame, id_col: str, examples: int = 10) -> DataFrame:
    """R2: required ids missing from the prediction set, extra ids, duplicated ids and a verdict."""
    extra, missing = id_diff(preds, required, id_col)
    m = _diff_stats(missing, id_col, examples)
    e = _diff_stats(extra, id_col, examples)
    dup = preds.groupBy(id_col).count().where(F.col("count") > 1).count()
    verdict = "ok" if m[0] == 0 and e[0] == 0 and dup == 0 else "changed"
    spark = preds.sparkSession
    return spark.createDataFrame([(m[0], m[1], e[0], e[1], dup, verdict)],
                                 "missing long, missing_examples string, extra long, extra_examples string, "
                                 "duplicated long, verdict string")


def id_differences(old: DataFrame, new: DataFrame, id_col: str) -> DataFrame:
    """J6 as a table: every id in exactly one version, with the side it is on."""
    removed, added = id_diff(old, new, id_col)
    return reduce(DataFrame.unionByName, [removed.withColumn("change", F.lit("removed")),
                                          added.withColumn("change", F.lit("added"))])
