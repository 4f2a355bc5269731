"""Registry of named queries: a Spark builder, the declared output schema and the oracle SQL.

The declared schema is applied to both sides in the same way: counts and flags as BIGINT,
doubles rounded to 6 places (fewer above 1e6, so about 13 significant digits survive and
summation-order noise does not flip a digit) with negative zero folded and NaN as NULL, text as is. So the
Spark result and the DuckDB result of a query can be hashed and compared column by column.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    schema: list  # [(column, 'bigint' | 'double' | 'string')]
    sql: str | None
    ops: tuple = field(default_factory=tuple)  # SURVEY section 2 ids covered


REGISTRY: dict[str, Query] = {}


def parse_schema(text: str) -> list:
    out = []
    for part in text.split(","):
        name, typ = part.strip().rsplit(" ", 1)
        out.append((name.strip(), typ.strip().lower()))
    return out


def register(name: str, schema: str, sql: str | None = None, ops=()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, parse_schema(schema), sql, tuple(ops))
        return fn
    return deco


def _spark_col(name: str, typ: str):
    c = F.col(f"`{name}`")
    if typ == "double":
        d = c.cast("double")
        d = F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)
        a = F.abs(d)
        r = F.when(a >= 1e12, F.round(d, 0)).when(a >= 1e9, F.round(d, 2)).when(a >= 1e6, F.round(d, 4)) \
            .otherwise(F.round(d, 6))
        return (r + F.lit(0.0)).alias(name)
    if typ == "bigint":
        return c.cast("bigint").alias(name)
    return c.cast("string").alias(name)


def _sql_col(name: str, typ: str) -> str:
    q = '"' + name.replace('"', '""') + '"'
    if typ == "double":
        d = f"(CASE WHEN isnan(CAST({q} AS DOUBLE)) THEN NULL ELSE CAST({q} AS DOUBLE) END)"
        r = (f"CASE WHEN abs({d}) >= 1e12 THEN round({d}, 0) WHEN abs({d}) >= 1e9 THEN round({d}, 2) "
             f"WHEN abs({d}) >= 1e6 THEN round({d}, 4) ELSE round({d}, 6) END")
        return f"CAST({r} AS DOUBLE) + CAST(0 AS DOUBLE) AS {q}"
    if typ == "bigint":
        return f"CAST({q} AS BIGINT) AS {q}"
    return f"CAST({q} AS VARCHAR) AS {q}"


def run_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import guard_union_partitioning, release_cached
    release_cached()  # intermediates of the previous query
    guard_union_partitioning(spark)
    qy = REGISTRY[name]
    df = qy.build(spark, sf_dir)
    return df.select(*[_spark_col(n, t) for n, t in qy.schema])


def oracle_text(name: str) -> str | None:
    qy = REGISTRY[name]
    if qy.sql is None:
        return None
    cols = ", ".join(_sql_col(n, t) for n, t in qy.schema)
    return f"SELECT {cols} FROM (\n{qy.sql}\n) AS oracle_q"
