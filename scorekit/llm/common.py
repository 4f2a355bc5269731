"""Helpers of the llm operators: text access in Arrow batches, written tables, connected components."""

from __future__ import annotations

import gc
import math
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import side_bytes
from ..session import BROADCAST_MAX_BYTES, ensure_checkpoint_dir, guard_union_partitioning
from ..spec import q

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % m


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def bytes_of(batch: pa.RecordBatch, name: str = "text") -> list:
    """UTF-8 bytes of a string column, null as empty."""
    arr = batch.column(batch.schema.get_field_index(name))
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    return [v or b"" for v in arr.cast(pa.large_binary() if wide else pa.binary()).to_pylist()]


def word_pieces(text: bytes, size: int = 1 << 20):
    """Lists of the words of a text, in order; a long text comes in pieces of about ``size`` bytes
    cut between words, so memory does not grow with it. Whitespace is 0x20 and 0x09-0x0D."""
    if len(text) <= size:
        yield text.split()
        return
    at, rest = 0, b""
    while at < len(text):
        part = rest + text[at:at + size]
        at += size
        words = part.split()
        rest = b""
        if at < len(text) and words and not part[-1:].isspace():
            rest = words.pop()
        yield words
    if rest:
        yield rest.split()


def shared_table(df: DataFrame, rows: int | None = None, per_file: int = 250_000) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back: cuts the
    lineage, and a lost executor loses nothing. A small table of a known number of ``rows`` is written as
    a file for each ``per_file`` of them, not as one for each shuffle partition."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(1, math.ceil(rows / per_file)))
    df.write.parquet(path)
    settle(spark)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished stages: it does so when the driver
    collects its garbage, which on a small driver heap may be long after the stage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)


BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, "8m"


def begin(spark: SparkSession) -> None:
    """Session settings the operators rely on. A batch of texts exists several times over (in the JVM's
    writer, in Arrow, as Python bytes, as arrays), so batches are cut at 8 MB unless the session has a
    limit of its own."""
    ensure_checkpoint_dir(spark)
    guard_union_partitioning(spark)
    if spark.conf.get(BATCH_KEY, None) in (None, str(BATCH_DEFAULT), f"{BATCH_DEFAULT}b"):
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def fresh(df: DataFrame, *names: str) -> list:
    """Names that no column of ``df`` has, in any case: the given ones, with underscores put before where they are taken."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def columns(df: DataFrame) -> list:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col(q(c)) for c in df.columns]


def bounded(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """A side of a join, to be broadcast if its measured size is within the limit; else as it is, for a shuffle join."""
    return F.broadcast(df) if side_bytes(df) <= max_bytes else df


def spread(blocks: DataFrame, size: float, per_task: int = 128 << 20) -> DataFrame:
    """Packed blocks dealt by ``block`` to a stated number of tasks: the session's, or more where a task
    would hold over ``per_task`` of unpacked bytes. A block is small on disk and long in work, so the
    number must not be left to the coalescing of small partitions."""
    n = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / per_task))
    return blocks.repartition(n, "block")


def hook(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Union edges (u, v) into the flat min-root forest ``parent``, in place."""
    while len(u):
        ru, rv = parent[u], parent[v]
        m = ru != rv
        if not m.any():
            return
        u, v, ru, rv = u[m], v[m], ru[m], rv[m]
        np.minimum.at(parent, np.maximum(ru, rv), np.minimum(ru, rv))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``(u, v)`` long edges as ``(node, root)``, root the smallest node.

    Alternating large-star and small-star rounds: each is one aggregate and one join on the node,
    and no neighbour list is ever gathered in one place. Every round is a written table."""
    cur = shared_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    if cur.isEmpty():
        return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        cur = shared_table(small.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        mark = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
