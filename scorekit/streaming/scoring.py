"""Scoring a stream with fitted, stateless stages.

The reference has no streaming code. What carries over is that every fitted stage here (medians,
bounds, bins, encoders, feature packs with fitted constants, Spark ML models) is a projection or a
broadcast lookup, so a batch-fitted chain applies to a streaming DataFrame unchanged. The query's
checkpoint lives under the session's ``spark.checkpoint.dir`` (a shared folder on a cluster), so a
restarted or rescheduled query resumes exactly once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def apply_chain(df: DataFrame, stages) -> DataFrame:
    """Apply ``stages`` (callables DataFrame -> DataFrame) in order; works on batch or stream."""
    return reduce(lambda acc, fn: fn(acc), stages, df)


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = 1) -> DataFrame:
    """File source: new files of ``path`` as micro-batches (explicit schema, no inference)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(path)


def start_scoring(stream: DataFrame, stages, sink_path: str, name: str, fmt: str = "parquet",
                  checkpoint: str | None = None, trigger_once: bool = False):
    """Score the stream with the fitted chain and append the result to ``sink_path``."""
    spark = stream.sparkSession
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    scored = apply_chain(stream, stages)
    w = scored.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", ckpt) \
        .outputMode("append").queryName(name)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def start_memory_scoring(stream: DataFrame, stages, name: str, checkpoint: str | None = None):
    """Same chain into an in-memory table (tests and notebooks)."""
    spark = stream.sparkSession
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    scored = apply_chain(stream, stages)
    return scored.writeStream.format("memory").queryName(name).option("checkpointLocation", ckpt) \
        .outputMode("append").start()
