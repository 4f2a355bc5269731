"""The corpus pipeline: stages over ``documents``, each one applying an operator of ``scorekit.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns what it keeps, with the columns of ``docs``; the last
one adds the mix. ``run`` writes every stage's rows to the shared folder and reads them for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.llm import decontam, mixing, quality, simhash, suffix_dedup
from scorekit.llm.common import begin, shared_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.passing(docs, min_words=5, min_total=10, max_base=20, max_covered=0.2, max_longest=100)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies."""
    return simhash.one_of_each(docs, k=3, budget=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 100-byte strings that start earlier; ``n_chars`` follows the text."""
    out = suffix_dedup.remove_repeats(docs, length=100)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), min_tokens=13, min_identity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``mix_size``, ``mix_rate`` and ``mix_copies``."""
    return mixing.mixed(docs, weights=(1, 2, 3), most=3)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
]

ORACLE_SQL = None  # SimHash components and rounding by carried remainders have no SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir))
    return docs
