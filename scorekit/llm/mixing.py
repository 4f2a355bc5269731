"""Mixing sources to target weights by entropy balancing.

Every document gets a rate r, how often its words shall be taken. Among all rates that meet the token
targets of their sources, entropy balancing takes those closest to 1 in relative entropy, a document
weighing ``b = size + m`` (its words and those of an average document of its source), with r at most
``most``. The convex dual has one multiplier for each source, and its solution is the exponential tilt

    r = min(most, exp(multiplier * size / b)),   sum of size * r over the source = target.

Newton iterations solve the dual for all sources at once: one Spark job each, over the counts of
documents by (source, size), so a hot source is split by size and pre-aggregated. Rates are then rounded
down or up to whole copies, largest documents first, the remainder carried from one document to the next;
what is left at the end goes to a few small documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, begin, columns, fresh, shared_table

WEIGHTS = (1, 2, 3)
MIX_COLUMNS = ("mix_size", "mix_rate", "mix_copies")


def ranked(names: DataFrame, col: str) -> DataFrame:
    """Adds ``rank`` from 0 in order of ``col``, a distinct text column, null last: range partitions are
    ranked alone and shifted by the sizes of those before; no task sees all rows."""
    have = shared_table(names.where(F.col(col).isNotNull()).repartitionByRange(F.col(col)).withColumn("_part", F.spark_partition_id()))
    sizes = sorted(have.groupBy("_part").count().collect())  # one row for each partition
    before, pairs = 0, []
    for part, n in sizes:
        pairs += [F.lit(part), F.lit(before)]
        before += n
    shift = F.create_map(*pairs)[F.col("_part")] if pairs else F.lit(0)
    place = F.row_number().over(W.partitionBy("_part").orderBy(col)) - 1 + shift
    rest = names.where(F.col(col).isNull()).withColumn("rank", F.lit(before).cast("bigint"))
    return have.withColumn("rank", place.cast("bigint")).drop("_part").unionByName(rest)


def targets(sources: DataFrame, weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """``sources(source, words, ...)`` with ``target``: shares of all words by weight, in code-point order
    of the source, null last; a target stops at ``most`` times the source's words, and the excess goes to
    the others by weight until none is above."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = shared_table(ranked(sources, "source").withColumn("_w", w).withColumn("_top", most * F.col("words")))
    total, level, stopped = None, None, -1
    while True:  # each round stops at least one more source
        full = F.lit(False) if level is None else F.col("_top") <= F.col("_w") * level
        row = s.agg(F.sum("words").alias("all"), F.sum(F.when(~full, F.col("_w"))).alias("w"), F.sum(F.when(full, F.col("_top"))).alias("top"),
                    F.count_if(full).alias("n")).first()
        total = float(row["all"] or 0)
        if row["n"] == stopped or not row["w"]:
            break
        stopped, level = row["n"], (total - (row["top"] or 0.0)) / row["w"]
    return s.withColumn("target", F.least(F.col("_top"), F.col("_w") * F.lit(level or 0.0))).drop("_w", "_top")


def balance(hist: DataFrame, sources: DataFrame, most: float = 3.0, tolerance: float = 1e-7, max_rounds: int = 60) -> DataFrame:
    """The multiplier ``mult`` of every source: Newton on the dual, kept inside a bracket.

    ``hist(rank, size, n)`` counts documents; ``sources`` has rank, words, docs (those with words), least
    (their smallest size) and target. Sources without words, or at ``most`` times their words, need none."""
    ratio = F.col("target") / F.col("words")
    x_least = F.col("least") / (F.col("least") + F.col("words") / F.col("docs"))
    lo, hi = F.least(F.log(ratio), F.log(ratio) / x_least), F.greatest(F.log(ratio), F.log(ratio) / x_least)
    free = (F.col("words") > 0) & (F.col("target") > 0) & (ratio < most * (1 - 1e-12))
    n_free = sources.where(free).count()
    state = shared_table(sources.where(free).select("rank", "target", (F.col("words") / F.col("docs")).alias("m"), lo.alias("lo"),
                                                    hi.alias("hi"), F.log(ratio).alias("mult")), n_free)
    small = hist.where("size > 0")
    for _ in range(max_rounds):
        x = F.col("size") / (F.col("size") + F.col("m"))
        tilt = F.exp(F.least(F.col("mult") * x, F.lit(50.0)))
        words = F.col("n") * F.col("size")
        got = (small.join(state, "rank").groupBy("rank", "target", "m", "lo", "hi", "mult")
               .agg(F.sum(words * F.least(tilt, F.lit(most))).alias("got"), F.sum(F.when(tilt < most, words * x * tilt).otherwise(0.0)).alias("slope")))
        high = F.col("got") > F.col("target")
        lo, hi = F.when(high, F.col("lo")).otherwise(F.col("mult")), F.when(high, F.col("mult")).otherwise(F.col("hi"))
        step = F.col("mult") - (F.col("got") - F.col("target")) / F.greatest(F.col("slope"), F.lit(1e-300))
        step = F.when((step >= F.col("_lo")) & (step <= F.col("_hi")), step).otherwise((F.col("_lo") + F.col("_hi")) / 2)
        off = F.abs(F.col("got") / F.col("target") - 1)
        got = got.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("off", off)
        state = shared_table(got.select("rank", "target", "m", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"),
                                        F.when(F.col("off") <= tolerance, F.col("mult")).otherwise(step).alias("mult"), "off"), n_free)
        worst = state.agg(F.max("off")).first()[0]
        state = state.drop("off")
        if worst is None or worst <= tolerance:
            return state.select("rank", "m", F.round("mult", 9).alias("mult"))  # sums in another order move the last bits
    raise RuntimeError("entropy balancing did not settle")


def round_copies(size: np.ndarray, times: np.ndarray, rate: np.ndarray, tie: np.ndarray, most: int = 3) -> np.ndarray:
    """Copies of each unit (``times`` equal rows of ``size`` words): its rate rounded down or up, largest
    units first, so that the words taken follow the words wanted as closely as the next unit allows. What
    is left at the end is settled by one copy more or less of units that are small enough for it."""
    words = size * times
    copies = np.zeros(len(size), np.int64)
    carry = 0.0
    order = np.lexsort((tie, -words)).tolist()
    for k in order:
        low = math.floor(rate[k] + 1e-9)
        want = carry + words[k] * rate[k]
        up = rate[k] > low + 1e-9 and 2 * (want - words[k] * low) > words[k]
        copies[k] = low + up
        carry = want - words[k] * copies[k]
    for k in order:
        if words[k] and 2 * abs(carry) > words[k]:
            step = 1 if carry > 0 else -1
            if 0 <= copies[k] + step <= most:
                copies[k] += step
                carry -= step * words[k]
    return copies


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
         most: int = 3, bucket_rows: int = 2_000) -> DataFrame:
    """``(id, source, size, n_rows, source_size, target, rate, copies)`` of every distinct (id, source, size).

    Rows equal in these three (repeated rows) share one decision. Null texts have size 0; documents
    without words have rate 1 and one copy; a very long text is one unit of its words. A null id or source is a value like any other. An empty table
    gives an empty result. Rounding runs in hash buckets of about ``bucket_rows`` units of one source."""
    begin(docs.sparkSession)
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    units = shared_table(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
                         .groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("n_rows")))
    kind = units.schema["id"].dataType.simpleString()
    has = F.col("size") > 0
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n_rows")).alias("words"), F.sum(F.when(has, F.col("n_rows"))).alias("docs"),
        F.min(F.when(has, F.col("size"))).alias("least"), F.count(F.lit(1)).alias("units"))
    sources = targets(sources, weights, float(most))
    keyed = shared_table(units.join(sources.select(F.col("source").alias("_s"), "rank", "units"),
                                    F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    hist = shared_table(keyed.groupBy("rank", "size").agg(F.sum("n_rows").alias("n")))
    mult = balance(hist, sources, float(most))
    buckets = F.ceil(F.col("units") / bucket_rows).cast("bigint")
    # one model row for each bucket, so that the join deals a hot source out by bucket too
    model = (sources.join(mult, "rank", "left").select("rank", F.col("words").alias("source_size"), "target", "m", "mult",
                                                       F.explode(F.sequence(F.lit(0).cast("bigint"), buckets - 1)).alias("bucket")))
    ratio = F.col("target") / F.col("source_size")
    rate = (F.when(F.col("size") == 0, 1.0)
            .when(F.col("mult").isNotNull(), F.least(F.lit(float(most)), F.exp(F.least(F.col("mult") * F.col("size") / (F.col("size") + F.col("m")), F.lit(50.0)))))
            .otherwise(F.least(F.lit(float(most)), ratio)))
    tie = F.xxhash64("id", "size")
    rated = (keyed.withColumn("tie", tie).withColumn("bucket", F.pmod(F.col("tie"), buckets))
             .join(model, ["rank", "bucket"]).withColumn("rate", rate))

    def settle_bucket(table: pa.Table) -> pa.Table:
        col = lambda c: table[c].to_numpy()
        copies = round_copies(col("size"), col("n_rows"), col("rate"), col("tie"), most)
        return table.select(["id", "source", "size", "n_rows", "source_size", "target", "rate"]).append_column("copies", pa.array(copies))

    return (rated.select("id", "source", "size", "n_rows", "source_size", "target", "rate", "tie", "rank", "bucket")
            .groupBy("rank", "bucket").applyInArrow(settle_bucket, f"id {kind}, source string, size bigint, n_rows bigint, "
                                                    "source_size bigint, target double, rate double, copies bigint"))


def report(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """One row for each row of ``docs``: id, size, source_size, target, taken (words), rate, copies."""
    p = plan(docs, id_col, **kw)
    p = p.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows"))))
    return p.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The rows that the mix takes, with ``mix_size``, ``mix_rate`` and ``mix_copies`` (1 or more). All columns stay,
    whatever their names, but those three: columns of an earlier mix are replaced."""
    docs = docs.drop(*MIX_COLUMNS)
    an_id, a_source, a_size = fresh(docs, "_id", "_source", "_size")
    p = shared_table(plan(docs, id_col, text_col, source_col, **kw).where("copies > 0")
                     .select(F.col("id").alias(an_id), F.col("source").alias(a_source), F.col("size").alias("mix_size"),
                             F.col("rate").alias("mix_rate"), F.col("copies").alias("mix_copies")))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    on = F.col(id_col).eqNullSafe(F.col(an_id)) & F.col(source_col).cast("string").eqNullSafe(F.col(a_source)) & (F.col(a_size) == F.col("mix_size"))
    return docs.withColumn(a_size, size).join(p, on).select(*columns(docs), *MIX_COLUMNS)
