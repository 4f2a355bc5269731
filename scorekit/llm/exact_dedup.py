"""Exact dedup by counting quotient filters.

A normalised text has a fingerprint of p bits. Every task builds counting quotient filters of the fingerprints it
has seen: the upper bits (quotient) name a home, the lower ones (remainder) stand sorted in the home's run, and a
remainder seen more than once is followed by the digits of its count. The filters of all tasks merge without
loss, because a filter gives back its fingerprints in order: range by range, sorted remainders are merged and counts
added. Fingerprints counted once name texts without a copy. The others route to byte verification: only their
texts are read again, and grouped by the bytes themselves.

Rows are read twice, and only fingerprints, hashes and texts with copies travel; copies collapse to one row for
each task before they do, so a group of copies of any size is a count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_MAX_BYTES
from .common import begin, bounded, shared_table

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def fingerprint_of(normal: Column, bits: int) -> Column:
    """The upper ``bits`` bits of the text's 64-bit hash, as a number of 0 or more."""
    return F.shiftrightunsigned(F.xxhash64(normal), 64 - bits)


def pack_filter(values: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A counting quotient filter of sorted distinct fingerprints of ``bits`` bits.

    Layout: number of slots; quotient bits; one bit for each quotient that is occupied; one for each slot that ends a run,
    one for each that continues a count; the slots, remainders in as many bytes as they need. A count of c > 1 takes
    the slots behind its remainder, with the digits of c - 1 from the lowest."""
    q = min(bits, max(1, math.ceil(math.log2(max(2, len(values))))))
    r = bits - q
    width = max(1, math.ceil(r / 8))
    quotient = values >> np.uint64(r)
    more = counts - 1
    digits = -(-np.frexp(more.astype(np.float64))[1].astype(np.int64) // (8 * width))  # of that many bytes each; 0 has none
    slot = np.cumsum(digits + 1) - digits - 1
    size = int((digits + 1).sum())
    slots = np.zeros(size, np.uint64)
    slots[slot] = values & np.uint64((1 << r) - 1)
    for k in range(int(digits.max(initial=0))):
        on = digits > k
        slots[slot[on] + 1 + k] = (more[on] >> (8 * width * k)).astype(np.uint64) & np.uint64((1 << 8 * width) - 1)
    occupied, ends, carried = np.zeros(1 << q, bool), np.zeros(size, bool), np.ones(size, bool)
    occupied[quotient.astype(np.int64)] = True
    last = np.concatenate([quotient[1:] != quotient[:-1], [True]]) if len(values) else np.zeros(0, bool)
    ends[(slot + digits)[last]] = True
    carried[slot] = False
    raw = np.ascontiguousarray(slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return b"".join([size.to_bytes(8, "little"), bytes([q]), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                     np.packbits(carried).tobytes(), raw.tobytes()])


def unpack_filter(blob: bytes, bits: int) -> tuple:
    """The sorted fingerprints of a filter and their counts."""
    size, q = int.from_bytes(blob[:8], "little"), blob[8]
    r = bits - q
    width = max(1, math.ceil(r / 8))
    at = 9

    def flags(n):
        nonlocal at
        raw = np.frombuffer(blob, np.uint8, (n + 7) // 8, at)
        at += len(raw)
        return np.unpackbits(raw, count=n).astype(bool)
    occupied, ends, carried = flags(1 << q), flags(size), flags(size)
    wide = np.zeros((size, 8), np.uint8)
    wide[:, :width] = np.frombuffer(blob, np.uint8, size * width, at).reshape(size, width)
    slots = wide.view("<u8").ravel()
    run = np.cumsum(np.concatenate([[0], ends[:-1]])) if size else np.zeros(0, np.int64)
    head = np.flatnonzero(~carried)
    values = (np.flatnonzero(occupied)[run[head]].astype(np.uint64) << np.uint64(r)) | slots[head]
    counts = np.ones(len(head), np.int64)
    digit = np.flatnonzero(carried)
    owner = np.searchsorted(head, digit) - 1
    place = digit - head[owner] - 1
    np.add.at(counts, owner, slots[digit].astype(np.int64) << (8 * width * place))
    return values, counts


def merge(parts: list) -> tuple:
    """Sorted fingerprints with their counts added up, of ``(fingerprints, counts)`` in order."""
    values, counts = np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def repeated(marks: DataFrame, n: int, bits: int, per_range: int = 1 << 21, per_filter: int = 1 << 21) -> DataFrame:
    """``(fp)``: the fingerprints that ``marks(fp)`` holds more than once, by merged counting quotient filters.

    Ranges are cut so that a merged filter holds about ``per_range`` fingerprints; a task closes its filters
    after ``per_filter`` rows, however many it reads."""
    range_bits = min(bits - 1, max(0, math.ceil(math.log2(max(1, n / per_range)))))
    low = bits - range_bits

    def build(batches):
        held, size = [], 0

        def close():
            values, counts = merge(held)
            home = (values >> np.uint64(low)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1], [True]]))
            for a, z in zip(cuts[:-1], cuts[1:]):
                blob = pack_filter(values[a:z] & np.uint64((1 << low) - 1), counts[a:z], low)
                yield pa.RecordBatch.from_arrays([pa.array([int(home[a])], pa.int64()), pa.array([blob], pa.binary())], names=["rng", "filter"])
        for b in batches:
            values, counts = np.unique(np.asarray(b.column(0)).view(np.uint64), return_counts=True)
            held.append((values, counts))
            size += b.num_rows
            if size >= per_filter:
                yield from close()
                held, size = [], 0
        if size:
            yield from close()

    def join(table):
        values, counts = merge([unpack_filter(x, low) for x in table["filter"].to_pylist()])
        values = values[counts > 1] | np.uint64(table["rng"][0].as_py() << low)
        return pa.table({"fp": pa.array(values.view(np.int64))})

    return marks.select("fp").mapInArrow(build, "rng bigint, filter binary").groupBy("rng").applyInArrow(join, "fp bigint")


def _judged(docs: DataFrame, id_col: str, text_col: str, extra_bits: int, max_bytes: int) -> DataFrame:
    """``(id, fp, sha, uid, keep_id, group_size, kept)`` of every row; ``uid`` numbers rows."""
    spark = docs.sparkSession
    begin(spark)
    n = docs.select(F.lit(1)).count()
    bits = min(63, math.ceil(math.log2(n + 2)) + extra_bits)  # one text in 2^extra_bits shares its fingerprint with another by chance
    src = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("normal"))
    marks = shared_table(src.select("id", fingerprint_of(F.col("normal"), bits).alias("fp"), F.sha2("normal", 256).alias("sha"),
                                    F.monotonically_increasing_id().alias("uid")))
    again = shared_table(repeated(marks, n, bits))
    side = bounded(again, max_bytes)
    # byte verification: texts that share a fingerprint, grouped by their bytes; sha names a verified text
    texts = src.withColumn("fp", fingerprint_of(F.col("normal"), bits)).join(side, "fp", "left_semi")
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id"))
    groups = shared_table(texts.groupBy("fp", "normal").agg(least.alias("least"), F.count(F.lit(1)).alias("group_size"))
                          .select(F.col("fp").alias("fp"), F.sha2("normal", 256).alias("sha"), F.col("least.id").alias("keep_id"), "group_size"))
    if not groups.groupBy("fp", "sha").count().where("count > 1").isEmpty():
        raise RuntimeError("two different texts have one SHA-256")
    groups = groups.where("group_size > 1")
    found = marks.join(bounded(groups, max_bytes), ["fp", "sha"], "left")
    single = F.col("group_size").isNull()
    found = shared_table(found.withColumn("keep_id", F.when(single, F.col("id")).otherwise(F.col("keep_id")))
                         .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("bigint")))
                         .withColumn("kept", single | F.col("id").eqNullSafe(F.col("keep_id"))))
    # rows that repeat the id of the row that stays: one of them stays
    twice = (found.where("kept and group_size > 1").groupBy("fp", "sha").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("first"))
             .where("n > 1").select("fp", "sha", "first"))
    return (found.join(bounded(shared_table(twice), max_bytes), ["fp", "sha"], "left")
            .withColumn("kept", F.col("kept") & (F.col("first").isNull() | (F.col("uid") == F.col("first")))).drop("first"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra_bits: int = 16, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` of every row.

    Whole texts are equal when they are identical after each run of white space (0x20, 0x09-0x0D) became one space;
    null is the empty text. Of equal texts the row with the smallest id stays, null last; rows that repeat both id and
    text are copies of each other, and one of them stays. ``text_sha256`` is of the normalised text in UTF-8. An
    empty table gives an empty result; other columns, whatever their names, are not read. Tables of fingerprints
    and groups are broadcast up to ``max_bytes``, else joined by shuffle."""
    g = _judged(docs, id_col, text_col, extra_bits, max_bytes)
    return g.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra_bits: int = 16, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; of rows that repeat both id and text, one."""
    g = _judged(docs, id_col, text_col, extra_bits, max_bytes)
    kept = shared_table(g.where("kept").select(F.struct(F.col("id"), F.col("sha")).alias("key")))
    row = docs.select(F.struct(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("sha")).alias("key"),
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return row.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
