"""Benchmark decontamination by spaced-seed hashing.

Seeds are fixed masks over token windows; a mask hashes the tokens it selects and ignores the rest, so a
window with substituted tokens still meets its twin under some mask. The hashes of the benchmark items
are joined with those of every document window. Around each hit, document and item are compared token
by token along the hit's diagonal, and every stretch of it is tested: the longest nearly identical one must be
long enough. The seeds below meet every overlap of 13 tokens that has up to 3 substitutions, and with the short
seeds every whole item of 5 to 12 tokens that has 80 % and at least 5 of them equal (checked by enumeration in
the tests).

The benchmark is the query set: it is indexed in blocks of bounded size, each of them is sent to the
tasks once and all documents are read against it, so memory does not grow with the benchmark.
"""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, bytes_of, fresh, shared_table, word_pieces

SEEDS = ((0, 1, 2, 3, 4), (0, 2, 3, 6, 8), (0, 1, 3, 5, 6), (0, 1, 5, 7, 8))
SHORT_SEEDS = ((0, 2, 3, 4, 5), (0, 1, 3, 4, 5), (0, 1, 2, 4, 5), (0, 1, 2, 3, 5))  # for items of 6 or 7 tokens with one inside changed
# bytes to token bytes: A-Z lower-cased; ASCII letters, digits and all of UTF-8's other bytes are token bytes
TOKEN_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
FILTER_BITS = 22
OUTSIDE = (1 << 64) - 1  # the number between two documents


def token_pieces(text: bytes):
    yield from word_pieces(text.translate(TOKEN_TABLE))


def seed_hashes(ids: np.ndarray, seed: tuple) -> np.ndarray:
    """Hash of the selected tokens of every window."""
    n = max(0, len(ids) - seed[-1])
    h = np.full(n, seed[-1] * 1000 + len(seed), np.uint64)
    for k in seed:
        h ^= ids[k:k + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return h


def build_index(items: list) -> dict:
    """Token numbers and seed hashes of a block of items ``(id, text)``, as plain arrays. Number 0 is any token that no item has."""
    vocab: dict = {}
    parts = []
    for _, text in items:
        words = [w for p in token_pieces(text) for w in p]
        parts.append(np.array([vocab.setdefault(w, len(vocab) + 1) for w in words], np.uint64))
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    seeds = SEEDS + (SHORT_SEEDS if any(len(p) in (6, 7) for p in parts) else ())
    tables = []
    for seed in seeds:
        h = [seed_hashes(p if seed in SEEDS or len(p) in (6, 7) else p[:0], seed) for p in parts]
        pos = np.concatenate([np.arange(len(x)) + a for x, a in zip(h, at)]) if h else np.zeros(0, np.int64)
        h = np.concatenate(h) if h else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        may = np.zeros(1 << FILTER_BITS, bool)
        may[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        tables.append((h[order], pos[order].astype(np.int64), may))
    return {"vocab": vocab, "item_ids": [i for i, _ in items], "at": at, "tokens": np.concatenate(parts) if parts else np.zeros(0, np.uint64),
            "seeds": seeds, "tables": tables, "reach": int(np.diff(at).max(initial=0))}


def surroundings(ids: np.ndarray, at: np.ndarray, reach: int) -> np.ndarray:
    """Hash of the tokens from ``reach`` before to ``reach`` behind each place (less at the ends of ``ids``)."""
    x = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    power = np.cumprod(np.full(len(x) + 1, 0xD6E8FEB86659FD93, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * power[:-1])])
    lo, hi = np.maximum(at - reach, 0), np.minimum(at + reach, len(x))
    # brought to one scale by the power that is missing up to the end
    h = (total[hi] - total[lo]) * power[len(x) - lo]
    return h ^ ((at - lo) * (2 * reach + 1) + (hi - lo)).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)


def hits(index: dict, ids: np.ndarray, doc: np.ndarray, seed_no: int, at_once: int = 1 << 22):
    """(window, benchmark position) of equal seed hashes, in bounded arrays.

    A window whose surroundings, as far as any item reaches, are those of an earlier window of its document meets
    the same stretches of the same items, later in the text; it is left out, so that a text or an item of few
    tokens often repeated costs what its distinct stretches cost."""
    keys, pos, may = index["tables"][seed_no]
    h = seed_hashes(ids, index["seeds"][seed_no])
    at = np.flatnonzero(may[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    lo, hi = np.searchsorted(keys, h[at]), np.searchsorted(keys, h[at], "right")
    at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
    if len(at) > 1:
        pair = np.stack([doc[at].astype(np.uint64), surroundings(ids, at, index["reach"] + 16)])
        order = np.lexsort((at, pair[1], pair[0]))
        new = np.concatenate([[True], (pair[:, order[1:]] != pair[:, order[:-1]]).any(axis=0)])
        first = np.sort(order[new])
        at, lo, n = at[first], lo[first], n[first]
    cuts = np.concatenate([[0], np.cumsum(n)])
    a = 0
    while a < len(at):
        z = max(a + 1, int(np.searchsorted(cuts, cuts[a] + at_once, "right")) - 1)
        m = n[a:z]
        step = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        yield np.repeat(at[a:z], m), pos[np.repeat(lo[a:z], m) + step]
        a = z


def longest_stretch(same: np.ndarray, identity: Fraction) -> tuple:
    """Start and end of the longest stretch with a share of at least ``identity`` equal tokens; of equally long
    ones that with the most equal tokens, then the first. (0, 0) without one."""
    p, q = identity.numerator, identity.denominator
    total = np.concatenate([[0], np.cumsum(np.where(same, q - p, -p))])  # not below 0 where the share is reached
    low = np.minimum.accumulate(total)
    start = np.searchsorted(-low, -total)  # the first place from which a stretch may end here
    n = np.arange(len(total)) - start
    ends = np.flatnonzero(n == n.max())
    end = int(ends[np.argmax(total[ends] - total[start[ends]])])
    return int(start[end]), end


def find_overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", min_tokens: int = 13, min_identity: float = 0.8,
                  block_bytes: int = 4 << 20, tokens_at_once: int = 1 << 19) -> DataFrame:
    """``(id, item, doc_start, item_start, n_tokens, n_same, item_tokens)``: for every pair of document and
    item its longest verified overlap, of equally long ones that with the most equal tokens; tokens count from 0.

    An overlap is any stretch of one diagonal with ``min_tokens`` tokens (the whole item where that is shorter,
    at least 5 equal ones) and ``min_identity`` of them equal; its ends may differ. Null texts count as empty and never match; repeated
    documents and repeated items are each reported; equal overlaps go to the first place. Rows without id
    are reported with a null id. A very long text is read whole, its hits in bounded arrays. Empty tables give an empty
    result. Other columns are not read."""
    spark = docs.sparkSession
    begin(spark)
    bench = shared_table(items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"),
                                      F.monotonically_increasing_id().alias("uid")).where("text <> ''"))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, item_kind = src.schema[0].dataType.simpleString(), bench.schema[0].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, `{item_col}` {item_kind}, doc_start bigint, item_start bigint, n_tokens bigint, "
              "n_same bigint, item_tokens bigint")
    out = None
    for k in range(blocks):  # a block is about block_bytes of text, whatever the benchmark's size
        part = bench.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == k).collect()
        index = build_index(sorted(((r.item, r.text.encode()) for r in part), key=lambda x: (x[0] is None, x[0], x[1])))
        sent = spark.sparkContext.broadcast(index)  # plain arrays, so that a task needs nothing to read them
        found = src.mapInArrow(_matcher(sent, min_tokens, min_identity, tokens_at_once, id_col, item_col), schema)
        if blocks > 1:  # one block at a time: its result is written and its index dropped
            found = shared_table(found)
            sent.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def _matcher(sent, min_tokens, min_identity, tokens_at_once, id_col, item_col):
    gap = max(s[-1] for s in SEEDS + SHORT_SEEDS)
    identity = Fraction(str(min_identity))

    def verify(index, best, ids, doc_lo, doc_hi, lines):
        """Longest overlap of each (document, item) on the diagonals ``lines``, added to ``best``."""
        for d, i, shift in lines.tolist():
            a, z = int(index["at"][i]), int(index["at"][i + 1])
            lo, hi = max(a, doc_lo[d] - shift), min(z, doc_hi[d] - shift)
            same = ids[lo + shift:hi + shift] == index["tokens"][lo:hi]
            if int(same.sum()) < len(SEEDS[0]):
                continue
            s, e = longest_stretch(same, identity)
            n, n_same = e - s, int(same[s:e].sum())
            if n >= min(min_tokens, z - a) and n_same >= len(SEEDS[0]):
                new = (-n, -n_same, lo + s + shift - doc_lo[d], lo + s - a, z - a)
                if (d, i) not in best or new < best[d, i]:
                    best[d, i] = new

    def kernel(batches):
        index = sent.value
        get = index["vocab"].get

        def flush(keys, parts):
            n = [len(p) for p in parts]
            doc_lo = (np.cumsum([0, *[x + gap for x in n[:-1]]])).tolist()
            doc_hi = [a + x for a, x in zip(doc_lo, n)]
            pad = np.full(gap, OUTSIDE, np.uint64)
            ids = np.concatenate([x for p in parts for x in (p, pad)])
            best: dict = {}
            done: set = set()
            for s in range(len(index["seeds"])):
                for at in range(0, len(ids), tokens_at_once):
                    lo, hi = max(0, at - index["reach"] - 16), at + tokens_at_once + index["reach"] + 16
                    piece = ids[lo:hi]
                    doc = np.searchsorted(np.array(doc_lo), np.arange(lo, lo + len(piece)), "right") - 1
                    for win, pos in hits(index, piece, doc, s):
                        own = (win + lo >= at) & (win + lo < at + tokens_at_once)
                        win, pos = win[own] + lo, pos[own]
                        item = np.searchsorted(index["at"], pos, "right") - 1
                        lines = np.unique(np.stack([doc[win - lo], item, win - pos], axis=1), axis=0)
                        new = [x for x in map(tuple, lines.tolist()) if x not in done]
                        done.update(new)
                        verify(index, best, ids, doc_lo, doc_hi, np.array(new, np.int64).reshape(-1, 3))
            rows = sorted(best.items())
            if not rows:
                return None
            return pa.RecordBatch.from_arrays(
                [keys.take(pa.array([d for (d, _), _ in rows])), pa.array([index["item_ids"][i] for (_, i), _ in rows]),
                 pa.array([r[2] for _, r in rows], pa.int64()), pa.array([r[3] for _, r in rows], pa.int64()),
                 pa.array([-r[0] for _, r in rows], pa.int64()), pa.array([-r[1] for _, r in rows], pa.int64()),
                 pa.array([r[4] for _, r in rows], pa.int64())],
                names=[id_col, item_col, "doc_start", "item_start", "n_tokens", "n_same", "item_tokens"])

        for b in batches:
            if not len(index["tokens"]):
                continue
            parts, first, held = [], 0, 0
            for k, t in enumerate(bytes_of(b)):
                one = [np.fromiter(map(get, w, repeat(0)), np.uint64, len(w)) for w in token_pieces(t)]
                parts.append(np.concatenate(one) if one else np.zeros(0, np.uint64))
                held += len(parts[-1])
                if held >= tokens_at_once or k == b.num_rows - 1:
                    out = flush(b.column(0).slice(first, len(parts)), parts)
                    if out is not None:
                        yield out
                    parts, first, held = [], k + 1, 0
    return kernel


def contaminated_ids(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """Distinct ids of the documents that hold an overlap."""
    return find_overlaps(docs, items, id_col, **kw).select(id_col).distinct()


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``docs`` without an overlap; rows without id are judged together (one tainted, all go)."""
    name, = fresh(docs, "_bad")
    bad = contaminated_ids(docs, items, id_col, **kw).withColumnRenamed(id_col, name)
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(name)), "left_anti")
