"""SimHash near-dedup: fingerprints of word shingles, joined with themselves by a binary trie.

The sorted distinct fingerprints are a binary trie. The self-join walks pairs of its nodes together
from the top bit down, adds one to a pair's error where the bits differ and drops the pair when the
error exceeds the budget. The upper part of the trie is cut into subtries of about ``leaf`` fingerprints;
every pair of subtries whose prefixes are still within the budget is one group of a Spark job, where the
walk goes on. A group returns only a spanning forest of the links it found, so a dense group of near
copies never turns into all its pairs; the forests are joined by ``common.components``.
"""

from __future__ import annotations

from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, bounded, bytes_of, columns, components, fresh, hook, shared_table, word_pieces


def fingerprint(text: bytes, k: int = 3, bits_at_once: int = 1 << 16) -> int:
    """64-bit SimHash of a text: a bit is set if it is set in over half of the shingle hashes."""
    ones, n, tail = np.zeros(64, np.int64), 0, []
    for words in word_pieces(text.lower()):
        words = tail + words
        if len(words) < k:
            tail = words
            continue
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda a, b: a + 1 + b))
        starts = [0] + [e + 1 for e in ends[:-k]]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in zip(starts, ends[k - 1:])], repeat(42)),
                             np.uint64, len(words) - k + 1)
        for at in range(0, len(hashes), bits_at_once):
            part = hashes[at:at + bits_at_once].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.add.reduce(np.unpackbits(part, axis=1), axis=0, dtype=np.uint32)
        n += len(hashes)
        tail = words[len(words) - k + 1:]
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(tail), 42) if tail else 0
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """``(id, text_hash, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""
    def kernel(batches):
        for b in batches:
            fps = np.array([fingerprint(t, k) for t in bytes_of(b)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["id", "text_hash", "fp"])

    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return src.mapInArrow(kernel, f"id {src.schema[0].dataType.simpleString()}, text_hash bigint, fp bigint")


def walk(a: np.ndarray, b: np.ndarray, same: bool, budget: int, small: int = 32, wide: int = 1 << 19):
    """Index pairs of two sorted fingerprint arrays within ``budget`` bits, in batches. ``same``: both
    are one array, each pair is given once. The frontier is walked in bounded pieces, deepest first."""
    ones = {}

    def upto(x, bit, key):
        if (key, bit) not in ones:
            ones[key, bit] = np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1))]).astype(np.int64)
        return ones[key, bit]

    todo = [(63, np.array([[0], [len(a)], [0], [len(b)], [0]], np.int64))]
    while todo:
        bit, f = todo.pop()
        if f.shape[1] > wide:
            todo += [(bit, f[:, at:at + wide]) for at in range(0, f.shape[1], wide)]
            continue
        al, ah, bl, bh, e = f
        few = ((ah - al) * (bh - bl) <= small) | (bit < 0)
        if few.any():
            for at in range(0, int(few.sum()), wide):
                yield from _compare(a, b, f[:4, few][:, at:at + wide], same, budget)
            f = f[:, ~few]
            al, ah, bl, bh, e = f
        if not f.shape[1]:
            continue
        ca, cb = upto(a, bit, 0), upto(b, bit, 1)
        am, bm = ah - (ca[ah] - ca[al]), bh - (cb[bh] - cb[bl])
        mirror = (al == bl) & (ah == bh) if same else np.zeros(len(al), bool)
        kids = [np.stack([al, am, bl, bm, e]), np.stack([am, ah, bm, bh, e]),
                np.stack([al, am, bm, bh, e + 1]), np.stack([am, ah, bl, bm, e + 1])[:, ~mirror]]
        kids = np.concatenate(kids, axis=1)
        todo.append((bit - 1, kids[:, (kids[0] < kids[1]) & (kids[2] < kids[3]) & (kids[4] <= budget)]))


def _compare(a, b, f, same, budget, at_once: int = 1 << 22):
    al, ah, bl, bh = f
    nb = bh - bl
    size = (ah - al) * nb
    cuts = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + at_once, "right")) - 1)
        if hi == lo + 1 and size[lo] > at_once:  # equal prefixes to the last bit cannot occur among distinct values
            raise ValueError("fingerprints must be distinct")
        which = np.repeat(np.arange(lo, hi), size[lo:hi])
        k = np.arange(len(which)) - (cuts[which] - cuts[lo])
        i, j = al[which] + k // nb[which], bl[which] + k % nb[which]
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            near &= i < j
        if near.any():
            yield i[near], j[near]
        lo = hi


def subtries(fps: DataFrame, leaf: int = 1 << 15, top_bits: int = 16, step: int = 8) -> tuple:
    """Cut of the trie of the distinct fingerprints ``fps(fp)`` into subtries of ``leaf`` or fewer: their first
    value, ascending, and the number of their free low bits.

    The first histogram has at most 2^top_bits rows. Prefixes that hold more than a leaf, fewer than
    fingerprints / leaf, are counted again by ``step`` more bits, until none is left."""
    spark = fps.sparkSession
    found, hot, done = [], [0], 0
    while hot:
        bits = min(64, done + (step if done else top_bits))
        width = bits - done
        part = fps
        if done:
            over = spark.createDataFrame([(p,) for p in hot], "hot bigint")
            part = fps.join(bounded(over), F.shiftrightunsigned("fp", 64 - done) == F.col("hot"), "left_semi")
        hist = {p: np.zeros(1 << width, np.int64) for p in hot}
        for p, n in part.groupBy(F.shiftrightunsigned("fp", 64 - bits).alias("p")).count().collect():  # 2^width rows a hot prefix
            p &= (1 << 64) - 1
            hist[p >> width][p & ((1 << width) - 1)] = n
        hot = []
        for p, counts in hist.items():
            total = np.concatenate([[0], np.cumsum(counts)])
            stack = [(0, 1 << width)]
            while stack:  # binary splits of ranges that hold more than a leaf
                lo, hi = stack.pop()
                n = total[hi] - total[lo]
                if n > leaf and hi - lo > 1:
                    stack += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
                elif n > leaf and bits < 64:
                    hot.append((p << width) + lo)
                elif n:
                    found.append((((p << width) + lo) << (64 - bits), 64 - bits + (hi - lo).bit_length() - 1))
        done = bits
    found.sort()
    return np.array([f[0] for f in found], np.uint64), np.array([f[1] for f in found], np.uint64)


def trie_links(fps: DataFrame, budget: int = 3, leaf: int = 1 << 15, top_bits: int = 16) -> DataFrame:
    """Spanning links ``(u, v)`` of the distinct fingerprints ``fps(fp)`` at ``budget`` or fewer bits.

    Every pair of subtries that may hold a link is one group of at most 2 * leaf fingerprints, however many
    share a prefix."""
    start, free = subtries(fps, leaf, top_bits)

    def partners(k: int) -> np.ndarray:
        """Subtries whose prefix may be within the budget of subtrie k's, by the bits both have."""
        common = np.minimum(np.maximum(free, free[k]), np.uint64(63))  # 64 free bits: the only subtrie
        return np.flatnonzero(np.bitwise_count((start ^ start[k]) >> common) <= budget)

    def deal(batches):
        for b in batches:
            x = np.sort(np.asarray(b.column(0)).view(np.uint64))
            node = np.searchsorted(start, x, "right") - 1
            for k in np.unique(node):
                blob = x[node == k].tobytes()
                for p in partners(k):
                    yield pa.RecordBatch.from_pydict({
                        "pair": pa.array([f"{min(k, p)}-{max(k, p)}"]), "side": pa.array([int(k)], pa.int32()),
                        "fps": pa.array([blob], pa.binary())})

    def join(table):
        sides = {}
        for s, blob in zip(table["side"].to_pylist(), table["fps"].to_pylist()):
            sides.setdefault(s, []).append(np.frombuffer(blob, np.uint64))
        parts = [np.sort(np.concatenate(sides[s])) for s in sorted(sides)]
        first = table["pair"][0].as_py().split("-")
        out = []
        if first[0] == first[1]:
            a = parts[0]
            parent = np.arange(len(a))
            for i, j in walk(a, a, True, budget):
                hook(parent, i, j)
            child = np.flatnonzero(parent != np.arange(len(a)))
            out = [a[child], a[parent[child]]]
        elif len(parts) == 2:
            a, b = parts
            every = np.concatenate(parts)
            parent = np.arange(len(every))
            for i, j in walk(a, b, False, budget):
                hook(parent, i, j + len(a))
            child = np.flatnonzero(parent != np.arange(len(every)))
            out = [every[child], every[parent[child]]]
        u, v = out if len(out) else (np.zeros(0, np.uint64),) * 2
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    return (fps.select("fp").mapInArrow(deal, "pair string, side int, fps binary")
            .groupBy("pair").applyInArrow(join, "u bigint, v bigint"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, k: int, budget: int, leaf: int) -> DataFrame:
    """``(id, text_hash, fp, root, component_id)`` of every row; ``root`` names its component."""
    begin(docs.sparkSession)
    marks = shared_table(fingerprints(docs, id_col, text_col, k))
    fps = shared_table(marks.groupBy("fp").agg(F.min("id").alias("least")))
    comp = components(trie_links(fps, budget, leaf))
    owned = fps.join(comp, fps.fp == comp.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    label = owned.join(ids, "root").select("fp", "root", "component_id")
    # one fingerprint may hold a third of all rows: a plain equi-join, whose large partitions AQE splits
    return marks.join(label, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, budget: int = 3,
                    leaf: int = 1 << 15) -> DataFrame:
    """Every row with its fingerprint and component: ``(id, fingerprint, component_id)``.

    A null or empty text has fingerprint zero and links like any other; a very long text is read whole, in pieces. Repeated rows stay. A null id is
    judged by its text; ``component_id`` is the smallest non-null id, null where a component has none.
    An empty table gives an empty result; other columns, whatever their names, are not read."""
    g = _grouped(docs, id_col, text_col, k, budget, leaf)
    return g.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, budget: int = 3,
                leaf: int = 1 << 15) -> DataFrame:
    """One row of every component: the one with the smallest id, null last, then with the smallest hash of
    its text; of equal rows, one. All columns stay, whatever their names."""
    g = _grouped(docs, id_col, text_col, k, budget, leaf)
    an_id, a_hash = fresh(docs, "_id", "_hash")
    first = (g.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")).alias("f"))
             .select(F.col("f.id").alias(an_id), F.col("f.text_hash").alias(a_hash)))
    on = F.col(id_col).eqNullSafe(F.col(an_id)) & (F.xxhash64(text_col) == F.col(a_hash))
    kept = docs.join(shared_table(first), on).dropDuplicates([an_id, a_hash])
    return kept.select(*columns(docs))
