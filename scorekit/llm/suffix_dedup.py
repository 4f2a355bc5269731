"""Suffix-array dedup: remove bytes covered by long strings that also start earlier.

The distributed difference-cover algorithm, cut off at the prefix length that matters. A difference
cover of period v holds, for any two positions, an offset below v that takes both into the cover.
So two equal strings of ``length`` bytes share a sampled tuple of ``length - v + 1`` bytes:

1. *Sort sampled tuples.* Tuples at cover positions are named by hash; tasks that own a range of names
   sort them and tell which names repeat. A suffix without a repeated sample in reach is settled.
2. *Recurse.* The stretches that remain are sampled again by a denser cover with longer tuples.
3. *Merge the remaining suffixes.* The last cover has period 1: every remaining suffix is keyed by its
   whole ``length``-byte prefix, sorted by prefix, document and start.
4. *Compare adjacent prefixes.* Among equal neighbours the first start stays, the others are repeats.

Texts travel as packed blocks, names as packed byte strings, one row for each block and name range. A
block sends one name once, so a passage that a third of all documents share sends at most one name for
each block. Sizes at every level follow the data: a name has enough bytes that a chance collision is
rarer than 1 in 256 (levels that only settle) or that any collision at all is (last level).
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import q
from .common import begin, bytes_of, columns, shared_table, spread

# Perfect difference sets (each nonzero difference mod v occurs once).
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}
NO_ID = np.iinfo(np.int64).max  # stands for a null id: such documents come last
BLOCK_COLS = "block string, ids binary, ties binary, doc binary, start binary, size binary, data binary, n bigint"


def covers_for(length: int) -> tuple:
    """Periods of the levels before the last: a cover near 0.57 of the length, then a denser one."""
    first = max(v for v in COVERS if v <= max(1, 0.57 * length))
    second = max(v for v in COVERS if v <= max(1, first / 4))
    return tuple(v for v in dict.fromkeys((first, second)) if v > 1)


class Block:
    """Pieces of documents: piece k holds bytes ``start[k] .. start[k] + size[k]`` of document ``doc[k]``."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.ids, self.ties, self.doc, self.start, self.size = (
            np.frombuffer(row[c], np.int64) for c in ("ids", "ties", "doc", "start", "size"))
        self.data = zstandard.ZstdDecompressor().decompress(row["data"]) if row["data"] else b""
        self.at = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)

    @staticmethod
    def row(block, ids, ties, doc, start, size, data: bytes) -> dict:
        b = lambda x: np.ascontiguousarray(x, dtype=np.int64).tobytes()
        return {"block": [block], "ids": [b(ids)], "ties": [b(ties)], "doc": [b(doc)], "start": [b(start)], "size": [b(size)],
                "data": [zstandard.ZstdCompressor(level=1).compress(data)], "n": [len(data)]}

    def samples(self, v: int, depth: int) -> np.ndarray:
        """Buffer positions of the cover's tuples that fit into their piece."""
        if v == 1:
            parts = [np.arange(a, a + n - depth + 1) for a, n in zip(self.at[:-1], self.size) if n >= depth]
        else:
            longest = int((self.start + self.size).max(initial=0)) + v
            grid = (np.arange(0, longest, v)[:, None] + np.array(COVERS[v])).ravel()
            lo = np.searchsorted(grid, self.start)
            hi = np.searchsorted(grid, self.start + self.size - depth, "right")
            parts = [grid[l:h] + (a - s) for l, h, a, s in zip(lo, hi, self.at[:-1], self.start) if h > l]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def names(self, pos: np.ndarray, depth: int, seed: int, at_once: int = 1 << 20) -> np.ndarray:
        """64-bit names of the ``depth`` bytes at each position."""
        buf = self.data + b"\0" * 8
        words = np.ndarray((len(buf) - 7,), np.uint64, buf, strides=(1,))
        steps = [*range(0, depth - 7, 8)]
        if depth % 8 and depth > 8:
            steps.append(depth - 8)
        out = np.empty(len(pos), np.uint64)
        mask = np.uint64((1 << 8 * depth) - 1) if depth < 8 else np.uint64(2 ** 64 - 1)
        mult = np.uint64(0x9E3779B97F4A7C15 if seed == 0 else 0xC2B2AE3D27D4EB4F)
        for lo in range(0, len(pos), at_once):
            p = pos[lo:lo + at_once]
            x = np.full(len(p), seed + depth, np.uint64)
            for k in steps or [0]:
                x ^= words[p + k] & mask if depth < 8 else words[p + k]
                x *= mult
                x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(29)
            x *= mult
            out[lo:lo + at_once] = x
        return out


def pack_blocks(docs: DataFrame, id_col: str, text_col: str, length: int, block_bytes: int) -> DataFrame:
    """Distinct texts of ``length`` bytes or more, each with its smallest id, as blocks ordered by id."""
    texts = (docs.where(F.octet_length(text_col) >= length).groupBy(F.col(text_col).alias("text"))
             .agg(F.min(F.col(id_col).cast("bigint")).alias("id")).select("id", "text"))

    def kernel(batches):
        held, size = [], 0

        def flush():
            held.sort(key=lambda r: r[:2])
            n = [len(r[2]) for r in held]
            return pa.RecordBatch.from_pydict(Block.row(
                uuid.uuid4().hex, [r[0] for r in held], [r[1] for r in held], np.arange(len(held)), np.zeros(len(held)), n,
                b"".join(r[2] for r in held)))
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), bytes_of(b)):
                held.append((NO_ID if i is None else i, int.from_bytes(hashlib.sha256(t).digest()[:8], "big", signed=True), t))
                size += len(t)
                if size >= block_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return texts.mapInArrow(kernel, BLOCK_COLS)


def _rows(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _first(h, h2, more: bool = False) -> tuple:
    """Whether each entry is the first of its name in position order; with ``more`` also whether its name
    occurs again, and the number of its name."""
    n = len(h)
    if not n:
        return (np.zeros(0, bool), *((np.zeros(0, bool), np.zeros(0, np.int64)) if more else ()))
    order = np.lexsort((h2, h)) if h2 is not None else np.argsort(h)
    s = h[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1] if h2 is None else (s[1:] != s[:-1]) | (h2[order][1:] != h2[order][:-1])
    heads = np.flatnonzero(new)
    first = np.zeros(n, bool)
    first[np.minimum.reduceat(order, heads)] = True  # the sort need not be stable
    if not more:
        return (first,)
    size = np.diff(np.append(heads, n))
    many, group = np.zeros(n, bool), np.zeros(n, np.int64)
    many[order] = np.repeat(size > 1, size)
    group[order] = np.repeat(np.arange(len(heads)), size)
    return first, many, group


def by_range(rng: np.ndarray) -> np.ndarray:
    """Stable order by range number (a radix sort while the numbers have 16 bits)."""
    return np.argsort(rng.astype(np.uint16) if len(rng) == 0 or int(rng.max()) < 1 << 16 else rng, kind="stable")


class Level:
    """One level: which tuples of a block it names, and how names are sent and answered."""

    def __init__(self, v: int, length: int, n: float, per_range: int):
        self.v, self.length, self.depth, self.last = v, length, length - v + 1, v == 1
        n = max(2.0, n * len(COVERS[v]) / v)
        self.ranges = max(8, math.ceil(n / per_range))
        bits = 2 * math.log2(n) + 8 if self.last else math.log2(n) + 8
        self.width = min(16, max(8 if self.last else 4, math.ceil(bits / 8)))

    def find(self, b: Block, more: bool):
        pos = b.samples(self.v, self.depth)
        h = b.names(pos, self.depth, 0)
        h2 = b.names(pos, self.depth, 1) if self.width > 8 else None
        rng = ((h >> np.uint64(32)) * np.uint64(self.ranges)) >> np.uint64(32)
        return pos, h, h2, rng.astype(np.int32), *_first(h, h2, more)

    def ask(self, batches):
        """Rows ``(range, block, segs, names)``: the distinct names of a block in position order; ``segs``
        has id, tie and number of names of each document (last level only)."""
        for row in _rows(batches):
            b = Block(row)
            pos, h, h2, rng, first = self.find(b, False)
            at = np.flatnonzero(first)
            at = at[by_range(rng[at])]
            raw = h[at].view(np.uint8).reshape(-1, 8)[:, :min(8, self.width)]
            if h2 is not None:
                raw = np.concatenate([raw, h2[at].view(np.uint8).reshape(-1, 8)[:, :self.width - 8]], axis=1)
            owner = b.doc[np.searchsorted(b.at, pos[at], "right") - 1] if self.last else None
            cuts = np.searchsorted(rng[at], np.arange(self.ranges + 1))
            full = np.flatnonzero(cuts[1:] > cuts[:-1])
            segs = []
            for r in full if self.last else ():
                d, n = np.unique(owner[cuts[r]:cuts[r + 1]], return_counts=True)
                segs.append(np.stack([b.ids[d], b.ties[d], n]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), pa.array([b.block] * len(full), pa.string()),
                 pa.array(segs if self.last else [b""] * len(full), pa.binary()),
                 pa.array([raw[cuts[r]:cuts[r + 1]].tobytes() for r in full], pa.binary())], names=["rng", "block", "segs", "names"])

    def answer(self, table):
        """For each block, a bit for each name it sent: the name occurs in another block (early levels),
        or an earlier document of another block has it (last level)."""
        sent = [np.frombuffer(x, np.uint8).reshape(-1, self.width) for x in table["names"].to_pylist()]
        size = np.array([len(x) for x in sent])
        at = np.concatenate([[0], np.cumsum(size)])
        raw = np.concatenate(sent)
        wide = np.zeros((len(raw), 16), np.uint8)
        wide[:, :min(8, self.width)] = raw[:, :8]
        wide[:, 8:8 + max(0, self.width - 8)] = raw[:, 8:]
        key = wide.view(np.uint64)
        h, h2 = np.ascontiguousarray(key[:, 0]), np.ascontiguousarray(key[:, 1]) if self.width > 8 else None
        if not self.last:
            bit = _first(h, h2, True)[1]
        else:
            segs = [np.frombuffer(x, np.int64).reshape(3, -1) for x in table["segs"].to_pylist()]
            ids, ties, n = np.concatenate(segs, axis=1)
            begin_at = np.concatenate([[0], np.cumsum(n)[:-1]])  # names lie block by block, document by document
            rank = np.lexsort((ties, ids))
            place = np.repeat(begin_at[rank] - np.concatenate([[0], np.cumsum(n[rank])[:-1]]), n[rank]) + np.arange(len(raw))
            first = _first(h[place], h2[place] if h2 is not None else None)[0]
            bit = np.empty(len(raw), bool)
            bit[place] = ~first
        return pa.table({"block": table["block"], "rng": table["rng"],
                         "bits": pa.array([np.packbits(bit[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())})

    def told(self, b: Block, answers: list):
        """Positions of this level's tuples, and whether each repeats (last level: starts earlier too)."""
        pos, h, h2, rng, first, *rest = self.find(b, not self.last)
        at = np.flatnonzero(first)
        at = at[by_range(rng[at])]
        cuts = np.searchsorted(rng[at], np.arange(self.ranges + 1))
        bit = np.zeros(len(at), bool)
        for a in answers or ():
            lo, hi = cuts[a["rng"]], cuts[a["rng"] + 1]
            bit[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo).astype(bool)
        if self.last:
            out = ~first
            out[at] = bit
            return pos, out
        many, group = rest
        of_group = np.zeros(int(group.max(initial=-1)) + 1, bool)
        of_group[group[at]] = bit
        return pos, many | of_group[group]

    def survivors(self, batches):
        """The stretches whose suffixes are not settled, as blocks again."""
        for row in _rows(batches):
            b = Block(row)
            pos, again = self.told(b, row["answers"])
            pos = pos[again]
            # suffixes pos-v+1 .. pos are open; within their piece, with room for the whole length
            k = np.searchsorted(b.at, pos, "right") - 1
            lo, hi = np.maximum(pos - self.v + 1, b.at[k]), np.minimum(pos, b.at[k + 1] - self.length)
            ok = lo <= hi
            lo, hi, k = lo[ok], hi[ok], k[ok]
            if not len(lo):
                continue
            new = np.ones(len(lo), bool)
            new[1:] = (lo[1:] > hi[:-1] + self.length) | (k[1:] != k[:-1])
            heads = np.flatnonzero(new)
            tails = np.concatenate([heads[1:], [len(lo)]]) - 1
            lo, hi, k = lo[heads], hi[tails], k[heads]
            size = hi + self.length - lo
            data = b"".join(b.data[a:a + n] for a, n in zip(lo.tolist(), size.tolist()))
            yield pa.RecordBatch.from_pydict(Block.row(b.block, b.ids, b.ties, b.doc[k], b.start[k] + lo - b.at[k], size, data))

    def spans(self, batches):
        """``(block, spans)``: document number, start and end of every maximal run of removed bytes."""
        for row in _rows(batches):
            b = Block(row)
            pos, again = self.told(b, row["answers"])
            pos = pos[again]
            if not len(pos):
                continue
            k = np.searchsorted(b.at, pos, "right") - 1
            new = np.ones(len(pos), bool)
            new[1:] = (pos[1:] > pos[:-1] + self.length) | (k[1:] != k[:-1])
            heads = np.flatnonzero(new)
            tails = np.concatenate([heads[1:], [len(pos)]]) - 1
            k = k[heads]
            shift = b.start[k] - b.at[k]
            out = np.stack([b.doc[k], pos[heads] + shift, pos[tails] + self.length + shift]).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"block": [b.block], "spans": [out.tobytes()]})


def _exchange(level: Level, blocks: DataFrame, size: float) -> DataFrame:
    """Blocks with the answers to the names they sent."""
    asked = blocks.mapInArrow(level.ask, "rng int, block string, segs binary, names binary")
    answers = shared_table(asked.groupBy("rng").applyInArrow(lambda t: level.answer(t), "block string, rng int, bits binary")
                           .groupBy("block").agg(F.collect_list(F.struct("rng", "bits")).alias("answers")))
    return spread(blocks, size).join(answers, "block", "left")


def _cut(batches, with_text: bool):
    for row in _rows(batches):
        b = Block(row)
        doc, lo, hi = np.frombuffer(row["spans"], np.int64).reshape(3, -1) if row["spans"] else np.zeros((3, 0), np.int64)
        cuts = np.searchsorted(doc, np.arange(len(b.ids) + 1))
        cols = {c: [] for c in ("sha", "least_id", "n_removed", "n_spans", "kept_sha256", "kept")}
        for d in range(len(b.ids)):
            text = b.data[b.at[d]:b.at[d + 1]]
            a, z = lo[cuts[d]:cuts[d + 1]].tolist(), hi[cuts[d]:cuts[d + 1]].tolist()
            left = b"".join(text[x:y] for x, y in zip([0, *z], [*a, len(text)])) if a else text
            sha = hashlib.sha256(text).hexdigest()
            cols["sha"].append(sha)
            cols["least_id"].append(None if b.ids[d] == NO_ID else int(b.ids[d]))
            cols["n_removed"].append(len(text) - len(left))
            cols["n_spans"].append(len(a))
            cols["kept_sha256"].append(hashlib.sha256(left).hexdigest() if a else sha)
            cols["kept"].append(left.decode("utf-8", "ignore") if with_text and a else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols["sha"], pa.string()), pa.array(cols["least_id"], pa.int64()), pa.array(cols["n_removed"], pa.int64()),
             pa.array(cols["n_spans"], pa.int64()), pa.array(cols["kept_sha256"], pa.string()), pa.array(cols["kept"], pa.string())],
            names=list(cols))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, block_bytes: int = 2 << 20,
            per_range: int = 1 << 19, with_text: bool = False) -> DataFrame:
    """One row for each distinct text of ``length`` bytes or more: ``(sha, least_id, n_removed, n_spans,
    kept_sha256, kept)``, for its document with the smallest id. ``kept`` is the remaining text (cut
    characters dropped) where something is removed and ``with_text`` is set."""
    begin(docs.sparkSession)
    whole = shared_table(pack_blocks(docs, id_col, text_col, length, block_bytes))
    left, sizes = whole, []
    for v in (*covers_for(length), 1):
        n = left.agg(F.sum("n")).first()[0] or 0
        sizes.append(n)
        level = Level(v, length, n, per_range)
        told = _exchange(level, left, n)
        if v > 1:
            left = shared_table(told.mapInArrow(level.survivors, BLOCK_COLS))
        else:
            spans = shared_table(told.mapInArrow(level.spans, "block string, spans binary"))

    def cut(batches):
        yield from _cut(batches, with_text)
    return shared_table(spread(whole, sizes[0]).join(spans, "block", "left").mapInArrow(
        cut, "sha string, least_id bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"))


def _with_repeats(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, row, sha, fate)`` and the columns of ``found`` for every row: ``row`` holds its other columns, ``fate`` is own
    (the text's first document), copy, or short (below the length). The text may be a hot key of the join: AQE splits
    its partitions."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*columns(docs.drop(text_col))).alias("row"),
                    F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("sha"))
    r = found.withColumnRenamed("sha", "found")
    fate = F.when(F.col("found").isNull(), "short").when(F.col("id").eqNullSafe(F.col("least_id")), "own").otherwise("copy")
    return d.join(r, F.col("sha") == F.col("found"), "left").withColumn("fate", fate)


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, **sizes) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row.

    Null and empty texts have no bytes; texts below ``length`` bytes keep all. Documents come in order of
    id, those without id last; rows with one id and different texts in order of their text's hash; rows
    equal in id and text are one document. Other columns, whatever their names, are not read."""
    docs = docs.select(F.col(id_col), F.col(text_col))
    j = _with_repeats(docs, repeats(docs, id_col, text_col, length, **sizes), id_col, text_col)
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    by = lambda own, copy, short: F.when(F.col("fate") == "own", own).when(F.col("fate") == "copy", copy).otherwise(short)
    zero = F.lit(0).cast("bigint")
    return j.select(F.col("id").alias(id_col), n.alias("n_bytes"), by(F.col("n_removed"), n, zero).alias("n_removed"),
                    by(F.col("n_spans"), F.lit(1).cast("bigint"), zero).alias("n_spans"),
                    by(F.col("kept_sha256"), F.lit(hashlib.sha256(b"").hexdigest()), F.col("sha")).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, **sizes) -> DataFrame:
    """The rows with their repeated bytes cut from the text; rows that lose all of it are dropped. All columns stay,
    whatever their names."""
    found = repeats(docs, id_col, text_col, length, with_text=True, **sizes)
    j = _with_repeats(docs, found, id_col, text_col).where("fate <> 'copy'")
    cut = F.when((F.col("fate") == "own") & (F.col("n_spans") > 0), F.col("kept")).otherwise(F.col("text"))
    return (j.withColumn("left", cut).where(~((F.col("fate") == "own") & (F.length("left") == 0)))
            .select(*[F.col("left").alias(c) if c == text_col else F.col(f"row.{q(c)}").alias(c) for c in docs.columns]))
