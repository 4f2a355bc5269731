"""LM scoring by deleted interpolation.

The probability of a token after its predecessor mixes maximum-likelihood estimates,

    P(w | v) = l2(b) * c(v w) / c(v) + l1(b) * c(w) / N + l0(b) / (V + 1),   b = bucket of c(v),

with weights per context-frequency bucket (powers of two). The weights are learned by expectation-
maximisation on held-out counts: one slice of the training documents is left out of the counts, and its
bigrams, binned by bucket and by the two estimates, form a table whose size does not depend on the corpus.

Counts travel packed. A block of documents keeps its tokens as numbers of a local vocabulary; it asks for
every distinct word and bigram once, as a few bytes of hash in one row for each hash range. The task that
owns a range adds up the blocks' counts and answers each question. A word that a third of all tokens
share is thus one number for each block. Counts are over all training documents; nothing is pruned.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin, bytes_of, settle, shared_table, spread, word_pieces

TEST, HELD, EST = 0, 1, 2  # roles of documents: not learned from, for the weights, for the counts
END = 0  # the local number of the end token, also the context of the first word
BINS = 8  # per factor of two, of an estimate in the held-out table


def pack(x: np.ndarray) -> bytes:
    """Whole numbers, compressed by byte planes."""
    x = np.ascontiguousarray(x)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def unpack(blob: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def build_blocks(docs: DataFrame, id_col: str, text_col: str, role: Column, block_tokens: int) -> DataFrame:
    """Blocks ``(block, role, ids, sizes, vocab, tokens, n)`` of documents of one role."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), role.cast("int").alias("role"))
    id_type = src.schema["id"].dataType

    def kernel(batches):
        def fresh():
            vocab = defaultdict()
            vocab.default_factory = vocab.__len__
            vocab[b""]  # the end token is number 0
            return [vocab, [], [], [], 0]

        def flush(role, held):
            vocab, ids, sizes, parts, n = held
            keys = np.fromiter(map(xxhash.xxh64_intdigest, vocab), np.uint64, len(vocab))
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.array([role], pa.int32()), pa.array([ids], pa.list_(arrow_id)),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([keys.tobytes()], pa.binary()),
                 pa.array([pack(np.concatenate(parts))], pa.binary()), pa.array([n], pa.int64())],
                names=["block", "role", "ids", "sizes", "vocab", "tokens", "n"])
        open_, arrow_id = {}, None
        for b in batches:
            arrow_id = b.column(0).type
            for i, t, r in zip(b.column(0).to_pylist(), bytes_of(b), b.column(2).to_pylist()):
                held = open_.setdefault(r, fresh())
                size = 1
                for words in word_pieces(t.lower()):
                    held[3].append(np.fromiter(map(held[0].__getitem__, words), np.uint32, len(words)))
                    size += len(words)
                held[3].append(np.zeros(1, np.uint32))
                held[1].append(i)
                held[2].append(size)
                held[4] += size
                if held[4] >= block_tokens:
                    yield flush(r, open_.pop(r))
        for r, held in open_.items():
            yield flush(r, held)

    return src.mapInArrow(kernel, f"block string, role int, ids array<{id_type.simpleString()}>, sizes array<bigint>, "
                                  "vocab binary, tokens binary, n bigint")


class Counts:
    """How words and bigrams of blocks are asked for, counted and answered."""

    def __init__(self, n: float, per_range: int = 1 << 20):
        self.ranges = max(4, math.ceil(max(1.0, n) / per_range))
        self.width = min(8, math.ceil((math.log2(max(2.0, n)) + 20) / 8))  # a chance collision below one in a million

    def keys(self, row: dict):
        """Per kind: names, counts, their order by range and where each range begins; and the number of
        the bigram that ends at every token."""
        words = np.frombuffer(row["vocab"], np.uint64)
        tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(row["sizes"])[:-1]]).astype(np.int64)
        before = np.empty(len(tokens), np.int64)
        before[1:] = tokens[:-1]
        before[first] = END
        codes, bigram, n2 = np.unique(before * len(words) + tokens, return_inverse=True, return_counts=True)
        h = words[codes // len(words)] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h = (h + words[codes % len(words)]) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xD6E8FEB86659FD93)
        kinds = []
        for names, n in ((words, np.bincount(tokens, minlength=len(words))), (h, n2)):
            rng = ((names >> np.uint64(32)) * np.uint64(self.ranges)) >> np.uint64(32)
            order = np.argsort(rng, kind="stable")
            kinds.append((names, n, order, np.searchsorted(rng[order], np.arange(self.ranges + 1, dtype=np.uint64))))
        return tokens, before, bigram, kinds

    def ask(self, batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                out = {c: [] for c in ("kind", "rng", "block", "role", "names", "n")}
                for kind, (names, n, order, cuts) in enumerate(self.keys(row)[3]):
                    raw = names[order].view(np.uint8).reshape(-1, 8)[:, :self.width]
                    n = n[order].astype(np.uint32)
                    for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                        part = slice(cuts[r], cuts[r + 1])
                        for c, v in zip(out, (kind, r, row["block"], row["role"], raw[part].tobytes(), pack(n[part]) if row["role"] != TEST else b"")):
                            out[c].append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["kind"], pa.int32()), pa.array(out["rng"], pa.int32()), pa.array(out["block"], pa.string()),
                     pa.array(out["role"], pa.int32()), pa.array(out["names"], pa.binary()), pa.array(out["n"], pa.binary())], names=list(out))

    def answer(self, table: pa.Table) -> pa.Table:
        """For each question the count in all training blocks, and for held-out blocks the count without
        them; a row without block has the number of distinct training names of the range."""
        raw = [np.frombuffer(x, np.uint8).reshape(-1, self.width) for x in table["names"].to_pylist()]
        size = [len(x) for x in raw]
        at = np.concatenate([[0], np.cumsum(size)])
        role = table["role"].to_pylist()
        n = np.concatenate([unpack(x, np.uint32).astype(np.int64) if r != TEST else np.zeros(s, np.int64)
                            for x, r, s in zip(table["n"].to_pylist(), role, size)])
        wide = np.zeros((at[-1], 8), np.uint8)
        wide[:, :self.width] = np.concatenate(raw)
        _, where = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
        held = np.repeat(np.array(role) == HELD, size)
        est = np.bincount(where, np.where(held, 0, n)).astype(np.uint64)
        every = est + np.bincount(where, np.where(held, n, 0)).astype(np.uint64)
        a, e = every[where], est[where]
        k, r = table["kind"][0].as_py(), table["rng"][0].as_py()
        rows = [(table["block"][i].as_py(), k, r, pack(a[x:y]), pack(e[x:y]) if role[i] == HELD else None, None)
                for i, (x, y) in enumerate(zip(at[:-1], at[1:]))]
        rows.append((None, k, r, None, None, int((every > 0).sum())))
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
        names = ("block", "kind", "rng", "every", "est", "known")
        return pa.table({c: pa.array([x[j] for x in rows], t) for j, (c, t) in enumerate(zip(names, kinds))})

    def told(self, row: dict, which: str):
        """Counts of the context, the bigram and the token at every token of a block."""
        tokens, before, bigram, kinds = self.keys(row)
        counts = [np.zeros(len(names), np.int64) for names, *_ in kinds]
        for a in row["answers"]:
            _, _, order, cuts = kinds[a["kind"]]
            counts[a["kind"]][order[cuts[a["rng"]]:cuts[a["rng"] + 1]]] = unpack(a[which], np.uint64).astype(np.int64)
        return counts[0][before], counts[1][bigram], counts[0][tokens]


def bucket_of(c: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count)."""
    return np.where(c > 0, np.frexp(c.astype(float))[1], 0)


def learn_weights(cells: np.ndarray, uniform: float, rounds: int = 200) -> np.ndarray:
    """EM on held-out cells ``(bucket, bin of c(vw)/c(v), bin of c(w)/N, count)``: weights of the bigram,
    the unigram and the uniform estimate for buckets 0 .. 63. A bucket without held-out tokens takes
    those of the nearest one that has some; every weight of the uniform estimate is at least 1e-4."""
    out = np.full((64, 3), 1 / 3)
    seen = []
    for b in range(64):
        x = cells[cells[:, 0] == b]
        if not len(x):
            continue
        p = np.stack([np.where(x[:, 1] > -9999, np.exp2(x[:, 1] / BINS), 0.0), np.where(x[:, 2] > -9999, np.exp2(x[:, 2] / BINS), 0.0),
                      np.full(len(x), uniform)], axis=1)
        lam = np.array([0.0, .5, .5]) if b == 0 else np.full(3, 1 / 3)
        for _ in range(rounds):
            share = lam * p
            share /= share.sum(axis=1, keepdims=True)
            new = (share * x[:, 3:4]).sum(axis=0) / x[:, 3].sum()
            if np.abs(new - lam).max() < 1e-9:
                break
            lam = new
        lam = np.maximum(lam, [0, 0, 1e-4])
        out[b] = lam / lam.sum()
        seen.append(b)
    for b in range(64):
        if seen and b not in seen:
            out[b] = out[min(seen, key=lambda s: (abs(s - b), s))]
    lost = out[0] * [0, 1, 1]
    out[0] = lost / lost.sum()  # an unseen context has no bigram estimate
    return out


def score(docs: DataFrame, role: Column, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = 3 << 18) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    ``role`` is 0 for rows that are scored only (held_out), 1 for training rows that set the weights and
    2 for the other training rows; the final counts are over roles 1 and 2. Texts are lower-cased (A-Z), cut
    into words and closed by an end token; a null text is empty. Repeated rows count as often as they
    occur. Without training rows every token has probability 1 / (V + 1) with V = 0. Other columns are not
    read; an empty table gives an empty result."""
    spark = docs.sparkSession
    begin(spark)
    blocks = shared_table(build_blocks(docs, id_col, text_col, role, block_tokens))
    sums = {r["role"]: r["n"] for r in blocks.groupBy("role").agg(F.sum("n").alias("n")).collect()}  # three rows at most
    n_train, n_est = sums.get(EST, 0) + sums.get(HELD, 0), sums.get(EST, 0)
    counts = Counts(sum(sums.values()))
    answers = shared_table(
        blocks.mapInArrow(counts.ask, "kind int, rng int, block string, role int, names binary, n binary")
        .groupBy("kind", "rng").applyInArrow(lambda t: counts.answer(t), "block string, kind int, rng int, every binary, est binary, known bigint"))
    vocab = answers.where("kind = 0").agg(F.sum("known")).first()[0] or 0
    uniform = 1.0 / (vocab + 1)
    per_block = answers.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("kind", "rng", "every", "est")).alias("answers"))

    def cells(batches):
        for b in batches:
            for i in range(b.num_rows):
                ctx, big, uni = counts.told(b.slice(i, 1).to_pylist()[0], "est")
                with np.errstate(divide="ignore", invalid="ignore"):
                    q2 = np.where(big > 0, np.round(BINS * np.log2(big / ctx)), -9999)
                    q1 = np.where(uni > 0, np.round(BINS * np.log2(uni / max(1, n_est))), -9999)
                u, n = np.unique(np.stack([bucket_of(ctx), q2, q1]).astype(np.int64), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in u), pa.array(n)], names=["b", "q2", "q1", "n"])

    # bins: under 64 buckets and some hundred values of each estimate, however large the corpus
    table = (blocks.where(F.col("role") == HELD).join(per_block, "block").mapInArrow(cells, "b bigint, q2 bigint, q1 bigint, n bigint")
             .groupBy("b", "q2", "q1").agg(F.sum("n").alias("n")).toPandas())
    weights = learn_weights(table.sort_values(["b", "q2", "q1"]).to_numpy(np.float64).reshape(-1, 4), uniform)
    settle(spark)

    def final(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                ctx, big, uni = counts.told(row, "every")
                lam = weights[bucket_of(ctx)]
                p = lam[:, 0] * (big / np.maximum(ctx, 1)) + lam[:, 1] * (uni / max(1, n_train)) + lam[:, 2] * uniform
                if not n_train:
                    p = np.full(len(uni), uniform)
                base = np.log10((uni + 0.1) / (n_train + 0.1 * (vocab + 1)))
                first = np.concatenate([[0], np.cumsum(row["sizes"])[:-1]]).astype(np.int64)
                n = len(first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index("ids")).slice(i, 1).flatten(), pa.array([row["role"] == TEST] * n),
                     pa.array(row["sizes"], pa.int64()), pa.array(np.add.reduceat((uni > 0).astype(np.int64), first)),
                     pa.array([n_train] * n, pa.int64()), pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(np.log10(p), first))],
                    names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return spread(blocks, 8.0 * sum(sums.values())).join(per_block, "block").mapInArrow(
        final, f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
