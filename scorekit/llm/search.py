"""Ranked lexical search by dense blocked matrix products.

The items are the query set. They are read in blocks of bounded size, and each block keeps its own compact
vocabulary: all documents are cut into terms once for a block, and only the counts of the block's terms are
written. A block is cut again into tiles of items, each with the terms of its items alone. A tile's weights
(terms x items) and the impacts of some thousand documents (documents x terms) are dense float64 matrices; one
BLAS product scores all of them at once. Weights and impacts are whole numbers, and a tile's terms are split so
that no partial sum of a product reaches 2^53, so float64 adds exactly; the products of the parts are added as
64-bit integers. Of a tile's documents the best of each item stay, equal scores by id, and a window merges them.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import begin, bytes_of, shared_table, word_pieces

# bytes to term bytes: A-Z lower-cased; ASCII letters, digits and all of UTF-8's other bytes are term bytes
TERM_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
UNIT = 1_000_000  # impacts stay below it
EXACT = (1 << 53) // UNIT  # largest sum of weights of one item in one product


def terms_of(text: bytes):
    """Lists of a text's terms, a long text in pieces."""
    yield from word_pieces(text.translate(TERM_TABLE))


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``100 - 75 + (75 * n * N) div L``; whole numbers of any size where 64 bits do not hold the product."""
    if len(n) and 75 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([25 + 75 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 25 + 75 * n.astype(np.int64) * n_docs // max(1, n_terms)


def make_tiles(items: list, weights: list, tile_items: int, tile_terms: int) -> list:
    """Tiles ``(first item, items, parts)`` of ``items``, a list of term counts. A part is ``(terms, matrix)``: the sorted
    terms and their float64 weights for the tile's items. Parts hold at most ``tile_terms`` terms, and the weights of
    one item in a part add up to at most ``EXACT``; a heavier single weight goes on in further parts."""
    tiles, first = [], 0
    while first < len(items):
        last, vocab = first, set()
        while last < len(items) and last - first < tile_items and (last == first or len(vocab | items[last].keys()) <= tile_terms):
            vocab |= items[last].keys()
            last += 1
        parts, sums = [], []  # of each part: cells by term; weight of each item
        for t in sorted(vocab):
            for k in range(first, last):
                left, p = items[k].get(t, 0) * weights[t], 0
                while left:
                    if p == len(parts):
                        parts.append({})
                        sums.append([0] * (last - first))
                    room = EXACT - sums[p][k - first]
                    if (t in parts[p] or len(parts[p]) < tile_terms) and room:
                        now = min(room, left)
                        parts[p].setdefault(t, [0] * (last - first))[k - first] += now
                        sums[p][k - first] += now
                        left -= now
                    p += 1
        tiles.append((first, last - first, [(np.array(sorted(c), np.int64), np.array([c[t] for t in sorted(c)], np.float64)) for c in parts]))
        first = last
    return tiles


def best_rows(scores: np.ndarray, least: np.ndarray, top: int) -> tuple:
    """(document, item) of the ``top`` scores of each column that are at least ``least``, the first of equal ones."""
    n = len(scores)
    if n > top:
        least = np.maximum(least, np.partition(scores, n - top, axis=0)[n - top])
    over, tie = scores > least, scores == least
    tie &= tie.cumsum(axis=0) <= top - over.sum(axis=0)
    doc, item = np.nonzero(over | tie)
    return doc, item, least


def _indexer(sent):
    def kernel(batches):
        vocab = sent.value
        get = vocab.get
        for b in batches:
            size, terms, counts = [], [], []
            for text in bytes_of(b):
                n, ids, tf = 0, [], []
                for words in terms_of(text):
                    n += len(words)
                    x = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                    u, c = np.unique(x[x >= 0], return_counts=True)
                    ids.append(u)
                    tf.append(c)
                if len(ids) > 1:
                    u, where = np.unique(np.concatenate(ids), return_inverse=True)
                    ids, tf = [u], [np.bincount(where, np.concatenate(tf)).astype(np.int64)]
                size.append(n)
                terms.append(ids[0].astype(np.int32).tobytes() if ids else b"")
                counts.append(tf[0].astype(np.int64).tobytes() if tf else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                                             names=["id", "n", "terms", "counts"])
    return kernel


def _frequencies(size):
    def kernel(batches):
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])
    return kernel


def _scorer(sent, n_docs, n_terms, size, top, cells):
    def kernel(batches):
        tiles = sent.value
        n_items = tiles[-1][0] + tiles[-1][1]
        least = np.ones(n_items, np.int64)  # of each item the lowest score that may still be among the best of this task
        widest = max([1, *(len(t) for _, _, parts in tiles for t, _ in parts), *(n for _, n, _ in tiles)])
        step = max(1, cells // widest)
        for whole in batches:
            # in order of the id, null last, so that the first of equal scores is the one to keep
            whole = whole.take(pc.sort_indices(whole.column(0), null_placement="at_end"))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                rows = b.num_rows
                blobs = b.column(2).to_pylist()
                term = np.frombuffer(b"".join(blobs), np.int32)
                tf = np.frombuffer(b"".join(b.column(3).to_pylist()), np.int64)
                doc = np.repeat(np.arange(rows), [len(x) // 4 for x in blobs])
                m = lengths(np.asarray(b.column(1)), n_docs, n_terms)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
                for first, n, parts in tiles:
                    scores = np.zeros((rows, n), np.int64)
                    for ids, matrix in parts:
                        col = np.full(size, -1, np.int64)
                        col[ids] = np.arange(len(ids))
                        col = col[term]
                        on = col >= 0
                        dense = np.zeros((rows, len(ids)))
                        dense[doc[on], col[on]] = impact[on]
                        scores += (dense @ matrix).astype(np.int64)
                    d, i, new = best_rows(scores, least[first:first + n], top)
                    least[first:first + n] = new
                    if len(d):
                        yield pa.RecordBatch.from_arrays([pa.array(i + first), b.column(0).take(pa.array(d)), pa.array(scores[d, i])],
                                                         names=["at", "id", "score"])
    return kernel


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           top: int = 10, block_bytes: int = 4 << 20, tile_items: int = 64, tile_terms: int = 2048, cells: int = 1 << 22) -> DataFrame:
    """``(item, rank, id, score)``: the ``top`` documents of every item with a score above 0, ranks from 1, equal scores by
    ascending id, null last.

    Terms are runs of ASCII letters, digits and other characters above ASCII, A-Z lower-cased; whole texts are read, in pieces where
    they are long. A null or empty text has no term: such a document is not counted, such an item finds nothing. Every
    row is a document, and every row of ``items`` an item of its own, repeated ids and texts too; rows equal in score and
    id are in any order. Empty tables give an empty result. Other columns are not read.

    One block of items (about ``block_bytes`` of text) is searched at a time; a product's document matrix has about
    ``cells`` cells."""
    spark = docs.sparkSession
    begin(spark)
    queries = shared_table(items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"),
                                        F.monotonically_increasing_id().alias("uid")).where("text <> ''"))
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_kind, item_kind = src.schema["id"].dataType.simpleString(), queries.schema["item"].dataType.simpleString()
    found = None
    for k in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == k).collect()  # about block_bytes
        part = _search_block(src, sorted(rows, key=lambda r: r["uid"]), id_kind, top, tile_items, tile_terms, cells)
        part = part if part is None or blocks == 1 else shared_table(part)
        found = part if found is None else found if part is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {id_kind}, score bigint")
    out = found.join(queries.select("uid", "item"), "uid")
    return out.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search_block(src, rows, id_kind, top, tile_items, tile_terms, cells):
    """``(uid, rank, id, score)`` of a block of items; None if none of them has a term."""
    spark = src.sparkSession
    vocab: dict = {}
    items, uids = [], []
    for r in rows:
        counts = Counter(vocab.setdefault(w, len(vocab)) for words in terms_of(r["text"].encode()) for w in words)
        if counts:
            items.append(counts)
            uids.append(r["uid"])
    if not items:
        return None
    sent = spark.sparkContext.broadcast(vocab)  # the terms of one block of items
    index = shared_table(src.mapInArrow(_indexer(sent), f"id {id_kind}, n bigint, terms binary, counts binary").where("n > 0"))
    sent.destroy()
    total = index.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = {r["term"]: r["df"] for r in index.select("terms").mapInArrow(_frequencies(len(vocab)), "term bigint, df bigint")
          .groupBy("term").agg(F.sum("df").alias("df")).collect()}  # at most the block's terms
    n_docs, n_terms = total["docs"], total["terms"] or 0
    weights = [term_weight(n_docs, df.get(t, 0)) for t in range(len(vocab))]
    tiles = spark.sparkContext.broadcast(make_tiles(items, weights, tile_items, tile_terms))
    hits = index.mapInArrow(_scorer(tiles, n_docs, n_terms, len(vocab), top, cells), f"at bigint, id {id_kind}, score bigint")
    place = F.row_number().over(W.partitionBy("at").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    best = hits.withColumn("rank", place).where(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(uids)), "at bigint, uid bigint")  # one row for each item of the block
    return best.join(F.broadcast(names), "at").select("uid", "rank", "id", "score")
