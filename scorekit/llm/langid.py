"""Language ID by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (n = 1 to 3, letters lower-cased,
words padded) in the training texts; a document's is the same list of its own. Their out-of-place distance
adds up, over the document's list, how far each n-gram's rank is from its rank in the language's profile;
one that the profile lacks costs the whole profile length. The nearest language wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import begin, bytes_of

BITS = 20  # of a code point in an n-gram code; every letter is below 2^20
NONE = "und"


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(1 << 18)), bool, 1 << 18)  # all letters are below 2^18


def grams(text: bytes, letter: np.ndarray, n_max: int = 3, at_once: int = 1 << 20) -> tuple:
    """Distinct n-gram codes of a text and their counts. A long text is counted in pieces that overlap
    by what an n-gram needs; the order n stands in the top bits of a code."""
    low = text.decode("utf-8", "replace").lower()
    found = []
    carry = np.zeros(1, np.uint64)  # the padding before the first word
    for at in range(0, max(1, len(low)), at_once):
        cp = np.frombuffer(low[at:at + at_once].encode("utf-32-le", "replace"), np.uint32)
        ok = letter[np.minimum(cp, len(letter) - 1)] & (cp < len(letter))
        x = np.where(ok, cp, 0).astype(np.uint64)
        if at + at_once >= len(low):
            x = np.append(x, np.uint64(0))
        x = np.concatenate([carry, x])
        x = x[np.concatenate([[True], (x[1:] > 0) | (x[:-1] > 0)])]  # one padding between words
        skip = len(carry) - 1
        codes = [x[skip + 1:][x[skip + 1:] > 0] | np.uint64(1 << 60)]
        for n in range(2, n_max + 1):
            if len(x) < n:
                continue
            parts = [x[k:len(x) - n + 1 + k] for k in range(n)]
            code = np.full(len(parts[0]), n << 60, np.uint64)
            for k, p in enumerate(parts):
                code |= p << np.uint64(BITS * (n - 1 - k))
            inner = np.ones(len(code), bool)
            for p in parts[1:-1]:
                inner &= p > 0
            lead = max(0, len(carry) - n + 1)  # n-grams wholly in what was carried are counted already
            inner[:lead] = False
            codes.append(code[inner])
        found.append(np.unique(np.concatenate(codes), return_counts=True))
        carry = x[-(n_max - 1):]
    if len(found) == 1:
        return found[0]
    return merge(found)


def merge(counted: list) -> tuple:
    codes, where = np.unique(np.concatenate([c for c, _ in counted]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([n for _, n in counted]), len(codes)).astype(np.int64)


def learn_profiles(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", top: int = 400) -> DataFrame:
    """``(lang, gram, rank)``: the ``top`` most frequent n-grams of every language in the training rows."""
    def kernel(batches):
        letter = letter_table()
        held, size = {}, 0

        def flush():
            for lang, counted in held.items():
                codes, n = merge(counted)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)),
                                                  pa.array(n)], names=["lang", "gram", "n"])
        for b in batches:
            for t, lang in zip(bytes_of(b, text_col), b.column(1).to_pylist()):
                counted = grams(t, letter)
                held.setdefault(lang, []).append(counted)
                size += len(counted[0])
                if size > 2_000_000:
                    held = {k: [merge(v)] for k, v in held.items()}
                    size = 0
                    if sum(len(v[0][0]) for v in held.values()) > 1_000_000:
                        yield from flush()
                        held = {}
        yield from flush()

    src = docs.where(train & F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col).cast("string"))
    counts = (src.mapInArrow(kernel, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    # the bare row number is compared, so that Spark limits every task to ``top`` rows a language before the shuffle
    return counts.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "gram", (F.col("rank") - 1).alias("rank"))


def predict(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", top: int = 400,
            max_languages: int = 10_000) -> DataFrame:
    """``(id, lang_pred, score)`` of every row. The profiles are a model of ``top`` rows for each language;
    it is sent to the tasks, and refused when it has more than ``max_languages`` languages."""
    langs = sorted(r.lang for r in profiles.select("lang").distinct().limit(max_languages + 1).collect())
    if len(langs) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    number = {lang: k for k, lang in enumerate(langs)}
    rows = profiles.collect()
    model = []
    for lang in langs:
        mine = sorted((r.gram, r.rank) for r in rows if number[r.lang] == number[lang])
        model.append((np.array([g for g, _ in mine], np.int64).view(np.uint64), np.array([k for _, k in mine], np.int64)))

    def judge(text, letter):
        codes, n = grams(text, letter)
        if not len(codes) or not model:
            return NONE, 0.0
        if len(codes) > top:  # the most frequent ones, ties by code
            floor = np.partition(n, len(n) - top)[len(n) - top]
            near = np.flatnonzero(n >= floor)
            codes, n = codes[near], n[near]
        mine = codes[np.lexsort((codes, -n))][:top]
        place, best = np.arange(len(mine)), None
        for k, (keys, ranks) in enumerate(model):
            at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            out = int(np.where(keys[at] == mine, np.abs(ranks[at] - place), top).sum()) if len(keys) else top * len(mine)
            if best is None or out < best[0]:
                best = out, k
        return langs[best[1]], 1.0 - best[0] / (top * len(mine))

    def kernel(batches):
        letter = letter_table()
        for b in batches:
            said = [judge(t, letter) for t in bytes_of(b, text_col)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s[0] for s in said], pa.string()),
                                              pa.array([s[1] for s in said], pa.float64())], names=[id_col, "lang_pred", "score"])

    src = docs.select(F.col(id_col), F.col(text_col))
    return src.mapInArrow(kernel, f"`{id_col}` {src.schema[0].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             top: int = 400) -> DataFrame:
    """``(id, held_out, lang_pred, score)``: profiles learned from the rows where the column expression
    ``held_out`` is false and the language is known, applied to every row.

    ``score`` is 1 minus the distance as a share of the largest possible. A null text, one without a letter,
    or any text if nothing could be learned, is ``und`` with score 0. Equal distances go to the language
    that sorts first. Repeated rows stay; other columns are not read; an empty table gives an empty result."""
    begin(docs.sparkSession)
    profiles = learn_profiles(docs, ~held_out, text_col, lang_col, top)
    # the flag depends on the id alone, so it can be set after the prediction
    return predict(docs, profiles, id_col, text_col, top).select(id_col, held_out.alias("held_out"), "lang_pred", "score")
