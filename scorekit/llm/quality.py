"""Quality rules: repetition inside a document, from a suffix array over its words.

The suffixes of every document are sorted by prefix doubling; groups of one are settled and left
alone. Where a doubling splits a group, neighbours in the suffix array get their longest common prefix
(LCP) from the ranks of the levels below. The LCP intervals of ``min_words`` or more are the maximal
repeated substrings; the union of their spans gives the covered fraction, their largest LCP the longest
repeat. Documents are judged one by one inside Spark tasks; nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import begin, bytes_of, word_pieces

SYMBOLS = b"#*$%&|<>"  # fixed value


def longest_repeats(words: np.ndarray, doc: np.ndarray, min_words: int) -> np.ndarray:
    """For every word position the length of the longest repeat that starts there: the larger LCP with
    a neighbour in the suffix array of its document. Below ``min_words`` it is 0."""
    n = len(words)
    best = np.zeros(n, np.int64)
    if not n:
        return best
    end = np.searchsorted(doc, doc, "right")
    key = doc.astype(np.int64) * (int(words.max()) + 1) + words
    alive, h, levels = np.arange(n), 1, []
    rank = np.zeros(n, np.int64)
    old = np.zeros(n, np.int64)
    while True:
        # sort the open suffixes; a rank is the place in the suffix array where its group starts
        order = np.argsort(key, kind="stable")
        idx, k, was = alive[order], key[order], old[order]
        split = np.ones(len(k), bool)
        split[1:] = k[1:] != k[:-1]
        same = np.ones(len(k), bool)
        same[1:] = was[1:] != was[:-1]
        if levels and 2 * h > min_words:  # neighbours that part at this depth: the LCP is h .. 2h - 1
            cut = np.flatnonzero(split & ~same)
            if len(cut):
                a, b = idx[cut - 1], idx[cut]
                lcp = _lcp(a, b, end, levels)
                np.maximum.at(best, a, lcp)
                np.maximum.at(best, b, lcp)
        place = np.arange(len(k))
        start = np.maximum.accumulate(np.where(same, place, 0))
        rank[idx] = was + np.maximum.accumulate(np.where(split, place, 0)) - start
        heads = np.flatnonzero(split)
        many = np.repeat(np.diff(np.append(heads, len(k))) > 1, np.diff(np.append(heads, len(k))))
        alive = np.sort(idx[many])
        if not len(alive):
            break
        h = 2 * h if levels else 1
        levels.append((h, rank.astype(np.int32) if n < 2 ** 31 else rank.copy()))
        nxt = alive + h
        ok = nxt < end[alive]
        second = np.where(ok, rank[np.minimum(nxt, n - 1)] + 1, 0)
        old = rank[alive]
        key = old * (n + 1) + second
    best[best < min_words] = 0
    return best


def _lcp(a, b, end, levels):
    """LCP of suffix pairs, by equal ranks at falling depths."""
    lcp = np.zeros(len(a), np.int64)
    for h, rank in reversed(levels):
        x, y = a + lcp, b + lcp
        ok = (x + h <= end[a]) & (y + h <= end[b])
        eq = rank[np.where(ok, x, 0)] == rank[np.where(ok, y, 0)]
        lcp += np.where(ok & eq, h, 0)
    return lcp


def measure(texts: list, min_words: int = 5, words_at_once: int = 400_000) -> dict:
    """Arrays of the measures of each text."""
    out = {c: np.zeros(len(texts), np.int64) for c in
           ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_chars", "longest_repeat")}
    todo, parts, held, vocab = [], [], 0, None

    def flush():
        doc = np.repeat(np.arange(len(todo)), [out["n_words"][i] for i in todo])
        words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        best = longest_repeats(words, doc, min_words)
        at = np.flatnonzero(best)
        if not len(at):
            return
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + best[at], -1)
        covered = np.flatnonzero(np.cumsum(depth)[:-1] > 0)
        chars = np.array([len(w.decode("utf-8", "replace")) for w in vocab], np.int64)
        mine = np.array(todo)
        out["n_repeat_words"][mine] = np.bincount(doc[covered], minlength=len(todo))
        out["repeat_chars"][mine] = np.bincount(doc[covered], chars[words[covered]], len(todo)).astype(np.int64)
        longest = np.zeros(len(todo), np.int64)
        np.maximum.at(longest, doc[at], best[at])
        out["longest_repeat"][mine] = longest

    for i, t in enumerate(texts):
        if vocab is None:
            vocab = defaultdict()
            vocab.default_factory = vocab.__len__
        for words in word_pieces(t):
            joined = b"".join(words)
            out["word_chars"][i] += len(joined.decode("utf-8", "replace"))
            out["n_symbols"][i] += len(joined) - len(joined.translate(None, SYMBOLS))
            out["n_words"][i] += len(words)
            parts.append(np.fromiter(map(vocab.__getitem__, words), np.int64, len(words)))
        lines = [x for x in t.split(b"\n") if x.strip()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        todo.append(i)
        held += out["n_words"][i]
        if held >= words_at_once:
            flush()
            todo, parts, held, vocab = [], [], 0, None
    if todo:
        flush()
    return out


def verdicts(m: dict, min_total: int, max_base: int, max_covered: float, max_longest: int) -> tuple:
    base = (m["n_words"] < min_total) | (100 * m["n_repeat_words"] > max_base * m["n_words"])
    bad = (m["repeat_chars"] > max_covered * m["word_chars"]) | (m["longest_repeat"] > max_longest)
    return base, ~base & ~bad


COLS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, " \
       "repeat_chars bigint, longest_repeat bigint, kept boolean"


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5, min_total: int = 10,
           max_base: int = 20, max_covered: float = 0.2, max_longest: int = 100) -> DataFrame:
    """The measures and the verdict of every row.

    ``base_failed``: fewer than ``min_total`` words, or more than ``max_base`` percent of the words in
    repeats of ``min_words`` words. ``kept``: not base_failed, at most ``max_covered`` of the word
    characters in such repeats, none of them longer than ``max_longest`` words. A null text counts as
    empty and fails. Rows are judged alone: repeated rows and ids stay as they are; other columns are not
    read; an empty table gives an empty result."""
    begin(docs.sparkSession)

    def kernel(batches):
        for b in batches:
            m = measure(bytes_of(b, text_col), min_words)
            m["base_failed"], m["kept"] = verdicts(m, min_total, max_base, max_covered, max_longest)
            names = [c.split()[0] for c in COLS.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[c]) for c in names)], names=[id_col, *names])

    src = docs.select(F.col(id_col), F.col(text_col))
    return src.mapInArrow(kernel, f"`{id_col}` {src.schema[0].dataType.simpleString()}, {COLS}")


def passing(docs: DataFrame, text_col: str = "text", min_words: int = 5, min_total: int = 10, max_base: int = 20,
            max_covered: float = 0.2, max_longest: int = 100) -> DataFrame:
    """The rows that ``assess`` keeps, all columns as they are, whatever their names."""
    begin(docs.sparkSession)
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_col)}"

    def kernel(batches):
        for b in batches:
            m = measure(bytes_of(b, text), min_words)
            yield b.filter(pa.array(verdicts(m, min_total, max_base, max_covered, max_longest)[1]))

    return plain.mapInArrow(kernel, T.StructType([T.StructField(f.name, f.dataType) for f in plain.schema])).toDF(*docs.columns)
