"""Toxicity by a gappy subsequence string kernel and a linear machine on Nyström landmarks.

The kernel of two strings adds up, over all subsequences of four letters whose neighbours are at most one
character apart, the product of their weights ``decay ** gaps``; so an insult with a character inserted
between its letters still shares most of its subsequences with the insult itself. Landmarks are short
strings of the labelled sentences. The Nyström map turns the kernel values with the landmarks into
features; a support vector machine (squared hinge loss) separates windows of sentences of toxic documents from
windows of clean ones, again with the hardest clean windows added. The machine is linear in the kernel's
features, so it folds into one weight for each subsequence, and scoring every window of every text is a
table look-up. A document's score is the larger of two logistic functions: of its worst window, and of
its worst window together with the mean of its worst fiftieth, which speaks for milder but frequent insults.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import begin, bytes_of

STEPS = (1, 2)  # distance between neighbouring letters of a subsequence
PATTERNS = tuple((0, a, a + b, a + b + c) for a in STEPS for b in STEPS for c in STEPS)
REACH = max(p[-1] for p in PATTERNS)
TABLE = 1 << 20


def symbol_table() -> np.ndarray:
    """Symbols of code points: a to z 1 to 26, other letters 27 to 31, everything else 0."""
    out = np.zeros(1 << 18, np.uint8)
    for cp in range(1 << 18):
        c = chr(cp)
        if "a" <= c <= "z":
            out[cp] = cp - 96
        elif c.isalpha():
            out[cp] = 27 + cp % 5
    return out


def symbols(text: bytes, table: np.ndarray) -> np.ndarray:
    """Symbols of a text, lower-cased, runs of other characters as one 0."""
    cp = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), np.uint32)
    s = table[np.minimum(cp, len(table) - 1)]
    if len(cp) and int(cp.max()) >= len(table):
        s[cp >= len(table)] = 0
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
    s = s[keep]
    if len(s) < 5:
        return s
    # single letters set apart one by one (d-o-g, d o g) are one string
    gap = np.zeros(len(s) + 2, bool)
    gap[1:-1] = s == 0
    gap[[0, -1]] = True
    alone = ~gap[1:-1] & gap[:-2] & gap[2:]
    joint = np.zeros(len(s), bool)
    joint[1:-1] = gap[2:-2] & alone[:-2] & alone[2:]
    return s[~joint]


def disturbed(s: np.ndarray, at: int, window: int, rng) -> np.ndarray:
    """The surroundings of a window with one character, a letter or none, put between two of its letters."""
    lo, hi = max(0, at - window), at + 2 * window
    inner = [k for k in range(at, min(at + window, len(s) - 1)) if s[k] and s[k + 1]]
    if not inner:
        return s[lo:hi]
    k = int(rng.choice(inner))
    return np.concatenate([s[lo:k + 1], [np.uint8(rng.integers(0, 27))], s[k + 1:hi]]).astype(np.uint8)


def subsequences(s: np.ndarray, decay: float):
    """For every pattern the code of the subsequence that starts at each position (0: none) and its weight."""
    x = np.concatenate([s, np.zeros(REACH, np.uint8)]).astype(np.int32)
    n = len(s)
    for p in PATTERNS:
        parts = [x[k:k + n] for k in p]
        code = (parts[0] << 15) | (parts[1] << 10) | (parts[2] << 5) | parts[3]
        yield code, decay ** (p[-1] - 3), parts


def features(s: np.ndarray, decay: float) -> dict:
    """Weights of the subsequences of a short string."""
    out: Counter = Counter()
    for code, w, parts in subsequences(s, decay):
        ok = (parts[0] > 0) & (parts[1] > 0) & (parts[2] > 0) & (parts[3] > 0)
        for c in code[ok].tolist():
            out[c] += w
    return out


def window_scores(s: np.ndarray, weights: np.ndarray, decay: float, window: int) -> np.ndarray:
    """Value of the machine (without bias) for the window of ``window`` starts at each position."""
    one = np.zeros(len(s), np.float32)
    for code, w, _ in subsequences(s, decay):
        one += np.float32(w) * weights[code]
    total = np.concatenate([[0.0], np.cumsum(one, dtype=np.float64)])
    end = np.minimum(np.arange(len(s)) + window, len(s))
    return total[end] - total[:-1]


@dataclass
class Model:
    weights: np.ndarray  # of every subsequence code
    worst: tuple  # logistic function of the worst window: slope and shift
    spread: tuple  # of the worst window and the worst fiftieth: slopes and shift
    decay: float
    window: int
    prior: float  # score of a text without a letter


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 30) -> tuple:
    """Squared-hinge linear machine by Newton steps on the violating rows."""
    x = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) / c
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        on = y * (x @ w) < 1
        a = x[on] * weight[on, None]
        new = np.linalg.solve(ridge + a.T @ x[on], a.T @ y[on])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], w[-1]


def fit(toxic: list, clean: list, share: float, decay: float = 0.7, window: int = 10, landmarks: int = 200, extra: int = 3, seed: int = 7) -> Model:
    """Learn from texts (bytes) of labelled documents; ``share`` is the toxic share of all labels."""
    table, rng = symbol_table(), np.random.default_rng(seed)
    flat = Model(np.zeros(TABLE, np.float32), (0.0, _logit(share)), (0.0, 0.0, _logit(share)), decay, window, share)
    if not toxic or not clean:
        return flat
    # sentences carry the label of their document; their words, each with what follows it, are the strings. Those that
    # set toxic documents apart come first among the landmarks, however many labels there are
    n_t, n_c = len(toxic), len(clean)
    df_t, df_c = (_word_documents(texts) for texts in (toxic, clean))
    gap = {}
    for w, a in df_t.items():
        if len(w) >= 4:
            p, q = (a + .5) / (n_t + 1), (df_c[w] + .5) / (n_c + 1)
            gap[w] = (p - q) / np.sqrt(p / n_t + q / n_c)
    bad = [w for w in sorted(gap, key=lambda w: (-gap[w], w)) if gap[w] > 0][:landmarks * 3 // 4]
    other = sorted(w for w in df_c if w not in gap and len(w) >= 4)
    good = [other[i] for i in sorted(rng.choice(len(other), min(len(other), landmarks - len(bad)), replace=False))] if other else []
    del df_t, df_c
    maps = [f for f in (features(symbols(w, table), decay) for w in [*bad, *good]) if f]
    if not maps:
        return flat
    rows = sorted({c for f in maps for c in f})
    row_of = np.full(TABLE, len(rows), np.int32)
    row_of[rows] = np.arange(len(rows))
    phi = np.zeros((len(rows) + 1, len(maps)), np.float32)  # the last row: subsequences that no landmark has
    for j, f in enumerate(maps):
        norm = np.sqrt(sum(v * v for v in f.values()))
        for c, v in f.items():
            phi[row_of[c], j] = v / norm
    val, vec = np.linalg.eigh((phi.T @ phi).astype(np.float64))
    ok = val > 1e-6 * val.max()
    root = (vec[:, ok] / np.sqrt(val[ok])) @ vec[:, ok].T

    texts = [symbols(t, table) for t in [*toxic, *clean]]

    def nystrom(at: list) -> np.ndarray:
        """Features of windows (text, start)."""
        out = np.zeros((len(at), len(maps)), np.float32)
        for i, (k, a) in enumerate(at):
            s = texts[k][a:a + window + REACH]
            for code, w, _ in subsequences(s, decay):
                out[i] += w * phi[row_of[code[:window]]].sum(axis=0)
        return out @ root

    # first windows: the words that set toxic documents apart, each by how far it does, against random words of clean ones
    guess = np.zeros(TABLE, np.float32)
    for w in bad:
        for c, v in features(symbols(w, table), decay).items():
            guess[c] += v * gap[w] * gap[w]
    best = [int(np.argmax(v)) if len(v) else 0 for v in (window_scores(s, guess, decay, window) for s in texts)]
    first = n_t + n_c  # behind the documents: windows of toxic ones with a character inserted
    texts += [disturbed(texts[k], best[k], window, rng) for k in range(n_t) for _ in range(extra)]
    best += [int(np.argmax(v)) if len(v) else 0 for v in (window_scores(s, guess, decay, window) for s in texts[first:])]
    toxic_at = [k for k in (*range(n_t), *range(first, len(texts))) if len(texts[k])]
    pos = [(k, best[k]) for k in toxic_at]
    neg = [(k, int(a)) for k in range(n_t, n_t + n_c) if len(texts[k]) for a in rng.integers(0, len(texts[k]), 3)]
    neg += [(k, best[k]) for k in range(n_t, n_t + n_c) if len(texts[k])]
    weights = guess
    for _ in range(3):
        neg = list(dict.fromkeys(neg))
        z = nystrom(pos + neg)
        y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg))])
        w, _ = _svm(z, y, np.where(y > 0, len(neg) / max(1, len(pos)), 1.0) ** 0.5)
        weights = np.zeros(TABLE, np.float32)
        weights[rows] = (phi[:-1] @ (root @ w)).astype(np.float32)
        best = [int(np.argmax(v)) if len(v) else 0 for v in (window_scores(s, weights, decay, window) for s in texts)]
        pos = [(k, best[k]) for k in toxic_at]  # each toxic document is toxic by its worst window
        neg += [(k, best[k]) for k in range(n_t, n_t + n_c) if len(texts[k])]
    x = np.array([levels([v]) if len(v) else (0.0, 0.0) for v in (window_scores(s, weights, decay, window) for s in texts[:first])])
    y = np.arange(first) < n_t
    weight = np.where(y, share / n_t, (1 - share) / n_c)
    return Model(weights, _logistic(x[:, :1], y, weight), _logistic(x, y, weight), decay, window, share)


def levels(pieces: list) -> tuple:
    """The largest window value and the mean of the largest fiftieth of the whole text, in one or more pieces."""
    v = np.concatenate(pieces)
    n = max(1, len(v) // 50)
    v.partition(len(v) - n)
    top = v[len(v) - n:]
    return float(top.max()), float(top.mean())


def _word_documents(texts: list) -> Counter:
    """Number of texts in whose sentences a word stands."""
    out: Counter = Counter()
    for t in texts:
        out.update({w for s in re.split(rb"[.!?\n]", t) for w in re.findall(rb"[^\x00-@\[-`{-\x7f]+", s.lower())})
    return out


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple:
    """Slopes and shift of a weighted logistic regression (damped Newton on scaled columns)."""
    mid, unit = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.concatenate([(x - mid) / unit, np.ones((len(x), 1))], axis=1)
    w = np.zeros(a.shape[1])
    weight = weight / weight.sum()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-5 * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (weight * (p - y)) + 1e-5 * w)
        w = w - step / max(1.0, np.abs(step).max() / 3)
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[:-1] / unit
    return (*(float(v) for v in slopes), float(w[-1] - slopes @ mid))


def judge(model: Model, pieces: list) -> float:
    x = levels(pieces)
    z = max(model.worst[0] * x[0] + model.worst[1], model.spread[0] * x[0] + model.spread[1] * x[1] + model.spread[2])
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def sample(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, label_col: str, toxic_docs: int,
           clean_docs: int, most_bytes: int) -> tuple:
    """Texts of at most ``toxic_docs`` and ``clean_docs`` labelled training documents, the first by hash of
    the id among those of up to ``most_bytes`` bytes, and the toxic share of all training labels."""
    lab = labels.where(train & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_toxic"))
    counts = {r["_toxic"]: r["n"] for r in lab.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = []
    for label, most in ((1, toxic_docs), (0, clean_docs)):
        ids = lab.where(F.col("_toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(most).select("_id")
        d = docs.where(F.octet_length(text_col).between(1, most_bytes)).select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t"))
        rows = d.join(F.broadcast(ids), F.col("_d") == F.col("_id")).groupBy("_d").agg(F.min("_t").alias("_t")).collect()  # at most ``most`` rows
        texts.append([r["_t"].encode() for r in sorted(rows, key=lambda r: r["_d"])])
    total = sum(counts.values())
    return texts[0], texts[1], counts.get(1, 0) / total if total else 0.0


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", at_once: int = 1 << 20) -> DataFrame:
    """``(id, score)`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(astuple(model))  # plain values, so that a task needs nothing to read them

    def pieces(text, m, table):
        """Window values; a long text in pieces that overlap by a window."""
        s = symbols(text, table)
        lap = m.window + REACH
        return [window_scores(s[a:a + at_once + lap], m.weights, m.decay, m.window)[:at_once] for a in range(0, len(s), at_once)] if s.any() else []

    def kernel(batches):
        m, table = Model(*sent.value), symbol_table()
        for b in batches:
            values = (pieces(t, m, table) for t in bytes_of(b, text_col))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([judge(m, v) if v else m.prior for v in values], pa.float64())],
                                             names=[id_col, "score"])

    src = docs.select(F.col(id_col), F.col(text_col))
    return src.mapInArrow(kernel, f"`{id_col}` {src.schema[0].dataType.simpleString()}, score double")


def score(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_docs: int = 2000, clean_docs: int = 4000, most_bytes: int = 20_000) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row, learned from labelled rows where the column
    expression ``held_out`` is false.

    The machine is fitted on a bounded sample of labelled documents (the three limits); every text is scored
    whole. A null text, or one without a letter, has the toxic share of the training labels as its score; so
    has every text when a class is missing. A repeated label counts as toxic if any of its rows is. Repeated
    documents stay; other columns are not read; an empty table gives an empty result."""
    begin(docs.sparkSession)
    toxic, clean, share = sample(docs, labels, ~held_out, id_col, text_col, label_col, toxic_docs, clean_docs, most_bytes)
    out = predict(docs, fit(toxic, clean, share), id_col, text_col)
    return out.select(id_col, held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
