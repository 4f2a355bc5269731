"""Phrase collocations counted by double-array tries.

Documents become blocks: words of one language as numbers, with a 0 wherever no phrase may pass (the end of a
piece, a word that is too rare to stand in any candidate). Phrases are found level by level, and a candidate is
Apriori-safe: a phrase of k words counts only if its first and its last k - 1 words were frequent enough, and the
hash bucket that it shares with other phrases was too. The candidates of a level, gathered from
the blocks, are cut by their first words into waves of bounded size. Each wave is a double-array trie over word
numbers, broadcast; a task starts the positions whose word can begin a phrase of the wave at the root, so that all waves together
start each position about once, and moves many states on together, symbol by symbol
(``state = base[state] + symbol``, kept where ``check`` names the state it came from), counts the phrases of the accepting
states, and the tasks' counts are added up by Spark. Scores are exact decimals.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import UPPER, begin, bounded, bytes_of, shared_table
from .lm import pack, unpack

SEPARATORS = ".,;:!?\n\x0b\x0c\r"
PLACES = 1 << 17  # of a text that a kernel works on at once: its arrays are of this length, not of a block's
SHIFTS = 20, 10, 0  # of a word's digits in its code
SIDE_BYTES = 4 << 20  # of a side that may be broadcast: a dozen joins do
END = ord(",")  # a separator, so no word holds it
# bytes to bytes: A-Z lower-cased, every separator as one and the same, a tab as a space
PIECE_TABLE = bytes(END if chr(c) in SEPARATORS else c + 32 if chr(c) in UPPER else 32 if c == 9 else c for c in range(256))


def word_arrays(text: bytes, at_once: int = 1 << 20):
    """Arrow arrays of the words of a text, ``b","`` standing for a separator; a long text in pieces cut at spaces or separators."""
    text = text.translate(PIECE_TABLE)
    at = 0
    while at < len(text):
        end = at + at_once
        if end < len(text):
            cuts = [k for k in (text.find(c, end) for c in (b" ", b",")) if k >= 0]
            end = min(cuts) if cuts else len(text)
        words = pc.split_pattern(pa.array([text[at:end].replace(b",", b" , ")], pa.binary()), b" ").flatten()
        yield words.filter(pc.greater(pc.binary_length(words), 0))
        at = end


def numbered(words: list) -> tuple:
    """The distinct words of arrays, and each word's number among them from 1; 0 for a separator."""
    coded = pa.chunked_array(words, pa.binary()).dictionary_encode().chunks  # all share the last one's dictionary
    found = coded[-1].dictionary
    own = pc.not_equal(found, b",").to_numpy(zero_copy_only=False)
    number = np.cumsum(own, dtype=np.uint32) * own
    return found.filter(pa.array(own)).cast(pa.string()), np.concatenate([number.take(c.indices.to_numpy()) for c in coded])


def build_blocks(docs: DataFrame, text_col: str, lang, block_tokens: int, at_once: int = 1 << 20) -> DataFrame:
    """Blocks ``(block, lang, words, tokens, n)``: the words of a block, its tokens as numbers of them (0: a separator or
    the end of a document), and how many of the tokens are words. Texts are cut into words ``at_once`` bytes at a time."""
    src = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))

    def kernel(batches):
        open_ = {}  # of each language its word arrays and number of tokens
        whole = max(1, min(at_once, 2 * block_tokens))  # bytes of texts, after which a block may end

        def close(name):
            words, tokens = numbered(open_.pop(name)[0])
            pa.default_memory_pool().release_unused()  # else the pool keeps a block's words as long as the worker lives
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.ListArray.from_arrays([0, len(words)], words), pa.array([pack(tokens)], pa.binary()),
                 pa.array([int((tokens > 0).sum())], pa.int64())], names=["lang", "words", "tokens", "n"])

        def add(name, texts):
            held = open_.setdefault(name, [[], 0])
            for words in word_arrays(b",".join([*texts, b""])):
                held[0].append(words)
                held[1] += len(words)
            if held[1] >= block_tokens:
                yield close(name)
            elif sum(h[1] for h in open_.values()) >= 4 * block_tokens:  # many languages share the room of four blocks
                yield close(max(open_, key=lambda x: open_[x][1]))
        for b in batches:
            read = {}  # of each language its texts not yet cut, and their bytes
            for name, t in zip(b.column(0).to_pylist(), bytes_of(b)):
                texts = read.setdefault(name, [[], 0])
                texts[0].append(t)
                texts[1] += len(t)
                if texts[1] >= whole:
                    yield from add(name, read.pop(name)[0])
            for name, (texts, _) in read.items():
                yield from add(name, texts)
        for x in list(open_):
            yield close(x)

    blocks = src.mapInArrow(kernel, "lang string, words array<string>, tokens binary, n bigint")
    return blocks.select(F.monotonically_increasing_id().alias("block"), "*")


class Trie:
    """Builds the arrays of a double-array trie; only the arrays are sent.

    A word is three symbols, the digits of its rank by frequency, so that a node has few children, close together.
    State 0 is the root, the last state is dead: no state is its child. A node's children stand at
    ``base[node] + symbol`` where ``check`` holds the node. Nodes with many children get a window of their own; the
    others, larger ones first, fill the holes: all nodes of like size try random bases at once, those whose
    places are free and not claimed by an earlier one stay, the rest try again."""

    def __init__(self, phrases: np.ndarray, seed: int = 1):
        alphabet, n = np.unique(phrases, return_counts=True)
        rank = np.empty(len(n), np.int32)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(n))
        a = max(2, math.ceil(round(len(n) ** (1 / 3), 6)))
        code = np.full(int(alphabet.max(initial=0)) + 2, -1, np.int32)  # of each word number its three digits, 10 bits each; -1: not in the trie
        code[alphabet] = rank // (a * a) << 20 | rank // a % a << 10 | rank % a
        self.words = code, len(n), a
        width = a + 1
        symbols = [d for k in range(phrases.shape[1]) for d in symbols_of(phrases[:, k], self.words)]
        self.base, self.check = np.zeros(width, np.int32), np.full(width, -1, np.int32)
        self.used, self.rng = width, np.random.default_rng(seed)
        state = symbols[0].astype(np.int64)
        self.check[state] = 0
        for symbol in symbols[1:]:
            edge, inverse = np.unique(state * width + symbol, return_inverse=True)
            state = self.place(edge // width, edge % width)[inverse]
        self.slots = state
        self.base[state] = np.arange(len(state))  # a phrase's last state has no children: its base is the phrase's number
        self.base, self.check = np.append(self.base, np.int32(0)), np.append(self.check, np.int32(-1))

    def arrays(self) -> tuple:
        return *self.words, self.base, self.check, self.slots

    def grow(self, size: int):
        more = max(0, size - len(self.base))
        self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def put(self, parent: np.ndarray, edge: np.ndarray, at: np.ndarray, out: np.ndarray):
        self.check[at] = parent[edge]
        out[edge] = at
        self.used += len(at)

    def place(self, parent: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """States of the edges (parent, symbol), sorted by parent."""
        node, first, size = np.unique(parent, return_index=True, return_counts=True)
        out = np.zeros(len(parent), np.int64)
        a = self.words[2]

        def edges(nodes):
            n = size[nodes]
            return n, np.repeat(first[nodes] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))

        wide = size * size >= 3.5 * a  # a window costs a places, chance some size^2 / 3.5
        own = np.flatnonzero(wide)
        hi = len(self.base)
        self.grow(hi + len(own) * a)
        base = hi - 1 + a * np.arange(len(own))
        n, edge = edges(own)
        self.base[node[own]] = base
        self.put(parent, edge, np.repeat(base, n) + symbol[edge], out)
        for power in range(int(size[~wide].max(initial=1)).bit_length(), 0, -1):
            todo = np.flatnonzero(~wide & (size >= 1 << (power - 1)) & (size < 1 << power))
            load = min(0.6, 1 - 0.025 ** (1 / ((1 << power) - 1)))  # at which one base in 40 still fits
            self.grow(a + 1 + math.ceil((self.used + int(size[todo].sum())) / load))
            while len(todo):
                base = self.rng.integers(0, len(self.base) - a, len(todo))
                n, edge = edges(todo)
                at = np.repeat(base, n) + symbol[edge]
                owner = np.repeat(np.arange(len(todo), dtype=np.int32), n)
                claim = np.empty(len(self.base), np.int32)
                claim[at[::-1]] = owner[::-1]  # the first of equal places is written last
                lost = np.add.reduceat((self.check[at] != -1) | (claim[at] != owner), np.cumsum(n) - n) > 0
                stays = ~np.repeat(lost, n)
                self.base[node[todo[~lost]]] = base[~lost]
                self.put(parent, edge[stays], at[stays], out)
                if 40 * (~lost).sum() < len(todo):
                    self.grow(len(self.base) * 11 // 10 + a)
                todo = todo[lost]
        return out


def symbols_of(ids: np.ndarray, words: tuple) -> tuple:
    """The three symbols of each word number, from 1; 0 for words that the trie does not know."""
    code = words[0].take(ids, mode="clip")
    return tuple(np.where(code >= 0, (code >> shift & 1023) + 1, 0) for shift in SHIFTS)


def reach(trie: tuple, ids: np.ndarray, words: int, at: np.ndarray) -> tuple:
    """Those of the places ``at`` where a phrase of the trie starts, and the states after its words. Places that leave the trie
    are dropped on the way, so most cost a symbol or two."""
    code, (base, check) = trie[0], trie[3:5]
    at = at[:np.searchsorted(at, len(ids) - words, "right")]
    state = np.zeros(len(at), np.int32)
    for k in range(words):
        symbols = code.take(ids.take(at + k), mode="clip")
        for shift in SHIFTS:
            if shift == SHIFTS[0]:  # unknown words go no further
                to = base.take(state) + (symbols >> shift) + 1
                live = np.flatnonzero((symbols >= 0) & (check.take(to) == state))
            else:
                to = base.take(state) + (symbols >> shift & 1023) + 1
                live = np.flatnonzero(check.take(to) == state)
            if len(live) < len(at):
                at, symbols, to = at.take(live), symbols.take(live), to.take(live)
            state = to
    return at, state


def advance(trie: tuple, ids: np.ndarray, words: int, at_once: int = PLACES) -> np.ndarray:
    """The state in which each position of the text ends after ``words`` words from the root, ``at_once`` positions at a time."""
    out = np.empty(len(ids), np.int32)
    for at in range(0, len(ids), at_once):
        out[at:at + at_once] = _advance(trie, ids[at:at + at_once + words - 1], words)[:at_once]
    return out


def _advance(trie: tuple, ids: np.ndarray, words: int) -> np.ndarray:
    state = np.full(len(ids), len(trie[3]) - 1, np.int32)
    at, ends = reach(trie, ids, words, np.arange(len(ids)))
    state[at] = ends
    return state


def in_range(ids: np.ndarray, low: int, high: int) -> list:
    """Places, in pieces, of the words ``low`` to ``high``: phrases of a wave start there and nowhere else."""
    return _pieces(np.flatnonzero((ids >= low) & (ids <= high)))


def _ids(batch):
    for blob in batch.column(batch.schema.get_field_index("ids")).to_pylist():
        yield unpack(blob, np.int32)


def bucket_of(ids: np.ndarray, at: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Hash bucket of the ``k`` words at each place."""
    h = np.zeros(len(at), np.uint64)
    for i in range(k):
        h = (h ^ (ids[at + i].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(64 - bits)).astype(np.int64)


def _pieces(at: np.ndarray) -> list:
    """Places in pieces of at most ``PLACES``, one at least."""
    return [at[i:i + PLACES] for i in range(0, max(1, len(at)), PLACES)]


def _flagged(packed: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the packed flag of each bucket is set."""
    return (packed[h >> 3] >> (7 - (h & 7)).astype(np.uint8)) & 1 > 0


def add_capped(seen: np.ndarray, h: np.ndarray, cap: int, own: int) -> None:
    """Count the buckets ``h`` in ``seen``, up to ``cap``: a byte each, or half a byte each (``own``: 1), the even bucket in the low half."""
    shift = ((h & own) << 2).astype(np.uint8)
    u, c = np.unique(h[(seen.take(h >> own) >> shift & (15 if own else 255)) < cap], return_counts=True)  # a bucket that has enough stays as it is
    for half in range(1 + own):
        on = u & own == half
        at, more = u[on] >> own, c[on]
        old = seen[at]
        n = old >> 4 * half & 15 if own else old
        seen[at] = old + ((np.minimum(n + more, cap) - n) << 4 * half).astype(np.uint8)


def bucket_filter(coded: DataFrame, k: int, sites: list, n: int, least: int, most_bits: int, slice_bits: int = 16):
    """``(bits, packed flags)``, broadcast: the hash buckets in which at least ``least`` of the phrases at ``sites`` fall. A
    phrase that is frequent enough is in such a bucket. At most 2^``most_bits`` buckets, whatever the corpus."""
    bits = min(most_bits, max(slice_bits, math.ceil(math.log2(max(2, n))) - 2))
    slice_bits = min(slice_bits, bits)
    cap = min(least, 255)  # sums of what is cut off here reach the limit just the same
    own = 1 if cap <= 15 else 0  # two counts share a byte where they fit

    def counter(site):
        def count(batches):
            seen = np.zeros(1 << bits - own, np.uint8)
            for batch in batches:
                for ids in _ids(batch):
                    for at in _pieces(site(ids)):
                        add_capped(seen, bucket_of(ids, at, k, bits), cap, own)
            parts = seen.reshape(-1, 1 << slice_bits - own)
            for j in np.flatnonzero(parts.any(axis=1)):
                counts = np.stack([parts[j] & 15, parts[j] >> 4], axis=1).ravel() if own else parts[j]
                yield pa.RecordBatch.from_arrays([pa.array([int(j)], pa.int64()), pa.array([pack(counts)], pa.binary())], names=["slice", "counts"])
        return count

    def add(table):
        total = np.zeros(1 << slice_bits, np.int64)
        for blob in table["counts"].to_pylist():
            total += unpack(blob, np.uint8)
        return pa.table({"slice": table["slice"][:1], "flags": pa.array([np.packbits(total >= cap).tobytes()], pa.binary())})

    flags = np.zeros((1 << bits - slice_bits, (1 << slice_bits) // 8), np.uint8)
    counts = reduce(DataFrame.unionByName, [coded.mapInArrow(counter(s), "slice bigint, counts binary") for s in sites])
    for r in counts.groupBy("slice").applyInArrow(add, "slice bigint, flags binary").collect():
        flags[r["slice"]] = np.frombuffer(r["flags"], np.uint8)  # 2^bits bits in all
    return coded.sparkSession.sparkContext.broadcast((bits, flags.ravel()))


def _names(k: int) -> list:
    return [f"w{i}" for i in range(k)]


def _table(columns: list, n=None) -> pa.RecordBatch:
    arrays = [pa.array(c.astype(np.int32)) for c in columns] + ([] if n is None else [pa.array(n.astype(np.int64))])
    return pa.RecordBatch.from_arrays(arrays, names=_names(len(columns)) + ([] if n is None else ["f"]))


def _counted(words: list, n: np.ndarray | None = None) -> tuple:
    """Distinct phrases of the columns ``words``, in order, and how often each occurs, or the sum of its ``n``."""
    bits = max(1, *(int(w.max(initial=0)).bit_length() for w in words))
    if bits * len(words) <= 63:  # a phrase is one number
        key = reduce(lambda x, w: x << bits | w, [w.astype(np.int64) for w in words])
        order = None if n is None else np.argsort(key, kind="stable")
        key = np.sort(key) if n is None else key.take(order)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key = key.take(first)
        found = [(key >> bits * i & (1 << bits) - 1).astype(np.int32) for i in reversed(range(len(words)))]
    else:
        order = np.lexsort(words[::-1])
        sorted_ = [w[order] for w in words]
        new = np.ones(len(order), bool)
        new[1:] = reduce(np.logical_or, [w[1:] != w[:-1] for w in sorted_])
        first = np.flatnonzero(new)
        found = [w[first] for w in sorted_]
    if n is None:
        return found, np.diff(first, append=len(words[0]))
    return found, np.add.reduceat(n.take(order), first) if len(first) else n[:0]


def _home(words: list, parts: int) -> np.ndarray:
    """Hash part of each phrase of the columns ``words``."""
    h = np.zeros(len(words[0]), np.uint64)
    for w in words:
        h = (h ^ w.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return (h % np.uint64(parts)).astype(np.int64)


def _schema(k: int) -> str:
    return ", ".join(f"w{i} int" for i in range(k))


def waves(phrases: DataFrame, k: int, most: int):
    """The phrases of ``phrases(w0..)`` in order of their words, in arrays of about ``most`` rows."""
    table = shared_table(phrases)
    n = table.count()
    parts = max(1, math.ceil(n / most))
    if parts > 1:
        table = shared_table(table.repartitionByRange(parts, *_names(k)).withColumn("wave", F.spark_partition_id()))
    for p in range(parts):
        part = (table.where(F.col("wave") == p) if parts > 1 else table).select(*_names(k)).toArrow()
        if part.num_rows:
            rows = np.stack([part.column(i).to_numpy() for i in range(k)], axis=1)
            yield rows[np.lexsort(rows.T[::-1])]


def pair_sites(ids: np.ndarray) -> np.ndarray:
    """Places of two frequent words in a row."""
    return np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))


def longer_sites(coded: DataFrame, frequent: DataFrame, k: int, most: int) -> list:
    """For each wave of the frequent phrases of ``k`` words: the places of ``k + 1`` words whose first ``k`` are in the wave and whose
    last ``k`` are frequent, or may be because they belong to another wave."""
    def in_wave(sent):
        def sites(ids):
            trie, low, high = sent.value
            on = np.zeros(len(ids) + 1, bool)
            for at in in_range(ids, low, high):
                on[reach(trie, ids, k, at)[0]] = True
            at = np.flatnonzero(on[:max(0, len(ids) - k)])
            at = at[ids[at + k] > 0]
            return at[on[at + 1] | (ids[at + 1] <= low) | (ids[at + 1] >= high)]
        return sites
    return [in_wave(coded.sparkSession.sparkContext.broadcast((Trie(rows).arrays(), int(rows[0, 0]), int(rows[-1, 0]))))
            for rows in waves(frequent.select(*_names(k)), k, most)]


def candidates(coded: DataFrame, k: int, sites: list, n: int, least: int, most_bits: int) -> DataFrame:
    """Distinct phrases ``(w0..)`` of ``k`` words at ``sites`` whose bucket is frequent and that the tasks found ``least`` times in all. A task's
    phrases travel packed with their counts, one row for each hash part, so that a phrase of all tasks is a few bytes of each."""
    if not sites:
        return coded.sparkSession.createDataFrame([], _schema(k))
    sent = bucket_filter(coded, k, sites, n, least, most_bits)
    parts = max(int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / (1 << 24)))

    def packed_rows(words, f):
        home = _home(words, parts).astype(np.min_scalar_type(parts))
        order = np.argsort(home, kind="stable")  # 8 and 16 bits are sorted by counting
        words, f, ends = [w.take(order) for w in words], f.take(order), np.cumsum(np.bincount(home, minlength=parts))
        for j, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            if end > start:
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int64()), pa.array([pack(np.concatenate([w[start:end] for w in words]).astype(np.int32))], pa.binary()),
                                                  pa.array([pack(f[start:end].astype(np.int64))], pa.binary())], names=["part", "phrases", "counts"])

    def finder(site, most_held=1 << 20):
        def kernel(batches):
            bits, packed = sent.value
            held, size = [], 0  # distinct phrases of the blocks read so far, with their counts

            def merged():
                return _counted([np.concatenate(w) for w in zip(*(words for words, _ in held))], np.concatenate([f for _, f in held]))
            for batch in batches:
                for ids in _ids(batch):
                    at = np.concatenate([at[_flagged(packed, bucket_of(ids, at, k, bits))] for at in _pieces(site(ids))])
                    held.append(_counted([ids[at + i] for i in range(k)]))
                    size += len(held[-1][1])
                    if size > most_held:
                        held = [merged()]
                        size = len(held[0][1])
                        if 2 * size > most_held:
                            yield from packed_rows(*held[0])
                            held, size = [], 0
            if size:
                yield from packed_rows(*merged())
        return kernel

    def unite(table):
        arrays = [unpack(x, np.int32).reshape(k, -1) for x in table["phrases"].to_pylist()]
        words, f = _counted(list(np.concatenate(arrays, axis=1)), np.concatenate([unpack(x, np.int64) for x in table["counts"].to_pylist()]))
        return pa.Table.from_batches([_table([w[f >= least] for w in words])])

    found = reduce(DataFrame.unionByName, [coded.mapInArrow(finder(s), "part bigint, phrases binary, counts binary") for s in sites])
    return found.groupBy("part").applyInArrow(unite, _schema(k))


def known_ends(found: DataFrame, frequent: DataFrame, k: int) -> DataFrame:
    """Of phrases of ``k`` words those whose last ``k - 1`` are in ``frequent``."""
    last = frequent.select(*[F.col(f"w{i}").alias(f"w{i + 1}") for i in range(k - 1)])
    return found.join(last, [f"w{i + 1}" for i in range(k - 1)], "left_semi").select(*_names(k))


def count_phrases(coded: DataFrame, phrases: DataFrame, k: int, least: int, most: int) -> DataFrame:
    """``(w0.., f)``: the candidates that occur ``least`` times or more, with how often, by one trie for each wave. A task's
    counts travel packed, one row for each ``part`` of the wave's phrases, and the tasks' rows of a part are added up."""
    out, part = [], 1 << 16
    for rows in waves(phrases, k, most):
        trie_sent, rows_sent = (coded.sparkSession.sparkContext.broadcast(x) for x in ((Trie(rows).arrays(), int(rows[0, 0]), int(rows[-1, 0])), rows))

        def kernel(batches, sent=trie_sent):
            trie, low, high = sent.value
            f = np.zeros(len(trie[5]), np.int64)
            for batch in batches:
                for ids in _ids(batch):
                    for at in in_range(ids, low, high):
                        np.add.at(f, trie[3].take(reach(trie, ids, k, at)[1]), 1)
            for j in range(0, len(f), part):
                if f[j:j + part].any():
                    yield pa.RecordBatch.from_arrays([pa.array([j // part], pa.int64()), pa.array([pack(f[j:j + part])], pa.binary())], names=["part", "counts"])

        def adder(sent):
            def add(table):
                j = table["part"][0].as_py() * part
                words = sent.value[j:j + part]
                f = np.zeros(len(words), np.int64)
                for blob in table["counts"].to_pylist():
                    f += unpack(blob, np.int64)
                on = f >= least
                return pa.Table.from_batches([_table(list(words[on].T), f[on])])
            return add

        sums = coded.mapInArrow(kernel, "part bigint, counts binary").groupBy("part").applyInArrow(adder(rows_sent), f"{_schema(k)}, f bigint")
        out.append(shared_table(sums))
        for sent in (trie_sent, rows_sent):  # written: no task reads them again
            sent.destroy()
    return reduce(DataFrame.unionByName, out) if out else coded.sparkSession.createDataFrame([], f"{_schema(k)}, f bigint")


def _encode(docs, text_col, lang, least, block_tokens):
    """The frequent words ``(id, lang, word, f)``, blocks ``(ids)`` of their numbers, and words by language ``(lang, n)``."""
    blocks = shared_table(build_blocks(docs, text_col, lang, block_tokens))
    sizes = shared_table(blocks.groupBy("lang").agg(F.sum("n").alias("n")))

    def count(batches):
        for b in batches:
            for i in range(b.num_rows):
                words = b.column(1).slice(i, 1).flatten()
                n = np.bincount(unpack(b.column(2)[i].as_py(), np.uint32), minlength=len(words) + 1)[1:]
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[i].as_py()] * len(n), pa.string()), words, pa.array(n)], names=["lang", "word", "n"])

    counts = blocks.select("lang", "words", "tokens").mapInArrow(count, "lang string, word string, n bigint")
    words = counts.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least).withColumn("part", F.spark_partition_id())
    words = shared_table(words.withColumn("place", F.monotonically_increasing_id() - (F.col("part").cast("bigint") * (1 << 33)) + 1))
    before, pairs = 0, []
    for r in sorted(words.groupBy("part").agg(F.max("place").alias("n")).collect()):  # one row for each partition
        pairs += [F.lit(r["part"]), F.lit(before)]
        before += r["n"]
    number = (F.col("place") + F.create_map(*pairs)[F.col("part")]) if pairs else F.col("place")
    words = words.select(number.cast("int").alias("id"), "lang", "word", "f")
    places = blocks.select("block", "lang", F.posexplode("words").alias("at", "word"))
    told = (places.join(bounded(words.select("lang", "word", "id"), SIDE_BYTES), ["lang", "word"]).groupBy("block")
            .agg(F.collect_list(F.struct(F.col("at") + 1, "id").alias("told")).alias("told")))  # bounded by the block

    def encode(batches):
        for b in batches:
            for i in range(b.num_rows):
                told = b.column(1).slice(i, 1).flatten()
                number = np.zeros(b.column(2)[i].as_py() + 1, np.int32)
                number[np.asarray(told.field(0))] = np.asarray(told.field(1))
                yield pa.RecordBatch.from_arrays([pa.array([pack(number[unpack(b.column(0)[i].as_py(), np.uint32)])], pa.binary())], names=["ids"])

    coded = blocks.select("block", "tokens", F.size("words").alias("n_words")).join(told, "block")
    return words, shared_table(coded.select("tokens", "told", "n_words").mapInArrow(encode, "ids binary")), sizes


def _sub(freq: dict, phrases: DataFrame, k: int, lo: int, hi: int, name: str) -> DataFrame:
    """``phrases`` with the count of its words ``lo`` .. ``hi`` as ``name``."""
    part = freq[hi - lo].select(*[F.col(f"w{i}").alias(f"w{i + lo}") for i in range(hi - lo)], F.col("f").alias(name))
    return phrases.join(bounded(part, SIDE_BYTES), [f"w{i}" for i in range(lo, hi)])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10, top: int = 2000,
                 share: int = 50, block_tokens: int = 1 << 20, trie_phrases: int = 1 << 20, bucket_bits: int = 27) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of every language.

    Texts are lower-cased (A-Z) and cut at ``[.,;:!?]`` and 0x0A-0x0D into pieces, those at spaces and tabs into words.
    A phrase of 2 to ``max_words`` words that stands ``least`` times or more inside pieces is a candidate. Its score
    is the least ``floor(10^6 a^2 / (l r))`` over its cuts, the first of equal ones; candidates inside a longer one with
    ``share`` % of their count or more go. Order: score, a, phrase (UTF-8). ``n`` counts the language's words.

    A null language is ``und``; a null or empty text has no words. Repeated rows count as often as they occur. Long texts are
    read in pieces and never cut in a phrase. Languages without a phrase give no rows, empty tables none. Other columns are
    not read. Tries hold at most about ``trie_phrases`` phrases; the blocks are read once for each trie."""
    begin(docs.sparkSession)
    words, coded, sizes = _encode(docs, text_col, F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), least, block_tokens)
    freq = {1: words.select(F.col("id").alias("w0"), "f")}
    n_words = sizes.agg(F.sum("n")).first()[0] or 0
    for k in range(2, max_words + 1):
        sites = [pair_sites] if k == 2 else longer_sites(coded, freq[k - 1], k - 1, trie_phrases)
        found = candidates(coded, k, sites, n_words, least, bucket_bits)
        freq[k] = count_phrases(coded, found if k == 2 else known_ends(found, freq[k - 1], k), k, least, trie_phrases)
    spelled = bounded(words.select("id", "lang", "word"), SIDE_BYTES)
    result = None
    for k in range(2, max_words + 1):
        p = freq[k].withColumnRenamed("f", "a")
        for cut in range(1, k):
            p = _sub(freq, _sub(freq, p, k, 0, cut, f"l{cut}"), k, cut, k, f"r{cut}")
        wide = lambda c: F.col(c).cast("decimal(15,0)")  # noqa: E731  products stay below 10^38
        cuts = F.array(*[F.struct(_floor_score(wide("a"), wide(f"l{c}"), wide(f"r{c}")).alias("score"), F.lit(c).alias("cut"),
                                  F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in range(1, k)])
        p = p.withColumn("best", F.array_min(cuts)).select(*_names(k), "a", "best.l", "best.r", "best.score")
        for m in range(k + 1, max_words + 1):
            inside = reduce(DataFrame.unionByName, [freq[m].select(*[F.col(f"w{i + s}").alias(f"w{i}") for i in range(k)], "f") for s in range(m - k + 1)])
            p = p.join(inside.groupBy(*_names(k)).agg(F.max("f").alias("over")), _names(k), "left")
            p = p.where(F.col("over").isNull() | (100 * F.col("over") < share * F.col("a"))).drop("over")
        for i in range(k):
            p = p.join(spelled.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"s{i}"), *(["lang"] if i == 0 else [])), f"w{i}")
        p = p.select("lang", F.concat_ws(" ", *[f"s{i}" for i in range(k)]).alias("phrase"), "a", "l", "r", "score")
        result = p if result is None else result.unionByName(p)
    return _ranked(result, top).join(bounded(sizes, SIDE_BYTES), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``: range partitions are ranked alone and shifted by what
    the language has in those before, so no task sees a whole language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    placed = shared_table(scored.repartitionByRange(F.col("lang"), *order).withColumn("part", F.spark_partition_id()))
    counted = placed.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("rows"))  # a row for each partition and language in it
    before = F.sum("rows").over(W.partitionBy("lang").orderBy("part")) - F.col("rows")
    shift = counted.withColumn("before", before).where(F.col("before") < top).drop("rows")
    place = F.row_number().over(W.partitionBy("lang", "part", "before").orderBy(*order)).cast("bigint")
    return placed.join(bounded(shift, SIDE_BYTES), ["lang", "part"]).withColumn("rank", place + F.col("before")).where(F.col("rank") <= top)


def _floor_score(a, left, right):
    """``floor(10^6 a a / (left right))`` in whole decimals."""
    dividend = (a * a * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    return F.call_function("div", dividend, (left * right).cast("decimal(38,0)")).cast("bigint")
