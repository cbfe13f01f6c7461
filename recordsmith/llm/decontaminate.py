"""Benchmark decontamination (operator 7).

Texts and benchmark items are sequences of words (case-folded, without the signs around
them). Item-sized windows start wherever a text has a word pair that also stands in an
item. The CGK walk maps a window into Hamming space: at every step it writes the current
word, and a random bit of (step, word) says whether it moves on; two walks over sequences
of small edit distance soon run in step again. Several walks, each with several samples of
steps, give the hashed keys of a window, and the same walks from the positions of every
item give the keys they are looked up in. A walk has at most half as many steps as the
item has words (a power of two, up to FULL_STEPS), so every item has starts in its first
half and in its middle. Candidates are verified by the exact word edit distance between
the whole item and its best window, so results hold no false match.

An exact copy shares all its keys and is always found. An item with edits is found if any
of its positions shares any sampled key, which is tested to hold for 0.98 of passages at
the edit bound or more, at every item length from 5 to 60 words. Items are the query set;
a benchmark over BLOCK_BYTES is worked through in blocks of about that size, each against
all documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordsmith.llm.common import map_slices, read_table

MIN_ITEM_WORDS = 5       # shorter items are found where they are a whole line of a text
MAX_EDITS = 0.2          # edits allowed, as a share of an item's words
WALKS = 5                # independent CGK walks
KEYS = 3                 # step samples of a walk
SAMPLED = 5              # steps of a sample
FULL_STEPS = 16          # steps of the windows of an item of twice as many words or more
BLOCK_BYTES = 8 << 20    # benchmark text that is held in memory at a time
WORD_MEMO = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xBF58476D1CE4E5B9)
_SEED = 20250611


class _Words(dict):
    """Hash of a word without the signs around it; 0 for nothing but signs."""

    def __missing__(self, word: str) -> int:
        a, b = 0, len(word)
        while a < b and not word[a].isalnum():
            a += 1
        while b > a and not word[b - 1].isalnum():
            b -= 1
        value = (xxhash.xxh3_64_intdigest(word[a:b]) | 1) if b > a else 0
        if len(self) >= WORD_MEMO:
            self.clear()
        self[word] = value
        return value


_words = _Words()


def word_hashes(text: str | None) -> np.ndarray:
    parts = (text or "").lower().split()
    out = np.fromiter(map(_words.__getitem__, parts), np.uint64, len(parts))
    return out[out != 0]


def _pairs(h: np.ndarray) -> np.ndarray:
    x = (h[:-1] * _MIX) ^ h[1:]
    x *= _TURN
    return x ^ (x >> np.uint64(31))


def size_class(words: int) -> int:
    """The largest number of steps, of the powers of two, that cannot leave so many words."""
    return 1 << (words.bit_length() - 1)


def window_steps(words: int) -> int:
    """Steps of the windows of an item: half its size class at most, so that windows start in
    its first half and in its middle, whatever its length."""
    return min(FULL_STEPS, size_class(words) // 2)


def samples(steps: int) -> np.ndarray:
    """(walk, key, step) steps of a class, one from each part of the walk; the same on every
    machine. Of 4 steps every key leaves out another one, and 2 steps are the word pair that
    begins every key, so one key does."""
    if steps <= 2:
        return np.zeros((1, 1, 1), np.int64)
    if steps == 4:
        return np.array([[[0, 1, 2], [0, 1, 3], [0, 2, 3]][:KEYS]] * WALKS)
    rng = np.random.Generator(np.random.PCG64([_SEED, steps]))
    parts = [(steps * k // SAMPLED, max(steps * k // SAMPLED + 1, steps * (k + 1) // SAMPLED))
             for k in range(SAMPLED)]
    return np.stack([np.stack([[rng.integers(a, b) for a, b in parts] for _ in range(KEYS)])
                     for _ in range(WALKS)])


def walk_keys(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, classes: list[int]) -> dict:
    """{(class, walk, key): hashed key of every start}. ``symbols`` holds 0 at each ``end``.
    A key begins with the word pair at its start, which a text needs to be looked up at all."""
    out: dict = {}
    pair = (symbols[start] * _MIX) ^ symbols[np.minimum(start + 1, end)]
    pair *= _TURN
    top = max(classes, default=0)
    chosen = {c: samples(c) for c in classes}
    for walk in range(WALKS):
        at = start.copy()
        acc = {(c, k): pair ^ np.uint64(c * 64 + walk * 8 + k + 1) for c in classes
               if walk < len(chosen[c]) for k in range(len(chosen[c][walk]))}
        for step in range(top):
            x = symbols[at]
            for (c, k), value in acc.items():
                if step < c and step in chosen[c][walk, k]:
                    value ^= x
                    value *= _MIX
                    value ^= value >> np.uint64(29)
            bit = (x ^ np.uint64((_SEED + 7919 * (walk * 4096 + step)) & 0xFFFFFFFF)) * _TURN
            bit = ((bit ^ (bit >> np.uint64(32))) * _MIX) >> np.uint64(63)
            at = np.minimum(at + bit.astype(np.int64), end)
        out |= {(c, walk, k): v for (c, k), v in acc.items()}
    return out


class BenchmarkIndex:
    """Keys of every position of every item of one block of the benchmark."""

    def __init__(self, items: list[tuple], max_edits: float = MAX_EDITS):
        hashed = [(i, word_hashes(t)) for i, t in items]
        self.items = [(i, h) for i, h in hashed if len(h) >= MIN_ITEM_WORDS]
        self.short: dict[bytes, list] = {}                   # words of a short item -> its ids
        for i, h in hashed:
            if 0 < len(h) < MIN_ITEM_WORDS:
                self.short.setdefault(h.tobytes(), []).append(i)
        self.bound = [math.floor(max_edits * len(h)) for _, h in self.items]
        sizes = np.array([len(h) for _, h in self.items], np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int64)
        symbols = np.zeros(int(begins[-1]) + 1, np.uint64)
        item, pos = [], []
        for k, (_, h) in enumerate(self.items):
            symbols[begins[k]:begins[k] + len(h)] = h
            pos.append(np.arange(len(h) - 1))
            item.append(np.full(len(h) - 1, k))
        self.pairs: dict[int, np.ndarray] = {}
        self.tables: list[tuple] = []
        if not self.items:
            return
        item, pos = np.concatenate(item), np.concatenate(pos)
        left = sizes[item] - pos
        whole = np.array([window_steps(len(h)) for _, h in self.items])[item]
        item, pos, cls = (x[left >= whole] for x in (item, pos, whole))
        self.classes = sorted(set(cls.tolist()))
        for c in self.classes:
            own = np.flatnonzero(cls == c)
            start = begins[item[own]] + pos[own]
            self.pairs[c] = np.unique(_pairs(symbols)[start])
            for (_, walk, k), keys in walk_keys(symbols, start, begins[item[own]] + sizes[item[own]], [c]).items():
                order = np.argsort(keys, kind="stable")
                self.tables.append(((c, walk, k), keys[order], item[own][order], pos[own][order]))

    def candidates(self, texts: list[np.ndarray]):
        """Rows (text number, item number, first word of the item in the text)."""
        sizes = np.array([len(h) for h in texts], np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int64)
        symbols = np.zeros(int(begins[-1]) + 1, np.uint64)
        for b, h in zip(begins, texts):
            symbols[b:b + len(h)] = h
        if len(symbols) < 3 or not self.items:
            return np.empty((0, 3), np.int64)
        pairs = _pairs(symbols)
        found, keys = [], {}
        for name, table, item, pos in self.tables:
            if name not in keys:                             # the first table of a class
                start = np.flatnonzero(np.isin(pairs, self.pairs[name[0]]))
                number = np.searchsorted(begins, start, side="right") - 1
                keys = walk_keys(symbols, start, begins[number] + sizes[number], [name[0]])
            low = np.searchsorted(table, keys[name], side="left")
            count = np.searchsorted(table, keys[name], side="right") - low
            hit = np.flatnonzero(count)
            if len(hit):
                which = np.repeat(hit, count[hit])
                first = np.cumsum(count[hit]) - count[hit]
                at = np.repeat(low[hit] - first, count[hit]) + np.arange(len(which))
                found.append(np.stack([number[which], item[at], start[which] - begins[number[which]] - pos[at]], 1))
        if not found:
            return np.empty((0, 3), np.int64)
        return np.unique(np.concatenate(found), axis=0)

    def matches(self, texts: list[np.ndarray]) -> list[tuple]:
        """(text number, item number, edits, start, end) of the best window of every text
        and item within the bound; of equal ones the first."""
        best: dict[tuple, tuple] = {}
        done: dict[tuple, int] = {}
        for text, item, at in self.candidates(texts).tolist():
            key, h, words = (text, item), self.items[item][1], texts[text]
            if best.get(key, (1,))[0] == 0 or done.get(key, -10 ** 9) >= at:
                continue
            bound, n = self.bound[item], len(h)
            low, high = max(0, at - 2 * bound), min(len(words), at + n + 2 * bound)
            if at >= 0 and at + n <= len(words) and (words[at:at + n] == h).all():
                found = (0, at, at + n)
            else:
                region = words[low:high]
                if int(np.isin(h, region).sum()) < n - bound:
                    continue
                edits, start, end = best_window(h, region)
                done[key] = at + bound                       # its region covers near offsets
                if edits > bound:
                    continue
                found = (edits, low + start, low + end)
            best[key] = min(best.get(key, found), found)
        return [(*key, *value) for key, value in sorted(best.items())]


    def lines(self, texts: list[str | None]) -> list[tuple]:
        """(text number, item id, words, 0, start, end) of short items that are a line of a text;
        the first line of each."""
        found: dict[tuple, tuple] = {}
        for k, text in enumerate(texts if self.short else ()):
            at = 0
            for line in (text or "").split("\n"):
                h = word_hashes(line)
                for i in self.short.get(h.tobytes(), ()) if len(h) < MIN_ITEM_WORDS else ():
                    found.setdefault((k, i), (k, i, len(h), 0, at, at + len(h)))
                at += len(h)
        return list(found.values())

    def found(self, texts: list[str | None]) -> list[tuple]:
        """(text number, item id, words, edits, start, end) of all items that stand in texts."""
        long = self.matches([word_hashes(t) for t in texts])
        return [(t, self.items[i][0], len(self.items[i][1]), *rest) for t, i, *rest in long] + self.lines(texts)


def best_window(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the window of ``region`` nearest to ``item`` by word edits."""
    m = len(region)
    cost = np.zeros(m + 1, np.int64)                         # a window may start anywhere
    begin = np.arange(m + 1, dtype=np.int64)
    step = np.arange(m + 1)
    for k in range(len(item)):
        other = np.where(region == item[k], 0, 1)
        new = cost + 1
        origin = begin.copy()
        change = cost[:-1] + other
        better = change <= new[1:]
        new[1:] = np.where(better, change, new[1:])
        origin[1:] = np.where(better, begin[:-1], origin[1:])
        # Words only in the text: the least cost so far, counted on by one a word.
        run = new - step
        least = np.minimum.accumulate(run)
        from_ = np.maximum.accumulate(np.where(run == least, step, 0))
        cost, begin = least + step, origin[from_]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                     block_bytes: int = BLOCK_BYTES):
    """Indexes over the benchmark, one block of bounded size at a time."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).alias("i"), F.col(text).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k) if blocks > 1 else rows
        yield BenchmarkIndex(sorted((tuple(r) for r in part.collect()), key=str))


MATCH = "doc_id long, item_id long, item_words int, edits int, start_word int, end_word int"


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document and benchmark item that stands in it within the edit bound:
    (doc_id, item_id, item_words, edits, start_word, end_word), the best window counted in
    words that hold a letter or digit. Null and empty items and null or empty texts give no
    rows; repeated rows and repeated items repeat theirs; a null id stays null."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = None
    for index in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)         # one block: bounded

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            ids = batch.column("doc_id").to_pylist()
            found = shared.value.found(batch.column("text").to_pylist())
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[f[0]] for f in found], pa.int64()), *(pa.array([f[k] for f in found], kind)
                 for k, kind in enumerate(kinds, 1))], [c.split()[0] for c in MATCH.split(", ")])

        part = map_slices(rows, run, MATCH, "text")
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text holds no benchmark item. All columns pass through."""
    spark, schema = df.sparkSession, df.schema
    for index in benchmark_blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            found = shared.value.found(batch.column(text).to_pylist())
            keep = np.ones(batch.num_rows, bool)
            keep[[t for t, *_ in found]] = False
            return batch.filter(pa.array(keep))

        df = map_slices(df, run, T.StructType(schema.fields), text)
    return df


def op7_decontaminate(spark, sf_dir):
    return leaks(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                 read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
