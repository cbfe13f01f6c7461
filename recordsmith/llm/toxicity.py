"""Counterfactually regularised toxicity classifier (operator 10).

A sparse logistic model over the distinct words of a text and their beginnings, hashed.
For every labelled text that mentions an identity term, a twin is made with each such
term replaced by the next one of its group, and the squared difference of the two scores
is part of the loss: the model may not lean on which group is mentioned, so neutral
mentions are not taken for toxic ones. It is fitted on a bounded sample of the labelled
rows on the driver; scoring runs over all documents in tasks.
"""

from __future__ import annotations

import math
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.common import map_slices, read_table, stash
from recordsmith.ship import shipped

MAX_TRAIN_ROWS = 20_000      # labelled rows that are fitted, the first in order of a hash
BITS = 20                    # 2^BITS hashed features
PREFIXES = (4, 5, 6, 7)      # beginnings of words that are features beside the word
MIN_DOCS = 4                 # a feature of fewer fitted texts gets no weight
MAX_FEATURES = 4096          # features kept: those whose share differs most between the labels
SPARSITY = 3e-4              # L1 penalty
FAIRNESS = 1.0               # weight of the counterfactual penalty
ROUNDS = 200
WORD_MEMO = 200_000
IDENTITY_GROUPS = [
    "women men", "woman man", "girls boys", "girl boy", "female male", "she he", "her his",
    "christian muslim jewish hindu buddhist atheist",
    "christians muslims jews hindus buddhists atheists",
    "black white asian latino african european arab",
    "blacks whites asians latinos africans europeans arabs",
    "gay straight lesbian bisexual transgender", "immigrant native refugee citizen",
    "immigrants natives refugees citizens", "old young elderly", "disabled blind deaf",
    "american mexican german french spanish english chinese indian russian",
    "americans mexicans germans frenchmen spaniards chinese indians russians",
    "frauen männer", "frau mann", "christen muslime juden", "schwarze weiße", "ausländer deutsche",
    "femmes hommes", "femme homme", "chrétiens musulmans juifs", "noirs blancs arabes",
    "mujeres hombres", "mujer hombre", "cristianos musulmanes judíos", "negros blancos",
]


@lru_cache(maxsize=1)
def identity_swaps() -> dict[str, str]:
    """Every identity term and the term that takes its place."""
    out: dict[str, str] = {}
    for group in map(str.split, IDENTITY_GROUPS):
        for term, other in zip(group, group[1:] + group[:1]):
            out.setdefault(term, other)
    return out


def _bare(word: str) -> str:
    """A word without the signs around it."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def distinct_words(text: str | None) -> set[str]:
    return set(unicodedata.normalize("NFC", text or "").lower().split())


def word_features(word: str) -> list[int]:
    """Hashed features of one word; none if it has no letter or digit."""
    bare = _bare(word)
    if not bare:
        return []
    names = [bare + "\n", *(bare[:k] for k in PREFIXES if len(bare) >= k)]
    return [xxhash.xxh32_intdigest(n) >> (32 - BITS) for n in names]


def _features(words: set[str]) -> np.ndarray:
    return np.array([f for w in {_bare(w) for w in words} for f in word_features(w)], np.int32)


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Features of a text and of its twin (None where no identity term stands in it)."""
    words, swaps = distinct_words(text), identity_swaps()
    own = _features(words)
    twin = {swaps.get(_bare(w), w) for w in words}
    return own, (_features(twin) if twin != words else None)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic, text) of at most ``max_rows`` labels, in order of a hash of doc_id.

    A doc_id labelled twice counts as toxic if any label says so, null labels are left out, and
    of several texts of an id the least one is taken.
    """
    chosen = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
                    .groupBy("doc_id").agg(F.greatest(F.lit(0), F.least(F.lit(1), F.max("toxic"))).cast("int").alias("toxic"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = docs.join(F.broadcast(chosen), "doc_id")          # at most max_rows pairs of numbers
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def select_features(sample: DataFrame, count: int = MAX_FEATURES) -> np.ndarray:
    """Hashed features whose share of texts differs most between the labels, in order."""
    def run(batches):
        both = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                both[toxic, np.unique(text_features(text)[0])] += 1
        f = np.flatnonzero(both.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()), pa.array(both[0, f]), pa.array(both[1, f])],
                                         ["f", "good", "bad"])

    totals = sample.agg(F.count("*").alias("n"), F.avg("toxic").alias("rate")).first()
    if not totals["n"]:
        return np.empty(0, np.int64)
    counted = (shipped(sample.select("toxic", "text")).mapInArrow(run, "f long, good long, bad long")
               .groupBy("f").agg(F.sum("bad").alias("bad"), (F.sum("good") + F.sum("bad")).alias("n"))
               .where(F.col("n") >= MIN_DOCS))
    gap = F.abs(F.col("bad") - F.col("n") * totals["rate"]) / F.sqrt(
        F.col("n") * (1 - F.col("n") / F.lit(float(totals["n"]))) + 1e-9)
    top = counted.select("f", F.round(gap, 9).alias("gap")).orderBy(F.desc("gap"), "f").limit(count)
    return np.sort(np.array([r["f"] for r in top.collect()], np.int64))


def _own_and_twin(sample: DataFrame, used: np.ndarray) -> DataFrame:
    """(doc_id, toxic, own, twin): positions in ``used`` of every text's features."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        def packed(features):
            if features is None:
                return None
            at = np.searchsorted(used, features)
            return at[(at < len(used)) & (used[np.minimum(at, len(used) - 1)] == features)].astype(np.int32).tobytes()

        both = [text_features(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()),
             pa.array([packed(a) for a, _ in both], pa.binary()),
             pa.array([packed(b) for _, b in both], pa.binary())], ["doc_id", "toxic", "own", "twin"])

    return map_slices(sample.select("doc_id", "toxic", "text"), run,
                      "doc_id long, toxic int, own binary, twin binary", "text")


class _Rows:
    """Sparse rows: sums by row and by feature."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.f = np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, w[self.f], self.n)

    def back(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.f, r[self.at], size)


def fit(own: list[np.ndarray], twin: list[np.ndarray | None], toxic: np.ndarray, size: int,
        fairness: float = FAIRNESS) -> tuple[np.ndarray, float]:
    """(weights of ``size`` features, bias), by proximal steps with momentum estimates."""
    if not len(toxic):
        return np.zeros(size), 0.0
    rate = float(np.clip(toxic.mean(), 1e-3, 1 - 1e-3))
    bias = math.log(rate / (1 - rate))
    pairs = [k for k, t in enumerate(twin) if t is not None]
    x = _Rows(own)
    a, b = _Rows([own[k] for k in pairs]), _Rows([twin[k] for k in pairs])
    n, w = len(toxic), np.zeros(size)
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    step = 0.1
    for t in range(1, ROUNDS + 1):
        err = 1 / (1 + np.exp(-np.clip(x.times(w) + bias, -30, 30))) - toxic
        g = x.back(err / n, size)
        if pairs:
            gap = (b.times(w) - a.times(w)) * (2 * fairness / len(pairs))
            g += b.back(gap, size) - a.back(gap, size)
        gb = err.mean()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        scale = step / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-4)
        w = w - scale * m / (1 - 0.9 ** t)
        w = np.sign(w) * np.maximum(np.abs(w) - scale * SPARSITY, 0)
        bias -= step * (mb / (1 - 0.9 ** t)) / (math.sqrt(vb / (1 - 0.99 ** t)) + 1e-4)
    return w, float(bias)


class _WordScores(dict):
    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        score = float(self.weights[word_features(word)].sum()) if word else 0.0
        if len(self) >= WORD_MEMO:
            self.clear()
        self[word] = score
        return score


def score_text(text: str | None, scores: _WordScores, bias: float) -> float:
    bare = {_bare(w) for w in distinct_words(text)}
    z = bias + math.fsum(map(scores.__getitem__, bare))
    return 1 / (1 + math.exp(-min(max(z, -500.0), 500.0)))


def score_toxicity(df: DataFrame, model: tuple, text: str = "text",
                   score: str = "score") -> DataFrame:
    """Add ``score`` (0 to 1) to every row (replacing a column so named).

    It depends on the text alone. A null or empty text gets the score of no words, so do
    texts without a letter or digit; repeated rows repeat their score.
    """
    features, weights, bias = model
    on = np.flatnonzero(weights)
    packed = (features[on], weights[on], float(bias))            # at most MAX_FEATURES pairs
    memo = _Model(packed)
    kept = [f for f in df.schema.fields if f.name.lower() != score.lower()]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{score}` double"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = memo.load()
        out = [score_text(t, words, packed[2]) for t in batch.column("__text").to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(out, pa.float64())],
                                          [*(f.name for f in kept), score])

    source = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias("__text"))
    return map_slices(source, run, schema, "__text")


class _Model:
    """The weights as they travel to the workers; unpacked once per task."""

    def __init__(self, packed):
        self.packed, self.words = packed, None

    def __getstate__(self):
        return self.packed

    def __setstate__(self, packed):
        self.packed, self.words = packed, None

    def load(self) -> _WordScores:
        if self.words is None:
            weights = np.zeros(1 << BITS, np.float32)
            weights[self.packed[0]] = self.packed[1]
            self.words = _WordScores(weights)
        return self.words


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> tuple:
    """(features, weights, bias), fitted on a bounded sample; features are chosen by counts
    made in tasks, and only their positions come to the driver. No labelled rows give a
    model that scores 0.5 throughout."""
    sample = stash(labelled_sample(docs, labels, max_rows), "sample")    # at most max_rows texts
    used = select_features(sample)
    if not len(used):
        toxic = np.array([r["toxic"] for r in sample.select("toxic").collect()], float)
        return used, *fit([np.empty(0, np.int32)] * len(toxic), [None] * len(toxic), toxic, 0)
    rows = _own_and_twin(sample, used).orderBy("doc_id").collect()       # bounded by max_rows
    own = [np.frombuffer(r["own"], np.int32) for r in rows]
    twin = [None if r["twin"] is None else np.frombuffer(r["twin"], np.int32) for r in rows]
    return used, *fit(own, twin, np.array([r["toxic"] for r in rows], float), len(used))


def op10_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit_toxicity(docs, labels.where(~held_out))
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
