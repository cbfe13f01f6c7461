"""MinHash near-dedup (operator 2).

Every text becomes its set of distinct five-word shingles (64-bit hashes) and 216 minima
of universal hashes, cut into 36 bands of 6. Texts of one set are one class. Classes that
share a band are candidates: the class with most band partners leads a bucket, and every
class is held against its leaders on the full sets. The components of these links leave
few buckets with more than one label; in those, all pairs of different labels are held
against each other in blocks by signature, and the pairs that pass on the full sets. So a
group of copies costs about as many pairs as it has members, and no link is left out.
Components are found by alternating large-star and small-star.

With similarity 0.85 a pair shares no band with probability (1 - 0.85^6)^36 = 4e-8, and
the signature estimate (8 bits a minimum, standard deviation 0.024) lies under the
screening limit with probability 2e-6.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.common import drop_stash, map_slices, read_table, stash
from recordsmith.llm.components import connected_components
from recordsmith.ship import shipped

SHINGLE = 5
PERCENT = 85                 # least similarity of a link
BANDS, ROWS = 36, 6
HASHES = BANDS * ROWS
SCREEN = 0.74                # least estimate of a pair that is held against the full sets
BLOCK = 256                  # classes of a bucket in one block
_RNG = np.random.Generator(np.random.PCG64(20250607))
_MULTIPLY = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles (A-Z lower-cased); fewer words
    than ``size``: the whole sequence as one; no words: empty."""
    words = (text or "").encode().lower().split()       # exactly space and 09-0D
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = (out ^ hashed[j:j + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of every universal hash over a set."""
    least = np.full(HASHES, np.uint64(_MASK))
    for at in range(0, len(shingles), 2048):
        part = shingles[at:at + 2048]
        for h in range(0, HASHES, 36):
            values = part[None, :] * _MULTIPLY[h:h + 36, None] + _ADD[h:h + 36, None]
            np.minimum(least[h:h + 36], values.min(axis=1), out=least[h:h + 36])
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for j in range(ROWS):
        out = (out ^ rows[:, j]) * _MIX
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def signature_bytes(least: np.ndarray) -> bytes:
    return ((least * _MIX) >> np.uint64(56)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n, sh, bands, sig, short) of (doc_id, th, text): set size, 128-bit hash of
    the set (null for an empty one), band keys, signature, and 32 bits of every band key."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, sh, bands, sig, short = [], [], [], [], []
        for text in batch.column("text").to_pylist():
            s = shingle_set(text)
            n.append(len(s))
            if len(s):
                least = minima(s)
                sh.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(band_keys(least))
                short.append(bands[-1].astype(np.uint64).astype(np.uint32).tobytes())
                sig.append(signature_bytes(least))
            else:
                sh.append(None), bands.append(None), sig.append(None), short.append(None)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(sh, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary()), pa.array(short, pa.binary())],
            ["doc_id", "th", "n", "sh", "bands", "sig", "short"])

    return map_slices(docs, run, "doc_id long, th long, n long, sh binary, bands array<long>, sig binary, short binary", "text")


def class_texts(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text): one text of every class, however many rows share its id or its text."""
    return (docs.join(reps.select("node", F.col("rep").alias("doc_id"), "th"), ["doc_id", "th"])
            .groupBy("node").agg(F.first("text").alias("text")))


def linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar enough."""
    named = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = class_texts(reps.join(named, "node", "left_semi"), docs)
    pairs = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    pairs = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        last, other = None, None
        good = []
        for b, ta, tb in zip(batch.column("b").to_pylist(), batch.column("ta").to_pylist(),
                             batch.column("tb").to_pylist()):
            if b != last:
                last, other = b, shingle_set(tb)
            own = shingle_set(ta)
            both = len(np.intersect1d(own, other, assume_unique=True))
            good.append(100 * both >= percent * (len(own) + len(other) - both))
        keep = pa.array(good, pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(keep)

    return map_slices(pairs.select("a", "b", "ta", "tb"), run, "a long, b long", "ta")


def _screened(rows: DataFrame) -> DataFrame:
    """Pairs of different labels in one block group whose signatures agree enough.

    ``rows`` (key, i, j, side, node, label, n, sig, short) are dealt and sorted by group; a group
    has the classes of one block, or of two blocks whose classes are held against each
    other, so it is bounded by the block size.
    """
    def pairs(key: int, group: list[tuple]) -> tuple[list, list]:
        rep = np.array([g[1] for g in group], np.int64)
        label = np.array([g[2] for g in group], np.int64)
        if (label == label[0]).all():
            return [], []
        side = np.array([g[0] for g in group], np.int8)
        size = np.array([g[3] for g in group], np.int64)
        bands = np.frombuffer(b"".join([g[5] for g in group]), np.uint32).reshape(len(group), BANDS)
        here = np.int64(key).astype(np.uint64).astype(np.uint32)
        sig = np.frombuffer(b"".join([g[4] for g in group]), np.uint8).reshape(len(group), HASHES)
        a, b = [], []
        need = (SCREEN * (1 - 1 / 256) + 1 / 256) * HASHES
        two = (side == 1).any()
        for x in range(len(group)):
            if two and side[x] == 1:
                continue
            test = (side == 1) if two else (np.arange(len(group)) > x)
            test &= (label != label[x]) & (100 * np.minimum(size, size[x]) >= PERCENT * np.maximum(size, size[x]))
            at = np.flatnonzero(test)
            if len(at):     # of the buckets that a pair shares, only the first one makes it
                first = (bands[at] == bands[x]).argmax(axis=1)
                at = at[(bands[x, first] == here) & ((sig[at] == sig[x]).sum(axis=1) >= need)]
            a += [max(rep[x], rep[y]) for y in at]
            b += [min(rep[x], rep[y]) for y in at]
        return a, b

    def run(batches):
        held, group = None, []
        a, b = [], []

        def out():
            done = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a.clear(), b.clear()
            return done

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "i", "j", "side", "node", "label", "n", "sig", "short")]
            for row in zip(*columns):
                if row[:3] != held:
                    if len(group) > 1:
                        x, y = pairs(held[0], group)
                        a.extend(x), b.extend(y)
                    held, group = row[:3], []
                    if len(a) > 50_000:
                        yield out()
                group.append(row[3:])
        if len(group) > 1:
            x, y = pairs(held[0], group)
            a.extend(x), b.extend(y)
        yield out()

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return shipped(dealt).mapInArrow(run, "a long, b long")


def _rest(buckets: DataFrame, reps: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidate pairs of different labels in the buckets that still have several."""
    b = (buckets.join(labels, "node", "left")
                .select("key", "node", F.coalesce("component", "node").alias("label")))
    still = (b.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                  F.count("*").alias("c"))
              .where("low < high").select("key", F.ceil(F.col("c") / BLOCK).alias("blocks")))
    b = (b.join(still, "key").join(reps.select("node", "n", "sig", "short"), "node")
          .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
          .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    return b.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "label", "n", "sig", "short")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``df``.

    Rows without words (null or empty text too) have an empty set, are linked with nothing
    and form a component of their own. Rows of one doc_id are the same document: what any of
    their texts is linked with, all of them that have words are. A null doc_id has a component
    only through other documents of its set, and is never kept. An empty table gives no
    rows. Other columns are not used.
    """
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    sigs = stash(signatures(docs.select("doc_id", "th", "text")), "signatures")
    reps = (sigs.where("n > 0 AND doc_id IS NOT NULL").groupBy("sh")
                .agg(F.min(F.struct("doc_id", "th", "n", "bands", "sig", "short")).alias("r"))
                .select("sh", F.col("r.doc_id").alias("rep"), "r.th", "r.n", "r.bands", "r.sig", "r.short"))
    reps = stash(reps.withColumn("node", F.monotonically_increasing_id()), "classes")   # a number a class, for good
    spread = reps.select("node", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    buckets = stash(spread.join(shared, "key"), "buckets")
    weight = buckets.groupBy("node").agg(F.sum("c").alias("w"))
    lead = (buckets.join(weight, "node").groupBy("key")
                   .agg(F.max(F.struct("w", (-F.col("node")).alias("m"))).alias("x"))
                   .select("key", (-F.col("x.m")).alias("lead")))
    stars = (buckets.join(lead, "key").where("node <> lead")
                    .select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct())
    # Classes that an id has rows of are the same document.
    own = sigs.where("doc_id IS NOT NULL").join(reps.select("sh", "node"), "sh").select("doc_id", "node")
    ids = own.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    same = own.join(ids, "doc_id").where("node > low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    links = stash(linked(stars, reps, docs).unionByName(same), "links")
    labels = connected_components(links)
    more = stash(_screened(_rest(buckets, reps, labels)), "pairs")
    drop_stash(buckets)
    links2 = linked(more, reps, docs)
    labels = connected_components(
        labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
              .unionByName(links2))
    drop_stash(links)
    drop_stash(more)
    classes = (reps.select("sh", "rep", "node").join(labels, "node", "left")
                   .select("sh", "rep", F.coalesce("component", "node").alias("label")))
    least = classes.groupBy("label").agg(F.min("rep").alias("component"))
    classes = classes.join(least, "label").select("sh", "component")
    return (sigs.select("doc_id", F.col("n").alias("n_shingles"), "sh").join(classes, "sh", "left")
                .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
                .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def op2_minhash_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
