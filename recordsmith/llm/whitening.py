"""Embedding whitening from bit-sliced cross-products (operator 13).

Every vector entry c becomes the integer floor(SCALE * c) + SHIFT. A block of rows is
shifted to zero by its least entry of each dimension and cut into bit planes; plane b of a
dimension holds bit b of all rows, 64 rows a word. The sum of products of two dimensions
is then the sum over their planes of 2^(a + b) times the set bits of plane a AND plane b,
exact whatever the number of rows. Blocks leave n, sums and cross-products of the unshifted
integers, as limbs that Spark adds up as decimals; the driver gets one number a pair of
dimensions, forms n * C - S * S' in integers and only then goes to floating point, for the
eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.common import read_table
from recordsmith.ship import shipped

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_VALUES = 1 << 21       # entries whose planes are held at a time
LIMB = 48                    # bits of a number's limb; LIMBS of them hold any block's sum
LIMBS = 4
LARGEST = 2.0 ** 62          # integers are held to this
RANK_TOL = 1e-12             # eigenvalues below this share of the largest count as zero


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) + SHIFT of finite entries, held to +-2^62."""
    y = np.floor(SCALE * values.astype(np.float64))
    return np.clip(y, -LARGEST, LARGEST).astype(np.int64) + SHIFT


def bit_planes(y: np.ndarray) -> np.ndarray:
    """[dimensions, planes, words]: the bits of non-negative integers [rows, dimensions]."""
    rows, dims = y.shape
    planes = max(1, int(y.max(initial=0)).bit_length())
    padded = np.zeros((-(-rows // 64) * 64, dims), np.uint64)
    padded[:rows] = y
    out = np.empty((dims, planes, len(padded) // 64), np.uint64)
    for b in range(planes):
        bits = ((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        out[:, b] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    return out


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products [dimensions, dimensions] of integers, as Python integers.

    Weighted popcounts of ANDed planes, of the entries above each dimension's least one;
    the least ones are added back in integers.
    """
    low = x.min(axis=0)
    planes = bit_planes((x - low).view(np.uint64))
    dims, depth, words = planes.shape
    flat = planes.reshape(dims * depth, words)
    sums = np.bitwise_count(planes).sum(axis=2, dtype=np.int64).astype(object) @ np.array(
        [1 << b for b in range(depth)], object)
    products = np.zeros((dims, dims), object)
    weights = np.array([1 << b for b in range(depth)], object)
    for i in range(dims):
        above = flat[i * depth:]
        for a in range(depth):
            counts = np.bitwise_count(flat[i * depth + a] & above).sum(axis=1, dtype=np.int64)
            products[i, i:] += (counts.reshape(-1, depth).astype(object) @ weights) << a
    products += np.triu(products, 1).T
    low, n = low.astype(object), len(x)
    outer = np.multiply.outer(low, sums)
    return sums + n * low, products + outer + outer.T + n * np.multiply.outer(low, low)


def _vectors(batch: pa.RecordBatch, column: str, dims: int | None):
    """Rows [k] with a clean vector of ``dims`` entries (or of any size), and their entries."""
    lists = batch.column(column)
    sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(lists)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)     # a null becomes NaN
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    bad = np.zeros(len(lists), bool)
    bad[owner[~np.isfinite(values)]] = True
    good = (sizes >= 0) & ~bad
    if dims is not None:
        good &= sizes == dims
    return np.flatnonzero(good), sizes, values[good[owner]] if len(values) else values


def _limbs(numbers: list[int]) -> list[list[int]]:
    """The numbers cut into LIMBS limbs, low first; the last one carries the sign."""
    cut = [[(v >> (LIMB * k)) & ((1 << LIMB) - 1) for v in numbers] for k in range(LIMBS - 1)]
    return [*cut, [v >> (LIMB * (LIMBS - 1)) for v in numbers]]


def dimension(vectors: DataFrame, column: str) -> int:
    """The most frequent size of the clean vectors (of equals the largest); 0 without any."""
    def run(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            rows, sizes, _ = _vectors(batch, column, None)
            for size, n in zip(*np.unique(sizes[rows], return_counts=True)):
                seen[int(size)] = seen.get(int(size), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                         ["size", "n"])

    found = (shipped(vectors.select(column)).mapInArrow(run, "size long, n long").groupBy("size")
             .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first())
    return int(found["size"]) if found else 0


def moments(vectors: DataFrame, column: str, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, cross-products) over all clean vectors, as Python integers."""
    rows_held = max(64, BLOCK_VALUES // max(1, dims) // 64 * 64)
    upper = np.triu_indices(dims)
    row = [-2, *[-1] * dims, *upper[0].tolist()]
    col = [0, *range(dims), *upper[1].tolist()]

    def run(batches):
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        held, size = [], 0

        def block():
            nonlocal n, sums, products, held, size
            x = np.concatenate(held)
            s, c = cross_products(x)
            n, sums, products = n + len(x), sums + s, products + c
            held, size = [], 0

        for batch in batches:
            _, _, values = _vectors(batch, column, dims)
            x = integers(values).reshape(-1, dims)
            for at in range(0, len(x), rows_held):
                part = x[at:at + rows_held]
                if size and size + len(part) > rows_held:
                    block()
                held.append(part)
                size += len(part)
        if size:
            block()
        if n:
            limbs = _limbs([n, *sums.tolist(), *products[upper].tolist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int32()), pa.array(col, pa.int32()), *(pa.array(v, pa.int64()) for v in limbs)],
                ["i", "j", *(f"l{k}" for k in range(LIMBS))])

    schema = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    total = (shipped(vectors.select(column)).mapInArrow(run, schema).groupBy("i", "j")
             .agg(*[F.sum(F.col(f"l{k}").cast("decimal(20,0)")).alias(f"l{k}") for k in range(LIMBS)]))
    n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
    for r in total.collect():                                # one row a pair of dimensions
        value = sum(int(r[f"l{k}"]) << (LIMB * k) for k in range(LIMBS))
        if r["i"] == -2:
            n = value
        elif r["i"] == -1:
            sums[r["j"]] = value
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = value
    return n, sums, products


class Whitening:
    """Exact moments and the leading eigenvectors of the covariance."""

    def __init__(self, n: int, sums: np.ndarray, products: np.ndarray, components: int):
        self.n, self.dims = n, len(sums)
        self.sums = [int(s) for s in sums]
        centred = n * products - np.multiply.outer(sums, sums)          # integers
        trace = sum(int(centred[k, k]) for k in range(self.dims))
        square = n * n
        cov = np.array([[int(v) / square for v in r] for r in centred]).reshape(self.dims, self.dims) if n else \
            np.zeros((0, 0))
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        keep = values > max(values[0], 0) * RANK_TOL if len(values) else values > 0
        if not trace:
            keep &= False
        values, vectors = values[keep], vectors[:, keep]
        flip = np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1.0, 1.0) \
            if len(values) else np.ones(0)
        self.values, self.vectors = values, vectors * flip
        self.explained = values / (trace / square) if trace else values

    def apply(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        """(deviations, whitened values [rows, components]) of integer vectors."""
        small = self.n < 1 << 20 and len(x) and max(np.abs(x).max(), max(map(abs, self.sums)) // self.n) < 1 << 20
        if small and self.dims * (float(self.n) * 2.0 ** 21) ** 2 < 2.0 ** 63:
            d = x * self.n - np.array(self.sums, np.int64)
            deviation = (d * d).sum(axis=1).tolist()
        else:                                                           # exact at any size
            d = x.astype(object) * self.n - np.array(self.sums, object)
            deviation = (d * d).sum(axis=1).tolist()
        centred = d.astype(np.float64) / self.n
        return deviation, (centred @ self.vectors) / np.sqrt(self.values)


def identity_error(vectors: DataFrame, column: str, model: Whitening) -> float:
    """Largest entry of the whitened values' covariance minus the identity, from the values."""
    k = len(model.values)
    upper = np.triu_indices(k)
    row = [*[-1] * k, *upper[0].tolist()]
    col = [*range(k), *upper[1].tolist()]

    def run(batches):
        mean, scatter, n = np.zeros(k), np.zeros((k, k)), 0
        for batch in batches:
            _, _, values = _vectors(batch, column, model.dims)
            if not len(values):
                continue
            _, w = model.apply(integers(values).reshape(-1, model.dims))
            own = w.mean(axis=0)
            d, gap, m = w - own, own - mean, len(w)
            scatter += d.T @ d + np.outer(gap, gap) * (n * m / (n + m))  # centred, then merged
            mean, n = mean + gap * (m / (n + m)), n + m
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int32()), pa.array(col, pa.int32()),
                 pa.array([*(n * mean), *(scatter + n * np.outer(mean, mean))[upper]])], ["i", "j", "v"])

    total = (shipped(vectors.select(column)).mapInArrow(run, "i int, j int, v double").groupBy("i", "j")
             .agg(F.sum("v").alias("v")).collect())
    mean, cov = np.zeros(k), np.zeros((k, k))
    for r in total:                                          # k * (k + 3) / 2 rows
        if r["i"] < 0:
            mean[r["j"]] = r["v"] / model.n
        else:
            cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["v"] / model.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


OUTPUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, deviation_digits string")


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row for every clean vector and leading component (OUTPUT's columns).

    Rows whose vector is null or holds a null or non-finite entry are left out, and so are
    vectors that have not the most frequent size. Null ids stay null and repeated rows
    repeat. Components whose variance is zero (constant dimensions, fewer rows than
    dimensions) give no rows; an empty or constant table gives none at all. ``deviation`` is
    null where it does not fit into 64 bits; ``deviation_digits`` always has all digits.
    Signs are fixed by the largest entry of an eigenvector. Other columns are not used.
    """
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    dims = dimension(rows, "v")
    model = Whitening(*moments(rows, "v", dims), components) if dims else None
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], OUTPUT)
    error = identity_error(rows, "v", model)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, max(1, BLOCK_VALUES // 8 // dims)):
                batch = whole.slice(at, max(1, BLOCK_VALUES // 8 // dims))
                kept, _, values = _vectors(batch, "v", dims)
                if not len(kept):
                    continue
                deviation, w = model.apply(integers(values).reshape(-1, dims))
                each = pa.array(np.repeat(np.arange(len(kept)), k))
                long = pa.array([d if d < 1 << 63 else None for d in deviation], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(kept)).take(each),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(kept))),
                     pa.array(np.full(len(each), model.n, np.int64)), long.take(each), pa.array(w.ravel()),
                     pa.array(np.tile(model.explained, len(kept))), pa.array(np.full(len(each), error)),
                     pa.array(list(map(str, deviation)), pa.string()).take(each)],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                     "deviation_digits"])

    return shipped(rows).mapInArrow(run, OUTPUT)


def op13_embedding_whitening(spark, sf_dir):
    return whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
