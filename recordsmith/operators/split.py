"""Exact positional splits at scale.

The reference splits a shuffled list by position: the first ``int(n*0.8)``
rows are train, the next ``int(n*0.1)`` val, the rest test. Position needs a
global rank; a window without PARTITION BY would pull every row into one
task. Instead:

1. ``bucket``: a monotone function of the sort key (the leading 32 bits of
   an md5, or a linear map of a numeric key), sized so a bucket holds about
   ``rows_per_bucket`` rows;
2. ``counts``: rows per bucket -- one aggregate row per bucket, so its size
   is bounded by the bucket count, which is checked before it is broadcast;
3. ``offsets``: running sum of the counts (a window over that small table);
4. rank = offset + ``row_number()`` within the bucket (one shuffle by
   bucket; each window group is one bucket).

Sort keys are assumed distinct up to the tie-break column (ids are unique).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

# At most this many buckets, so the offsets table broadcast stays < ~40 MB.
MAX_BUCKETS = 1 << 20
DEFAULT_ROWS_PER_BUCKET = 1_000_000
# Most buckets of a numeric key, cut at its approximate quantiles.
QUANTILES = 1024


def _bucket_count(n: int, rows_per_bucket: int) -> int:
    nb = max(1, math.ceil(n / max(1, rows_per_bucket)))
    if nb > MAX_BUCKETS:
        nb = MAX_BUCKETS
    return nb


def md5_bucket(hex_col: Column, nb: int) -> Column:
    """Bucket of an md5 hex string: monotone in the hex order."""
    lead = F.conv(F.substring(hex_col, 1, 8), 16, 10).cast("bigint")
    return F.floor(lead.cast("double") * F.lit(float(nb)) / F.lit(float(1 << 32))).cast("bigint")


def exact_rank(df: DataFrame, order_cols: list[str], bucket: Column, nb: int,
               rank_col: str = "rank") -> DataFrame:
    """0-based global rank by ``order_cols`` given a monotone ``bucket`` expression.

    ``bucket`` must be non-decreasing in the ``order_cols`` order and lie in
    ``[0, nb)``.
    """
    if nb > MAX_BUCKETS:
        raise ValueError(f"{nb} buckets exceeds the broadcast bound {MAX_BUCKETS}")
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # nb rows at most: a running sum over it is cheap even in one partition.
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy(*order_cols)
    return (b.join(F.broadcast(offsets), "_bucket")
            .withColumn(rank_col, F.col("_offset") + F.row_number().over(within) - 1)
            .drop("_bucket", "_offset"))


def rank_by_hash(df: DataFrame, hash_col: str, tie_col: str, n: int | None = None,
                 rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, rank_col: str = "rank") -> DataFrame:
    """Rank by an md5 hex column (then ``tie_col``)."""
    n = df.count() if n is None else n
    nb = _bucket_count(n, rows_per_bucket)
    return exact_rank(df, [hash_col, tie_col], md5_bucket(F.col(hash_col), nb), nb, rank_col)


def rank_by_key(df: DataFrame, key_col: str, tie_cols: list[str] | None = None,
                rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, rank_col: str = "rank") -> tuple[DataFrame, int]:
    """Rank by a numeric key (the row's ordinal in file order, an order key...), then by
    ``tie_cols``; rows without a key come first. Returns the frame and its row count.

    Buckets are cut at quantiles of the key, so an outlying key does not empty the others.
    """
    probes = [k / QUANTILES for k in range(1, QUANTILES)]
    stats = df.agg(F.count(F.lit(1)).alias("n"),
                   F.percentile_approx(F.col(key_col).cast("double"), probes, 10_000).alias("cuts")).first()
    n = stats["n"]
    if not n:
        return df.withColumn(rank_col, F.lit(None).cast("bigint")), 0
    nb = min(QUANTILES, _bucket_count(n, rows_per_bucket))
    cuts = sorted({stats["cuts"][k * QUANTILES // nb - 1] for k in range(1, nb)}) if stats["cuts"] else []
    bucket = F.lit(0).cast("bigint")
    if cuts:
        above = F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(key_col).cast("double"))
        bucket = F.when(F.col(key_col).isNull(), F.lit(0)).otherwise(F.size(above)).cast("bigint")
    return exact_rank(df, [key_col, *(tie_cols or [])], bucket, len(cuts) + 1, rank_col), n


def key_at(df: DataFrame, key_col: str, position: int, n: int):
    """The numeric key at a 0-based position among all ``n`` rows, rows without a key first.

    Approximate quantiles around the position bracket it, rows below the bracket are counted,
    and only the keys inside are sorted. No row moves but these.
    """
    key = F.col(key_col).cast("double")
    near = [min(1.0, max(0.0, position / n + d)) for d in (-0.001, 0.001)]
    count = df.agg(F.count(key).alias("k"), F.percentile_approx(key, near, 10_000).alias("cuts")).first()
    at = position - (n - count["k"])
    if at < 0:
        return None
    lo, hi = count["cuts"]
    for low, high in ((lo, hi), (None, None)):              # the whole table if the bracket missed
        below = df.where(key < low).count() if low is not None else 0
        inside = df.where(F.col(key_col).isNotNull() if low is None else (key >= low) & (key <= high))
        found = inside.select(key_col).orderBy(key_col).offset(at - below).limit(1).first() if at >= below else None
        if found is not None:
            return found[0]


def split_bounds(n: int, ratios: list[float]) -> list[int]:
    """Cut points of a positional split: ``int(n*r)`` per part, remainder last."""
    bounds, acc = [], 0
    for r in ratios:
        acc += int(n * r)
        bounds.append(acc)
    return bounds


def assign_split(rank: Column, n: int, names: list[str], ratios: list[float]) -> Column:
    """Name of the part a 0-based rank falls in (U3: disjoint, covering)."""
    bounds = split_bounds(n, ratios)
    expr = None
    for name, bound in zip(names, bounds):
        expr = F.when(rank < bound, F.lit(name)) if expr is None else expr.when(rank < bound, F.lit(name))
    return expr.otherwise(F.lit(names[len(bounds)]))


def exact_split(df: DataFrame, hash_col: str = "shuffle_key", tie_col: str = "id",
                train_ratio: float = 0.8, val_ratio: float = 0.1,
                rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Train / val / test by position in the seeded shuffle order.

    Adds ``ordinal`` (position in the shuffled corpus) and ``split``.
    """
    n = df.count()
    ranked = rank_by_hash(df, hash_col, tie_col, n, rows_per_bucket, "ordinal")
    return ranked.withColumn("split", assign_split(F.col("ordinal"), n, ["train", "val", "test"],
                                                   [train_ratio, val_ratio]))


def boundary_split(df: DataFrame, hash_col: str, tie_col: str, names: tuple[str, ...] = ("train", "val", "test"),
                   ratios: tuple[float, ...] = (0.8, 0.1), rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """W2 without an ordinal: ``df`` with the column ``split``, its rows not moved.

    A positional split is decided by the rows at the cut positions. One aggregate counts
    the rows of each hash bucket; a cut's row is then looked up inside the one bucket that
    holds it (some ``rows_per_bucket`` keys), and every row compares itself with the cuts.
    Rows that share hash and tie go to the same side; rows without a tie column count first.
    """
    keys = df.select(F.col(hash_col).alias("h"), F.col(tie_col).alias("t"))
    total = keys.count()
    nb = _bucket_count(total, rows_per_bucket)
    keys = keys.withColumn("b", md5_bucket(F.col("h"), nb))
    counts = {r["b"]: r["n"] for r in keys.groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()}   # nb rows at most
    cuts, before, bounds = [], 0, split_bounds(total, list(ratios))
    for b in sorted(counts, key=lambda x: (x is not None, x)):
        for bound in bounds:
            if before <= bound < before + counts[b]:
                inside = keys.where(F.col("b").eqNullSafe(F.lit(b))).orderBy("h", "t").offset(bound - before).limit(1)
                cuts.append((bound, inside.select("h", "t").first()))
        before += counts[b]
    cuts = dict(cuts)
    here = F.struct(F.col(hash_col).alias("h"), F.col(tie_col).alias("t"))
    kinds = dict(df.dtypes)
    expr = F.lit(names[len(bounds)])
    for name, bound in reversed(list(zip(names, bounds))):
        if bound in cuts:
            h, t = (F.lit(v).cast(kinds[c]) for v, c in zip(cuts[bound], (hash_col, tie_col)))
            expr = F.when(here < F.struct(h.alias("h"), t.alias("t")), F.lit(name)).otherwise(expr)
        else:                                                # the cut is behind the last row
            expr = F.lit(name)
    return df.withColumn("split", expr)


def pair_split(df: DataFrame, ordinal_col: str = "ordinal", train_ratio: float = 0.8,
               rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """First ``int(n*train_ratio)`` rows by input ordinal are train, the rest val."""
    ties = ["id"] if "id" in df.columns and ordinal_col != "id" else None
    ranked, n = rank_by_key(df, ordinal_col, ties, rows_per_bucket, "_pos")
    return ranked.withColumn("split", assign_split(F.col("_pos"), n, ["train", "val"], [train_ratio])).drop("_pos")


def head_by_ordinal(df: DataFrame, limit: int | None, ordinal_col: str = "ordinal") -> DataFrame:
    """first ``limit`` rows in file order; 0 or None means all rows.

    ``orderBy(...).limit(k)`` plans as a per-partition top-k then a merge of
    k rows per partition (TakeOrderedAndProject), never a full sort.
    """
    if not limit:
        return df
    return df.orderBy(ordinal_col).limit(limit)
