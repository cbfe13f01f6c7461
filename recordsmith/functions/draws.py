"""Seeded draws as pure functions of (seed, idx, field).

Every draw is the first 32 bits of ``md5("seed|idx|field")``, so a row's
values do not depend on partitioning, task order or retries, and DuckDB can
recompute them with the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _key(seed: Column, idx: Column, *parts: Column | str) -> Column:
    cols = [seed.cast("string"), idx.cast("string")]
    cols += [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat_ws("|", *cols)


def draw(seed: Column, idx: Column, field: str) -> Column:
    """Unsigned 32-bit integer drawn for ``field``."""
    return F.conv(F.substring(F.md5(_key(seed, idx, field)), 1, 8), 16, 10).cast("bigint")


def randint(seed: Column, idx: Column, field: str, lo: int, hi: int) -> Column:
    """Integer in ``[lo, hi]``."""
    return F.lit(lo) + F.pmod(draw(seed, idx, field), F.lit(hi - lo + 1))


def choice(seed: Column, idx: Column, field: str, values: list) -> Column:
    """G1: uniform pick from a fixed list."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(draw(seed, idx, field), F.lit(len(values))) + 1).cast("int"))


def sample(seed: Column, idx: Column, field: str, values: list[str], k: Column) -> Column:
    """``k`` distinct picks -- the list ordered by a per-item hash, first ``k`` kept."""
    arr = F.array(*[F.lit(v) for v in values])
    keyed = F.transform(arr, lambda x: F.concat(F.md5(_key(seed, idx, field, x)), x))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: F.substr(s, F.lit(33)))
