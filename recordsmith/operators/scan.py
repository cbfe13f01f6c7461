"""Segmented running minimum that does not put a hot segment into one task.

``min(metric) OVER (PARTITION BY run ORDER BY step ROWS UNBOUNDED PRECEDING)``
sends every row of a run to one task. When one run holds a large share of
the rows that task dominates the job. Here the step axis is cut into chunks
of about ``rows_per_chunk`` rows (cut at quantiles of the step, so one far step does
not leave all others in one chunk), and:

1. a window per ``(run, chunk)`` gives the running min inside the chunk;
2. one aggregate row per ``(run, chunk)`` gives the chunk minimum;
3. a window per run over those chunk rows gives the minimum of all earlier
   chunks (a run has at most ``#chunks`` such rows);
4. the carry is joined back on ``(run, chunk)`` and combined with ``least``.

The result equals the plain window exactly; ties in step keep input order
irrelevant because min is order-insensitive within equal steps only when
steps are unique per run -- steps are assumed unique within a run. Rows without
a run form a run of their own; rows without a step come first in their run.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

DEFAULT_ROWS_PER_CHUNK = 1_000_000
# Most chunks, cut at approximate quantiles of the step.
QUANTILES = 1024


def running_min(df: DataFrame, run_col: str, step_col: str, metric_col: str,
                out_col: str = "running_best", rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    probes = [k / QUANTILES for k in range(1, QUANTILES)]
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(F.col(step_col).cast("double"), probes, 10_000).alias("cuts")).first()
    if not stats["n"]:
        return df.withColumn(out_col, F.lit(None).cast("double"))
    n_chunks = min(QUANTILES, max(1, math.ceil(stats["n"] / max(1, rows_per_chunk))))
    cuts = sorted({stats["cuts"][k * QUANTILES // n_chunks - 1] for k in range(1, n_chunks)}) if stats["cuts"] else []
    chunk = F.lit(0).cast("bigint")
    if cuts:
        below = F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(step_col).cast("double"))
        chunk = F.when(F.col(step_col).isNotNull(), F.size(below).cast("bigint"))
    chunked = df.withColumn("_chunk", chunk)

    inside = Window.partitionBy(run_col, "_chunk").orderBy(step_col).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked.withColumn("_local", F.min(metric_col).over(inside))

    chunk_min = chunked.groupBy(run_col, "_chunk").agg(F.min(metric_col).alias("_cmin"))
    before = Window.partitionBy(run_col).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunk_min.select(run_col, "_chunk", F.min("_cmin").over(before).alias("_carry"))

    carry = carry.withColumnsRenamed({run_col: "_run", "_chunk": "_c"})
    same = local[run_col].eqNullSafe(carry["_run"]) & local["_chunk"].eqNullSafe(carry["_c"])
    return (local.join(carry, same, "left")
            .withColumn(out_col, F.when(F.col("_carry").isNull(), F.col("_local"))
                        .otherwise(F.least(F.col("_local"), F.col("_carry"))))
            .drop("_chunk", "_local", "_carry", "_run", "_c"))
