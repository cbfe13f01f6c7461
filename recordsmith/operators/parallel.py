"""Parallelism guard for CPU-heavy, row-local operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, *keys: str) -> DataFrame:
    """Spread the rows of a table scan over at least ``defaultParallelism`` partitions.

    For scans only: counting the partitions of a scan runs no job, while a plan with a
    shuffle would be executed to count them.

    Parsing and flattening cost CPU per row, not I/O. A large input already
    arrives in thousands of splits and is left untouched; a small one (a
    single Parquet row group) would otherwise run on one core. The hash
    repartition on ``keys`` is deterministic, so a retried task after an
    executor loss recomputes the same rows.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The narrow rows of a table scan, hashed on ``keys`` into four times as many partitions as
    the scan or the cluster has, for work of much CPU a row.

    The splits of one file may outnumber its row groups, and those without one hold no rows:
    only as many files as tasks need no move.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    return df if len(df.inputFiles()) >= tasks else df.repartition(4 * tasks, *keys)
