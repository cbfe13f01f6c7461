"""Session construction and the runtime confs every operator relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL confs the operators depend on. They are session-scoped, so
# ``configure`` can apply them to a session someone else built.
RUNTIME_CONFS = {
    # Python's json keeps the last of duplicate keys; Spark returns NULL
    # unless this is on, and then also keeps the last one.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Dates are rendered as text; pin the zone so output does not depend on
    # the machine running the driver.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that came through a shuffle are read as JSON, which costs CPU: partitions are joined
    # to small ones, several a core, so that no core waits for a last large one.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONFS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates and streaming state.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem). Only when nothing is configured -- local tests -- do we pick
    a scratch folder ourselves.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="recordsmith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
        spark.sparkContext.setCheckpointDir(configured)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "recordsmith", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONFS.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
