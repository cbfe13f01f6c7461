"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordsmith.session import checkpoint_root
from recordsmith.ship import shipped

# Words are runs without space, tab, newline, vertical tab, form feed, return.
WORD_GAP = r"[\x20\x09-\x0D]+"
# Rows per slice handed to a task function: bounds Python memory by rows and bytes.
SLICE_ROWS = 1024
SLICE_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and the
    copy survives the loss of any executor. The shuffle files behind it are not needed any
    more; Spark removes them once the driver's collector has seen that, which is asked for."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see that the frames of finished jobs are gone: their shuffle files are
    removed now, not at the driver's next collection of its own."""
    spark._jvm.System.gc()


def drop_stash(df: DataFrame) -> None:
    """Delete the files behind a frame that ``stash`` returned and nobody reads again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(value: Column) -> Column:
    """``value``, kept where it is computed: a filter on it is not pushed below the
    projection, which would copy the whole chain of expressions behind it."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def words_of(text: Column) -> Column:
    """Words of a text (null or blank: empty array), by built-in functions."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.filter(parts, lambda w: w != "")


def slices(batches: Iterator[pa.RecordBatch], text: str | None = None,
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of bounded rows and (by ``text``) bounded bytes."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            rows = min(SLICE_ROWS, batch.num_rows - start)
            if text is not None:
                while rows > 1 and batch.column(text).slice(start, rows).nbytes > most:
                    rows //= 2
            yield batch.slice(start, rows)
            start += rows


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema,
               text: str | None = None, most: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over bounded slices; the package travels to the workers."""
    def run(batches):
        for piece in slices(batches, text, most):
            out = fn(piece)
            if out is not None:
                yield out
    return shipped(df).mapInArrow(run, schema)
