"""Continuous extraction -- raw outputs arrive as files, parsed JSON and
confidence leave as files.

The transformation is the batch one (C1 + C16 are column functions), so a
stream and a batch over the same files give the same rows. The job is
stateless: no watermark or state store is needed, and the checkpoint only
records which files were processed, so a restarted query (or a lost
executor) resumes exactly once into the file sink.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from recordsmith.functions import jsonparse as J
from recordsmith.functions import scoring as S
from recordsmith.operators.extract import template_record
from recordsmith.session import checkpoint_root


def extraction_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    parsed = df.select(F.col(id_col), F.col(text_col).alias("raw_output"),
                       J.extract_json_block(text_col).alias("_p"))
    return parsed.select(id_col, J.canonical_json("_p").alias("structured_json"),
                         S.confidence(F.col("_p")).alias("confidence"), "raw_output")


def note_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The same for notes: the template (C18) answers, its text is parsed and rated."""
    answers = df.select(F.col(id_col), F.to_json(template_record(F.col(text_col)), {"ignoreNullFields": "false"}).alias("_answer"))
    return extraction_columns(answers, id_col, "_answer")


def start_extract_stream(spark: SparkSession, source: str, schema: str, id_col: str, text_col: str,
                         out_dir: str, checkpoint_dir: str, fmt: str = "parquet",
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         glob_filter: str | None = None, columns=extraction_columns) -> StreamingQuery:
    """``columns(df, id_col, text_col)`` are the rows that go to the sink: ``extraction_columns``
    for raw outputs, ``note_columns`` for notes."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = columns(reader.load(source), id_col, text_col)
    writer = (out.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_extract_stream(spark: SparkSession, source: str, schema: str, id_col: str, text_col: str,
                       fmt: str = "parquet", glob_filter: str | None = None) -> DataFrame:
    """Run the stream over everything available now and return the sink as a DataFrame.

    Sink and checkpoint go under the cluster's shared checkpoint folder.
    """
    base = f"{checkpoint_root(spark)}/stream_extract/{uuid.uuid4().hex}"
    q = start_extract_stream(spark, source, schema, id_col, text_col, f"{base}/out", f"{base}/ckpt", fmt,
                             glob_filter=glob_filter)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")
