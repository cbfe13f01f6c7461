"""Evaluation of raw model outputs against targets.

``score_predictions`` is one narrow projection (one pass, four scores);
``eval_report`` is a single global aggregate with partial aggregation on
every partition, so the only data crossing the network is one partial row
per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import rowjson as R
from recordsmith.functions import scoring as S


def join_predictions(predictions: DataFrame, examples: DataFrame, on: str = "id") -> DataFrame:
    """Predictions (id, raw_output) with their examples (id, target...).

    Left join on the example id, shuffled on the id hash; AQE switches to a broadcast when
    one side turns out small and splits skewed partitions. A prediction without an example
    fails the run: scored rows must not get lost. The check is a filter, so column pruning
    cannot take it away.
    """
    known = examples.withColumn("_known", F.lit(True))
    joined = predictions.join(known, on=on, how="left")
    return joined.where(F.when(F.col("_known"), F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit("no example for prediction "), F.col(on).cast("string"))).cast("boolean"))).drop("_known")


def score_predictions(df: DataFrame, raw_col: str = "raw_output", target_col: str = "target_text",
                      keep: tuple[str, ...] = ("id",), record_fields: dict[str, str] | None = None) -> DataFrame:
    """Per-row detail: parsed output (canonical JSON text) and the four scores.

    ``target_col`` is JSON text (as written by the corpus sinks) or a VARIANT; a corrupt text
    fails the run. Predictions go through the two-attempt strict parse. The scores come from
    one pass over both texts (``rowjson``), the canonical texts from passes of their own that
    are pruned where no query asks for them. Everything stays row-local: no explode, no shuffle.
    """
    k = [F.col(c) for c in keep]
    target = F.col(target_col) if dict(df.dtypes)[target_col] == "string" else J.canonical_json(target_col)
    texts = df.select(*k, F.col(raw_col).alias("raw_output"), target.alias("_target"))
    rated = texts.select(*k, "raw_output", "_target", R.scores("raw_output", "_target", record_fields or None).alias("_s"))
    return rated.select(
        *k,
        "raw_output",
        R.document("raw_output")["canonical"].alias("parsed_output"),
        R.document("_target", "target")["canonical"].alias("target_json"),
        F.col("_s.json_valid").alias("json_valid"),
        F.col("_s.exact_match").alias("exact_match"),
        S.f1_from_counts(F.col("_s.n_common"), F.col("_s.n_pred"), F.col("_s.n_target"), ~F.col("_s.json_valid")).alias("field_f1"),
        F.col("_s.refusal_correct").alias("refusal_correct"),
        *([F.col("_s.schema_ok").alias("schema_ok")] if record_fields else []),
    )


def eval_report(scored: DataFrame, group_cols: tuple[str, ...] = (), digits: int = 2) -> DataFrame:
    """C15 aggregate: samples and four percentages rounded like the reference.

    With no rows the rates are NULL (the reference divides by zero).
    """
    def pct(flag):
        return F.round(F.avg(flag.cast("double")) * F.lit(100.0), digits)

    aggs = [
        F.count(F.lit(1)).alias("samples"),
        pct(F.col("json_valid")).alias("json_validity_rate"),
        pct(F.col("exact_match")).alias("exact_match_accuracy"),
        pct(F.col("field_f1")).alias("field_level_f1"),
        pct(F.col("refusal_correct")).alias("refusal_correctness"),
    ]
    if group_cols:
        return scored.groupBy(*group_cols).agg(*aggs)
    return scored.agg(*aggs)


def report_without_detail(report: DataFrame) -> DataFrame:
    """P5: the report minus the per-row predictions column, if present."""
    return report.drop("predictions")
