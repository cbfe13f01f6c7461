"""Run reports: stage comparison and deltas, training-log tables, best checkpoint
(A10, C22, C23, J5, P5, P6, W4, W5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recordsmith.operators.scan import running_min
from recordsmith.schemas import METRIC_NAMES


def stage_metrics(reports: DataFrame, stage_col: str = "stage") -> DataFrame:
    """Keep the stage key and the four metric columns of each report."""
    return reports.select(stage_col, *METRIC_NAMES)


def unpivot_metrics(reports: DataFrame, stage_col: str = "stage", order_col: str = "stage_no") -> DataFrame:
    """Wide stage reports to ``(stage, stage_no, metric, value)``."""
    return reports.unpivot([stage_col, order_col], METRIC_NAMES, "metric", "value")


def stage_delta(long: DataFrame, order_col: str = "stage_no", digits: int = 2) -> DataFrame:
    """Change of each metric from the previous stage, rounded.

    The window is partitioned by metric: one row per stage per metric, so each
    partition holds only the stages of one metric.
    """
    w = Window.partitionBy("metric").orderBy(order_col)
    prev = F.lag("value").over(w)
    return (long.withColumn("previous", prev)
            .where(F.col("previous").isNotNull())
            .withColumn("delta", F.round(F.col("value") - F.col("previous"), digits))
            .drop("previous"))


def log_tables(state: DataFrame) -> dict[str, DataFrame]:
    """``log_history`` exploded into train, eval and final-summary rows."""
    entries = state.select(F.explode("log_history").alias("e")).select("e.*")
    train = entries.where(F.col("loss").isNotNull()).select(
        "step", "epoch", "loss", "learning_rate", "grad_norm", "entropy", "mean_token_accuracy", "num_tokens")
    evals = entries.where(F.col("eval_loss").isNotNull()).select(
        "step", "epoch", "eval_loss", "eval_entropy", "eval_mean_token_accuracy", "eval_num_tokens",
        "eval_runtime", "eval_samples_per_second", "eval_steps_per_second")
    final = entries.where(F.col("train_runtime").isNotNull()).select(
        "step", "epoch", "total_flos", "train_loss", "train_runtime", "train_samples_per_second",
        "train_steps_per_second")
    return {"train": train, "eval": evals, "final": final}


def best_checkpoint(log: DataFrame, run_col: str, step_col: str, metric_col: str,
                    greater_is_better: bool = False) -> DataFrame:
    """A10: per run, the step with the best metric; ties go to the lowest step.

    ``min_by``/``max_by`` over a (metric, step) key: an aggregate with
    map-side partial aggregation, safe for a run holding most of the rows.
    """
    metric = F.col(metric_col) if not greater_is_better else -F.col(metric_col)
    key = F.struct(metric.alias("m"), F.col(step_col).alias("s"))
    best = F.min_by(F.struct(F.col(step_col).alias("step"), F.col(metric_col).alias("metric")), key)
    return (log.where(F.col(metric_col).isNotNull()).groupBy(run_col).agg(best.alias("_b"))
            .select(run_col, F.col("_b.step").alias("best_step"), F.col("_b.metric").alias("best_metric")))


def running_best(log: DataFrame, run_col: str, step_col: str, metric_col: str,
                 rows_per_chunk: int = 1_000_000) -> DataFrame:
    """Best (lowest) metric so far at every step of every run."""
    return running_min(log.where(F.col(metric_col).isNotNull()), run_col, step_col, metric_col,
                       "running_best", rows_per_chunk)
