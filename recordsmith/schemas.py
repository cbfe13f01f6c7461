"""Fixed schemas of the extraction data model (DDL strings and StructTypes)."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD_DDL = (
    "STRUCT<patient_name: STRING, age: BIGINT, sex: STRING, encounter_date: STRING, "
    "chief_complaint: STRING, diagnoses: ARRAY<STRING>, "
    "medications: ARRAY<STRUCT<name: STRING, dose: STRING>>, "
    "allergies: ARRAY<STRING>, "
    "vitals: STRUCT<blood_pressure: STRING, heart_rate: BIGINT, temperature_f: DOUBLE>, "
    "follow_up_days: BIGINT>"
)
TARGET_DDL = f"STRUCT<can_extract: BOOLEAN, refusal_reason: STRING, record: {RECORD_DDL}>"
EXAMPLE_DDL = (f"id STRING, input_text STRING, schema_hint STRING, target_json {TARGET_DDL}, "
               "can_extract BOOLEAN, domain STRING")



def parse_ddl(ddl: str) -> T.DataType:
    """DDL text to a DataType (needs an active SparkContext)."""
    return T._parse_datatype_string(ddl)

DATASET_CARD_DDL = ("dataset_name STRING, num_examples BIGINT, seed BIGINT, "
                    "schema STRING, refusal_policy STRING")
RAW_OUTPUT_DDL = "id STRING, raw_output STRING"
PREDICTION_DDL = "id STRING, raw_output STRING, parsed_output STRING, target_json STRING"
EVAL_REPORT_DDL = ("samples BIGINT, json_validity_rate DOUBLE, exact_match_accuracy DOUBLE, "
                   "field_level_f1 DOUBLE, refusal_correctness DOUBLE")
CANDIDATES_DDL = "id STRING, candidate_index INT, text STRING"
VERDICT_DDL = "id STRING, output_text STRING"
PAIR_DDL = "id STRING, prompt STRING, chosen STRING, rejected STRING, label_reason STRING"
EXTRACT_IN_DDL = "text STRING, schema_hint STRING"
EXTRACT_OUT_DDL = "structured_json STRING, confidence DOUBLE, raw_output STRING"
RUN_SUMMARY_DDL = ("eval_samples BIGINT, total_flos DOUBLE, train_loss DOUBLE, train_runtime DOUBLE, "
                   "train_samples BIGINT, train_samples_per_second DOUBLE, train_steps_per_second DOUBLE")

# Union of the keys that appear in trainer-state ``log_history`` entries: train
# rows, eval rows and the final summary row each fill a different subset.
LOG_ENTRY = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("epoch", T.DoubleType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("grad_norm", T.DoubleType()),
    T.StructField("entropy", T.DoubleType()),
    T.StructField("mean_token_accuracy", T.DoubleType()),
    T.StructField("num_tokens", T.DoubleType()),
    T.StructField("eval_loss", T.DoubleType()),
    T.StructField("eval_entropy", T.DoubleType()),
    T.StructField("eval_mean_token_accuracy", T.DoubleType()),
    T.StructField("eval_num_tokens", T.DoubleType()),
    T.StructField("eval_runtime", T.DoubleType()),
    T.StructField("eval_samples_per_second", T.DoubleType()),
    T.StructField("eval_steps_per_second", T.DoubleType()),
    T.StructField("total_flos", T.DoubleType()),
    T.StructField("train_loss", T.DoubleType()),
    T.StructField("train_runtime", T.DoubleType()),
    T.StructField("train_samples_per_second", T.DoubleType()),
    T.StructField("train_steps_per_second", T.DoubleType()),
])

TRAINER_STATE = T.StructType([
    T.StructField("best_global_step", T.LongType()),
    T.StructField("best_metric", T.DoubleType()),
    T.StructField("best_model_checkpoint", T.StringType()),
    T.StructField("epoch", T.DoubleType()),
    T.StructField("global_step", T.LongType()),
    T.StructField("log_history", T.ArrayType(LOG_ENTRY)),
])

EVAL_REPORT_FILE = T.StructType([
    T.StructField("samples", T.LongType()),
    T.StructField("json_validity_rate", T.DoubleType()),
    T.StructField("exact_match_accuracy", T.DoubleType()),
    T.StructField("field_level_f1", T.DoubleType()),
    T.StructField("refusal_correctness", T.DoubleType()),
])

METRIC_NAMES = ["json_validity_rate", "exact_match_accuracy", "field_level_f1", "refusal_correctness"]
