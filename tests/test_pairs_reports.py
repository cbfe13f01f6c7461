"""Preference pairs, verdict parsing, reports and the chunked running minimum."""

import json

import pytest
from pyspark.sql import Window, functions as F

from recordsmith.operators import pairs as PR
from recordsmith.operators import report as RP
from recordsmith.operators.scan import running_min


def test_verdict_lookup_python_indexing(spark):
    df = spark.createDataFrame([(["x", "y"], i) for i in (0, 1, -1)], "c array<string>, i int")
    assert [r.v for r in df.select(PR.py_index(F.col("c"), F.col("i")).alias("v")).collect()] == ["x", "y", "y"]
    bad = spark.createDataFrame([(["x", "y"], 2)], "c array<string>, i int")
    assert bad.select(PR.py_index(F.col("c"), F.col("i"), strict=False).alias("v")).first().v is None
    with pytest.raises(Exception):
        bad.select(PR.py_index(F.col("c"), F.col("i")).alias("v")).collect()


def test_parse_verdicts_quarantine(spark):
    rows = [("a", 'Sure {"chosen_index": 1, "rejected_index": 0, "reason": "r"} ok'),
            ("b", "no braces here"),
            ("c", '} reversed {'),
            ("d", '{"chosen_index": "1", "rejected_index": 0, "reason": "r"}')]
    good, bad = PR.parse_verdicts(spark.createDataFrame(rows, "id string, output_text string"), "quarantine")
    assert [(r.id, r.chosen_index, r.rejected_index, r.reason) for r in good.collect()] == [("a", 1, 0, "r")]
    assert sorted(r.id for r in bad.collect()) == ["b", "c", "d"]
    strict, _ = PR.parse_verdicts(spark.createDataFrame(rows[1:2], "id string, output_text string"))
    with pytest.raises(Exception):
        strict.collect()


def test_rule_judge_order_and_ties(spark):
    rows = [("a", 0, True, True, 0.5, True), ("a", 1, True, True, 1.0, True), ("a", 2, False, False, 0.0, False),
            ("b", 0, True, True, 1.0, True), ("b", 1, True, True, 1.0, True)]
    df = spark.createDataFrame(rows, "id string, candidate_index int, json_valid boolean, schema_ok boolean, "
                                     "field_f1 double, refusal_correct boolean")
    got = {r.id: (r.chosen_index, r.rejected_index) for r in PR.rule_judge(df).collect()}
    assert got == {"a": (1, 2), "b": (0, 1)}


def test_candidates_map_roundtrip_and_pairs(spark):
    doc = spark.createDataFrame([({"r1": ["x", "y"], "r2": ["p", "q", "s"]},)], "value map<string,array<string>>")
    long = PR.candidates_from_map(doc)
    lists = {r.id: r.candidates for r in PR.candidate_lists(long).collect()}
    assert lists == {"r1": ["x", "y"], "r2": ["p", "q", "s"]}
    rows = spark.createDataFrame([("r1", "note", "hint")], "id string, input_text string, schema_hint string")
    attached = PR.attach_candidates(rows, PR.candidate_lists(long))
    verdicts = spark.createDataFrame([("r1", 0, -1, "why")], "id string, chosen_index int, rejected_index int, reason string")
    pair = PR.preference_pairs(attached, verdicts).first()
    assert (pair.chosen, pair.rejected, pair.label_reason, pair.same_choice) == ("x", "y", "why", False)
    assert pair.prompt.endswith("Schema hint: hint\nInput note:\nnote")
    missing = spark.createDataFrame([("zz", "n", "h")], "id string, input_text string, schema_hint string")
    with pytest.raises(Exception):
        PR.attach_candidates(missing, PR.candidate_lists(long)).collect()


# eval_loss by step 50..600 of the stored training log (FIXTURES §3).
EVAL_LOSS = [0.23336036503314972, 0.08988916128873825, 0.0802745446562767, 0.07944517582654953,
             0.07883018255233765, 0.078376404941082, 0.07784710824489594, 0.07774534821510315,
             0.077552430331707, 0.07746610045433044, 0.07741504907608032, 0.0774024948477745]


def test_best_checkpoint_and_running_best(spark):
    log = spark.createDataFrame([("sft", 50 * (i + 1), v) for i, v in enumerate(EVAL_LOSS)],
                                "run string, step long, eval_loss double")
    best = RP.best_checkpoint(log, "run", "step", "eval_loss").first()
    assert (best.best_step, best.best_metric) == (600, 0.0774024948477745)
    rb = [r.running_best for r in RP.running_best(log, "run", "step", "eval_loss").orderBy("step").collect()]
    assert rb == EVAL_LOSS


def test_running_min_chunks_equal_window(spark):
    import random
    rnd = random.Random(3)
    rows = [("hot", i, rnd.random()) for i in range(600)] + [(f"r{i % 7}", i, rnd.random()) for i in range(600, 700)]
    df = spark.createDataFrame(rows, "run string, step long, m double")
    got = {r.step: r.running_best for r in running_min(df, "run", "step", "m", rows_per_chunk=37).collect()}
    w = Window.partitionBy("run").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.step: r.x for r in df.select("step", F.min("m").over(w).alias("x")).collect()}
    assert got == want


def test_best_checkpoint_ties_lowest_step(spark):
    log = spark.createDataFrame([("a", 3, 1.0), ("a", 1, 1.0), ("a", 2, 2.0)], "run string, step long, m double")
    assert RP.best_checkpoint(log, "run", "step", "m").first().best_step == 1


def test_stage_deltas_from_targets(spark):
    targets = [("baseline", 0, 45.0, 22.0, 48.0, 61.0), ("sft", 1, 91.0, 68.0, 84.0, 93.0),
               ("dpo", 2, 96.0, 74.0, 88.0, 96.0)]
    rep = spark.createDataFrame(targets, "stage string, stage_no int, json_validity_rate double, "
                                         "exact_match_accuracy double, field_level_f1 double, refusal_correctness double")
    d = RP.stage_delta(RP.unpivot_metrics(rep))
    got = {(r.stage, r.metric): r.delta for r in d.collect()}
    assert [got[("sft", m)] for m in ("json_validity_rate", "exact_match_accuracy", "field_level_f1",
                                      "refusal_correctness")] == [46.0, 46.0, 36.0, 32.0]
    assert [got[("dpo", m)] for m in ("json_validity_rate", "exact_match_accuracy", "field_level_f1",
                                      "refusal_correctness")] == [5.0, 6.0, 4.0, 3.0]


def test_trainer_state_log_tables(spark, tmp_dir):
    from recordsmith.sources.files import read_trainer_state
    state = {"best_global_step": 600, "best_metric": 0.0774024948477745, "global_step": 600, "epoch": 3.0,
             "log_history": [
                 {"step": 10, "epoch": 0.05, "loss": 1.2, "learning_rate": 0.0002, "grad_norm": 0.5,
                  "entropy": 1.1, "mean_token_accuracy": 0.7, "num_tokens": 7000.0},
                 {"step": 50, "epoch": 0.25, "eval_loss": 0.23336036503314972, "eval_runtime": 55.0,
                  "eval_samples_per_second": 7.2, "eval_steps_per_second": 1.8, "eval_entropy": 0.3,
                  "eval_mean_token_accuracy": 0.94697, "eval_num_tokens": 80000.0},
                 {"step": 600, "epoch": 3.0, "total_flos": 8.038367534432256e16, "train_loss": 0.21022979994614918,
                  "train_runtime": 4668.7807, "train_samples_per_second": 2.056, "train_steps_per_second": 0.129}]}
    path = f"{tmp_dir}/trainer_state.json"
    with open(path, "w") as fh:
        json.dump(state, fh, indent=2)
    tables = RP.log_tables(read_trainer_state(spark, path))
    assert [r.step for r in tables["train"].collect()] == [10]
    assert [r.eval_loss for r in tables["eval"].collect()] == [0.23336036503314972]
    assert [r.train_runtime for r in tables["final"].collect()] == [4668.7807]
