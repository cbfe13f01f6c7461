"""Documents read row by row from text: the same results as the VARIANT functions, in one pass."""

import json

import pytest
from pyspark.sql import functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import rowjson as R
from recordsmith.functions import scoring as S
from recordsmith.operators.conform import nested_conformance, schema_faults
from recordsmith.operators.evaluate import score_predictions
from recordsmith.operators.flatten import flatten_json
from recordsmith.plans.catalog import ORDER_RECORD_FIELDS, ORDER_SCHEMA, queries

RECORD = {"order_id": 7, "customer": "é", "order_date": "d", "priority": "p", "total_cents": 1, "tags": ["x"],
          "parties": [{"name": "n", "nation": "m"}], "amounts": {"total_cents": 1, "balance_cents": -2}}
WHOLE = {"can_extract": True, "refusal_reason": None, "record": RECORD}
TEXTS = [None, "", "  ", "null", "{}", "[]", "[1]", "true", "-0", "1.0", "1e5", "-0.0", "1e400", "NaN", "[Infinity]", "01", "1 2", "}{",
         "12345678901234567890123", "0.00001234", "1.10", '"a"', '"\\u000b\\u001f\\t\\\\u001f"', '"日本\\ud83d\\ude00"', '"\\u0001n5"',
         '{"a":1,"a":2}', '{"b":1,"a":{"c":[1,{"d":[]}]}}', '{"a.b":1,"a":{"b":2}}', '{"":{"x":1}}', '{"a":1}x', 'so {"a":1.50} end', "﻿{}",
         ' {"a":1} ', '{"a":"\n"}', '{"a":"\\x"}', json.dumps(WHOLE), json.dumps({**WHOLE, "record": None}),
         json.dumps({**WHOLE, "record": {**RECORD, "order_id": 7.0}}), json.dumps({**WHOLE, "can_extract": 1}),
         json.dumps({"can_extract": False, "refusal_reason": "r"}), '{"record":{"a":"","b":0,"c":[],"d":{},"e":null,"f":false}}',
         json.dumps({**WHOLE, "record": {**RECORD, "tags": "x", "note": {"k": [1]}}})]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    return df.select("id", "t", J.extract_json_block("t").alias("v")).cache()


def test_columns_equal_the_variant_functions(docs):
    both = docs.select("id", "t", "v", R.document("t").alias("d"), R.conformance("t", ORDER_RECORD_FIELDS).alias("ok"), R.leaf_list("t").alias("l"))
    rows = both.select(
        "t", F.struct("d.canonical", "d.kind", S.confidence_of(F.col("d.kind").isNull(), F.col("d.refused"), F.col("d.populated")), "ok", F.array_sort("l")).alias("got"),
        F.struct(J.canonical_json("v"), J.kind(F.col("v")), S.confidence(F.col("v")), S.schema_conformance("v", ORDER_RECORD_FIELDS),
                 F.array_sort(J.flatten_leaves("v"))).alias("want")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert tuple(r["got"]) == tuple(r["want"]), r["t"]


def test_tables_equal_the_variant_forms(docs):
    for of in (lambda c: flatten_json(docs, "id", c), lambda c: schema_faults(docs, "id", c, ORDER_SCHEMA),
               lambda c: nested_conformance(docs, "id", c, ORDER_SCHEMA)):
        got, want = (sorted(map(repr, of(c).collect())) for c in ("t", "v"))
        assert got == want and want


def test_scores_equal_the_variant_functions(spark):
    targets = ["{}", json.dumps(WHOLE), json.dumps({**WHOLE, "can_extract": 1.0}), '{"a":1}', '{"a":1.0}', "null", None]
    rows = [(i * 100 + j, t, g) for i, t in enumerate(TEXTS) for j, g in enumerate(targets)]
    df = spark.createDataFrame(rows, "id int, raw_output string, target_text string")
    got = {r["id"]: tuple(r)[4:] for r in score_predictions(df).collect()}
    v = df.select("id", J.extract_json_block("raw_output").alias("p"), J.parse_target("target_text").alias("t"))
    want = v.select("id", F.col("p").isNotNull(), S.exact_match(F.col("p"), F.col("t")), S.field_f1(F.col("p"), F.col("t")),
                    S.refusal_correct("p", "t")).collect()
    assert got == {r[0]: tuple(r)[1:] for r in want}


def test_a_corrupt_target_fails(spark):
    df = spark.createDataFrame([("a", "{}", "{")], "id string, raw_output string, target_text string")
    with pytest.raises(Exception):
        score_predictions(df).select("field_f1").collect()


@pytest.mark.parametrize("name", ["stage_report", "field_f1", "judge_parse", "schema_nested", "flatten_json", "schema_check"])
def test_documents_are_read_once(spark, name):
    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("keys", [[5, 1, 9, 3], [7] * 40, [1] * 10 + [2] * 30 + [3], [None] * 5 + [4, 4, 2], list(range(30_000)), [None] * 20, [1], []])
def test_corpus_index_marks_the_last_keys(spark, keys):
    from recordsmith.operators import synth as SY
    index = SY.corpus_index(spark.createDataFrame([(k,) for k in keys], "idx long"))
    ordered = sorted(keys, key=lambda k: (k is not None, k or 0))
    last = int(len(keys) * 0.12)
    got = sorted(((r["idx"], r["refusal"]) for r in index.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert got == [(k, i >= len(keys) - last) for i, k in enumerate(ordered)]


def test_notes_are_made_where_their_keys_are_read(spark):
    plan = queries()["synth_notes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning(_bucket" not in plan


def test_user_prompt_takes_the_whole_corpus_and_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = queries()["user_prompt"](spark, sf).select(F.substring_index("id", "-", 1).alias("k")).groupBy("k").count().collect()
    counts = {r["k"]: r["count"] for r in got}
    assert counts.pop("document") == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert sum(counts.values()) == spark.read.parquet(f"{sf}/orders.parquet").count()
