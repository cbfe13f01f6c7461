"""What the findings of round 3 asked for: one pass a row, nothing moved that need not be, the same rows."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordsmith.functions import rowjson as R
from recordsmith.llm import substrings
from recordsmith.operators import extract as EX
from recordsmith.operators import pairs as PR
from recordsmith.operators.conform import nested_conformance
from recordsmith.operators.parallel import spread
from recordsmith.operators.pretty import pretty_json
from recordsmith.operators import score_long as score_long_module
from recordsmith.operators.score_long import score_documents_long
from recordsmith.plans.catalog import ORDER_SCHEMA
from recordsmith.sources import bigmap
from recordsmith.sources.corpus import order_candidates, order_source
from recordsmith.sources.files import read_candidates_map


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_before_a_trailer_is_read_once(monkeypatch):
    calls, scan = [], R._scan
    monkeypatch.setattr(R, "_scan", lambda s: calls.append(s) or scan(s))
    assert R.parse_block(' {"a": [1, {}]} END') == {"a": [1, {}]} and len(calls) == 1
    assert R.parse_block('so {"a":1} END') == {"a": 1} and R.parse_block('{"a":1} {"b":2}') is R.ABSENT


def test_equal_documents_need_no_canonical_text(monkeypatch):
    monkeypatch.setattr(R, "canonical", lambda v: pytest.fail("written"))
    text = '{"b": [1, 2.0, {}], "a": "x"}'
    got = R._scored(None, pa.array([text, '{"b": [1, 2, {}], "a": "x"}']), pa.array([text, text]))
    assert [r["exact_match"] for r in got.to_pylist()] == [True, False]


def test_score_long_reads_both_documents_in_one_pass(spark):
    rows = [("a", '{"x":1,"y":{"z":"q"}}', '{"x":1,"y":{"z":"r"},"w":null}'), ("a", '{"x":0}', None), ("b", "no", '{"x":1}'),
            ("c", "{}", "{}"), ("d", None, None), (None, '{"x":1}', '{"x":1}'), ("e", '{"k.m":2,"k":{"m":1}}', '{"k.m":1}')]
    scored = score_documents_long(spark.createDataFrame(rows, "id string, r string, t string"), "id", "r", "t")
    assert _plan(scored).count("ArrowEvalPython") == 1 and "Union" not in _plan(scored)
    got = {r["id"]: (r["n_pred"], r["n_target"], r["n_common"], r["field_f1"]) for r in scored.collect()}
    assert got == {"a": (2, 3, 0, 0.0), "b": (0, 1, 0, 0.0), "c": (0, 0, 0, 1.0), "d": (0, 0, 0, 0.0), "e": (1, 1, 1, 1.0)}


def test_only_faulty_places_leave_a_document(spark):
    df = spark.createDataFrame([(1, '{"can_extract":1,"record":{"order_id":2,"new":[3]}}'), (1, "x"), (2, None)], "id int, t string")
    checked = nested_conformance(df, "id", "t", ORDER_SCHEMA)
    assert "Join" not in _plan(checked)
    got = {r["id"]: tuple(r)[1:] for r in checked.collect()}
    assert got == {1: (False, 2, 1, 2, ""), 2: (False, 0, 0, 0, None)}


def test_rows_of_one_file_are_spread_over_more_tasks_than_cores(spark, tmp_dir):
    spark.range(1000).repartition(1).write.parquet(f"{tmp_dir}/one")
    one = spark.read.parquet(f"{tmp_dir}/one")
    cores = spark.sparkContext.defaultParallelism
    assert spread(one, "id").rdd.getNumPartitions() == 4 * cores and spread(one, "id").count() == 1000
    spark.range(100).repartition(cores).write.parquet(f"{tmp_dir}/many")
    many = spark.read.parquet(f"{tmp_dir}/many")
    assert spread(many, "id") is many


def test_verdicts_of_every_kind(spark):
    texts = ['a {"chosen_index":1,"rejected_index":-2,"reason":"r\\n\\u00e9"} b', '{"chosen_index":1,"rejected_index":0,"reason":{"b":1.50,"a":[]}}',
             '{"chosen_index":1.0,"rejected_index":0,"reason":"r"}', '{"chosen_index":true,"rejected_index":0,"reason":"r"}',
             '{"chosen_index":2147483648,"rejected_index":0,"reason":"r"}', '{"chosen_index":1,"rejected_index":0,"reason":null}',
             '{"chosen_index":1,"rejected_index":0}', "}{", None, '{"chosen_index":1,"chosen_index":3,"rejected_index":0,"reason":""}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, output_text string")
    good, bad = PR.parse_verdicts(df, "quarantine")
    assert "variant" not in _plan(good).lower()
    assert sorted(map(tuple, good.collect())) == [(0, 1, -2, "r\né"), (1, 1, 0, '{"a":[],"b":1.5}'), (5, 1, 0, "null"), (9, 3, 0, "")]
    assert sorted(r["id"] for r in bad.collect()) == [2, 3, 4, 6, 7, 8]


def test_indenting_moves_no_row(spark):
    texts = ['{"a": [1,{"b":[ ]}], "c":"x\\"{,é"}', "[]", ' {} ', '"s"', "1.50", None, " "]
    pretty = pretty_json(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "id", "t")
    assert "Exchange" not in _plan(pretty) and _plan(pretty).count("ArrowEvalPython") == 1
    got = {r["id"]: r["text"] for r in pretty.collect()}
    assert got == {i: "1.50" if t == "1.50" else json.dumps(json.loads(t), indent=2, ensure_ascii=False) for i, t in enumerate(texts[:5])}


def test_generators_see_batches_across_rows(spark):
    class Sized:
        def __call__(self, batch):
            assert list(batch.index) == list(range(len(batch))) and list(batch.columns) == ["text", "schema_hint", "candidate_index", "seed"]
            return [f"{len(batch)}:{t}:{c}" for t, c in zip(batch["text"], batch["candidate_index"])]
    df = spark.createDataFrame([(i, f"t{i}", "h") for i in range(10)], "id int, input_text string, schema_hint string").coalesce(1)
    got = {(r["id"], r["candidate_index"]): r["text"] for r in EX.sample_candidates(df, Sized, k=3, batch_rows=8).collect()}
    assert got == {(i, j): f"{8 if 3 * i + j < 24 else 6}:t{i}:{j}" for i in range(10) for j in range(3)}


def test_escaped_marks_make_no_rows_of_their_own():
    chunks = ['{', "k", ': [', 'a\\', 'b\\\\\\', "c\\\\", "]}"]
    batch = pa.RecordBatch.from_pydict({"value": chunks, "file": ["f"] * 7, "block": pa.array([0] * 7, pa.int64())})
    rows = [r for b in bigmap._pieces(iter([batch])) for r in b.to_pylist()]
    assert [r["value"] for r in rows] == ['{', "k", ': [', 'a\\"b\\\\\\"c\\\\', "]}"] and [r["n"] for r in rows] == list(range(5))


@pytest.mark.parametrize("bytes_a_split", ["40", "64", "1000"])
def test_strings_across_splits(spark, tmp_dir, bytes_a_split):
    body = {f"k\\{i}\"": [json.dumps({"a": "\"" * (i % 5), "b": "\\" * i}), "", "é" * i, "x: [" * (i % 7)][:i % 5] for i in range(40)}
    for name, text in (("one", json.dumps(body)), ("lines", json.dumps(body, indent=1, ensure_ascii=False))):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text)
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_a_split)
        try:
            rows = sorted(map(tuple, read_candidates_map(spark, f"{tmp_dir}/{name}.json").collect()))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert rows == sorted((k, j, t) for k, v in body.items() for j, t in enumerate(v))


def test_scores_need_no_list_of_leaves(monkeypatch):
    monkeypatch.setattr(R, "leaves", lambda v: pytest.fail("listed"))
    target = '{"a": 1, "b": [true, {"c": -0.0}], "d": {}}'
    raws = [target, '{"b": [1, {"c": 0.0}], "a": 1.0, "d": {}}', 'so {"b": [true], "a": 1, "x": "y"}', "[1]", "no", None]
    got = R._scored(None, pa.array(raws), pa.array([target] * len(raws))).to_pylist()
    assert [(r["n_pred"], r["n_target"], r["n_common"], r["exact_match"]) for r in got] == [
        (3, 3, 3, True), (3, 3, 0, False), (3, 3, 2, False), (1, 3, 0, False), (0, 3, 0, False), (0, 3, 0, False)]


def test_paths_that_fall_together_are_still_one():
    same = ['{"a.b": 2, "a": {"b": 1}}', '{"": {"a": 1}, "a": 1}', '{"k": "\\ud800"}']
    other = ['{"a": {"b": 1}}', '{"a": 1}', '{"k": "?"}']
    got = R._scored(None, pa.array(same), pa.array(other)).to_pylist()
    assert [(r["n_pred"], r["n_common"], r["exact_match"]) for r in got] == [(1, 1, False), (1, 1, False), (1, 1, True)]


def test_texts_of_an_order_are_made_before_its_candidates(spark, tmp_dir):
    rows = {"orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string",
                       [(3, 1, 'O"', 1.25, None, None), (4, None, "P", None, None, "1")]),
            "customer": ("c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string", [(1, "N", 0, 2.0, None)]),
            "nation": ("n_nationkey long, n_name string", [(0, "A")])}
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    made = order_candidates(order_source(spark, tmp_dir), keep=("target_text",))
    above, below = _plan(made).split("Generate", 1)
    assert "json" not in above.lower() and "json" in below.lower()
    got = {(r["id"], r["candidate_index"]): r["text"] for r in made.collect()}
    record = ('"order_id": 3, "customer": "N", "order_date": null, "priority": null, "total_cents": %s, "tags": ["O\\"", null], '
              '"parties": [{"name": "N", "nation": "A"}], "amounts": {"total_cents": 125, "balance_cents": 200}%s')
    assert got["order-3", 1] == '{"record": {' + record % (125, ', "note": "rush"') + '}, "can_extract": true, "refusal_reason": null}'
    assert got["order-4", 1].startswith('{"record": {"order_id": 4, "customer": null') and len(got) == 8


def test_no_minimizers_are_shuffled_while_texts_move(spark, monkeypatch):
    plans, segments = [], substrings.segments
    monkeypatch.setattr(substrings, "segments", lambda docs: plans.append(_plan(docs)) or segments(docs))
    passage = "a passage of well over fifty bytes that stands in both of the texts"
    docs = spark.createDataFrame([(1, "x " + passage), (2, passage + " and more"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], bytes(r["kept"])) for r in substrings.substring_dedup(docs).collect()}
    assert got == {1: (0, ("x " + passage).encode()), 2: (len(passage), b" and more"), 3: (0, b"")}
    assert len(plans) == 1 and "MapInArrow" not in plans[0]


def test_score_long_sorts_no_leaves_where_they_are_read(spark, monkeypatch):
    rows = [(f"i{k % 40}", json.dumps({"a": k % 7, "b.c": [k % 3], "b": {"c[0]": k % 2}}), json.dumps({"a": k % 5, "b": {"c": [0]}})) for k in range(60)]
    df = spark.createDataFrame([*rows, ("i1", "no", None), (None, "{}", "{}")], "id string, r string, t string")
    scored = score_documents_long(df, "id", "r", "t")
    before_any_move = _plan(scored).split("Generate inline")[0].rsplit("Exchange", 1)[1]
    assert "HashAggregate" in before_any_move and "Sort" not in before_any_move
    got = sorted(map(tuple, scored.collect()))
    monkeypatch.setattr(score_long_module, "AGAIN_IDS", 3)
    assert sorted(map(tuple, score_documents_long(df, "id", "r", "t").collect())) == got and len(got) == 40
