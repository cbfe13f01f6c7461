"""Long-form scoring, nested conformance, number kinds, ASCII and indented JSON, splits, side outputs."""

import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import scoring as S
from recordsmith.operators import pairs as PR
from recordsmith.operators import split as SP
from recordsmith.operators import synth as SY
from recordsmith.operators.conform import MEDICAL_SCHEMA, nested_conformance, schema_faults, schema_rows
from recordsmith.operators.pretty import pretty_json
from recordsmith.operators.score_long import leaf_table, score_documents_long, score_long


def _value(r, depth):
    kind = r.random()
    if depth and kind < 0.3:
        return {r.choice("abcdé"): _value(r, depth - 1) for _ in range(r.randint(0, 4))}
    if depth and kind < 0.5:
        return [_value(r, depth - 1) for _ in range(r.randint(0, 4))]
    return r.choice([None, True, False, 0, 1, -7, 2 ** 70, 1.0, 1e-9, 1e22, 0.5, "x", "日本", ""])


# ------------------------------------------------------------- scoring


def test_score_long_equals_the_row_form(spark):
    r = random.Random(3)
    rows = []
    for k in range(150):
        target = _value(r, 3)
        pred = json.dumps(target if r.random() < 0.3 else _value(r, 3))
        rows.append((k, pred if r.random() < 0.9 else pred[:-1] + "!", json.dumps(target if target is not None else {})))
    df = spark.createDataFrame(rows, "id long, raw string, target string")
    got = {x.id: (x.field_f1, x.n_pred, x.n_target) for x in score_documents_long(df, "id", "raw", "target").collect()}
    parsed = df.select("id", J.extract_json_block("raw").alias("p"), J.parse_target("target").alias("t"))
    want = parsed.select("id", S.field_f1(F.col("p"), F.col("t")).alias("f"),
                         F.size(S.item_set(F.coalesce(J.flatten_leaves("p"), F.array()))).alias("np"),
                         F.size(S.item_set(F.coalesce(J.flatten_leaves("t"), F.array()))).alias("nt")).collect()
    assert got == {x.id: (x.f, x.np, x.nt) for x in want}


def test_score_long_of_one_large_document(spark):
    n = 200_000
    leaves = spark.range(n).select(F.lit("big").alias("id"), F.format_string("a[%d].b", "id").alias("path"), F.col("id").cast("string").alias("literal"))
    other = leaves.withColumn("literal", F.when(F.col("literal").cast("long") % 4 == 0, "x").otherwise(F.col("literal")))
    ids = spark.createDataFrame([("big", True), ("bad", False), ("none", True), (None, True)], "id string, json_valid boolean")
    stray = spark.createDataFrame([("stray", "p", "1"), (None, "p", "1")], "id string, path string, literal string")
    got = {x.id: x for x in score_long(ids, leaves.unionByName(stray), other).collect()}
    assert set(got) == {"big", "bad", "none"}
    assert got["big"].n_common == n * 3 // 4 and got["big"].field_f1 == pytest.approx(0.75)
    assert got["bad"].field_f1 == 0.0 and got["none"].field_f1 == 1.0


def test_score_long_spreads_one_document_over_tasks(spark):
    leaves = spark.range(4000).select(F.lit(1).alias("id"), F.col("id").cast("string").alias("path"), F.lit("1").alias("literal"))
    ids = spark.createDataFrame([(1, True)], "id int, json_valid boolean")
    plan = score_long(ids, leaves, leaves)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" in plan and "path" in plan.split("hashpartitioning(id")[-1][:20]
    assert "Join" not in plan


def test_leaf_table_keeps_repeated_paths(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":1},"a.b":2}'), (2, "{}"), (3, None)], "id int, t string")
    rows = leaf_table(df.select("id", J.strict_parse("t").alias("v")), "id", "v").collect()
    assert sorted((x.id, x.path, x.literal) for x in rows) == [(1, "a.b", "1"), (1, "a.b", "2")]


# ------------------------------------------------------------- schema


RECORD = {"patient_name": "A", "age": 3, "sex": "f", "encounter_date": "d", "chief_complaint": "c", "diagnoses": ["x"],
          "medications": [{"name": "m", "dose": "d"}], "allergies": [], "follow_up_days": 7,
          "vitals": {"blood_pressure": "1/2", "heart_rate": 60, "temperature_f": 98.6}}


def _with(path, value):
    doc = json.loads(json.dumps({"can_extract": True, "refusal_reason": None, "record": RECORD}))
    at = doc
    for step in path[:-1]:
        at = at[step]
    if value is KeyError:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return json.dumps(doc)


def test_one_fault_on_every_level(spark):
    cases = {
        "whole": (_with(["can_extract"], True), None),
        "refusal": ('{"can_extract": false, "refusal_reason": "r", "record": null}', None),
        "integral float": (_with(["record", "vitals", "temperature_f"], 99), None),
        "top kind": (_with(["can_extract"], 1), ("kind", "can_extract")),
        "top missing": (_with(["record"], KeyError), ("missing", "")),
        "top unknown": (_with(["note"], "x"), ("unknown", "note")),
        "not an object": ("[1]", ("kind", "")),
        "record missing": (_with(["record", "age"], KeyError), ("missing", "record")),
        "record kind": (_with(["record", "age"], 3.0), ("kind", "record.age")),
        "record null": (_with(["record", "sex"], None), ("kind", "record.sex")),
        "huge integer": (_with(["record", "age"], 10 ** 30), None),
        "item kind": (_with(["record", "diagnoses"], ["a", 4]), ("kind", "record.diagnoses[1]")),
        "member of item": (_with(["record", "medications"], [{"name": "m", "dose": "d"}, {"name": "m"}]), ("missing", "record.medications[1]")),
        "kind in item": (_with(["record", "medications", 0, "dose"], 5), ("kind", "record.medications[0].dose")),
        "vitals unknown": (_with(["record", "vitals", "pulse"], 1), ("unknown", "record.vitals.pulse")),
        "vitals missing": (_with(["record", "vitals", "heart_rate"], KeyError), ("missing", "record.vitals")),
        "list for object": (_with(["record", "vitals"], []), ("kind", "record.vitals")),
    }
    rows = [(k, t) for k, (t, _) in cases.items()] + [("invalid", "{"), (None, "{}")]
    df = spark.createDataFrame(rows, "id string, t string").select("id", J.strict_parse("t").alias("v"))
    got = {x.id: x for x in nested_conformance(df, "id", "v", MEDICAL_SCHEMA).collect()}
    faults = schema_faults(df, "id", "v", MEDICAL_SCHEMA).collect()
    assert set(got) == {k for k, _ in rows if k} and not got["invalid"].schema_ok and got["invalid"].first_fault is None
    for name, (_, fault) in cases.items():
        assert got[name].schema_ok == (fault is None), name
        found = [(x.fault, x.path) for x in faults if x.id == name]
        if fault and name not in ("top missing", "not an object", "list for object"):
            assert found == [fault], name
        elif fault:
            assert fault in found, name
    assert nested_conformance(df.limit(0), "id", "v", MEDICAL_SCHEMA).count() == 0


def test_schema_rows_name_every_place():
    rows = {r[0]: r for r in schema_rows(MEDICAL_SCHEMA)}
    assert len(rows) == 22 and rows["record.medications[].dose"][2] == ["string"]
    assert rows["record"][2] == ["object", "null"] and rows["record"][3] == 10 and rows[""][3] == 3


# ------------------------------------------------------------- numbers


def _canonical(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", J.strict_parse("t").alias("v"))
    out = df.select("i", J.canonical_json("v").alias("c")).select("i", J.ascii_escape("c").alias("c")).collect()
    return [c for _, c in sorted((x.i, x.c) for x in out)]


def test_number_goldens(spark):
    goldens = {"9223372036854775808": "9223372036854775808", "1" + "0" * 30: "1" + "0" * 30, "1E5": "100000.0", "-0.0": "-0.0",
               "-0": "0", "1e-07": "1e-07", "1e22": "1e+22", "0.00001": "1e-05", "0.0001": "0.0001", "1e16": "1e+16",
               "123456789012345680.0": "1.2345678901234568e+17", "5e-324": "5e-324", "3.141592653589793238": "3.141592653589793",
               "01": None, "1.": None, "-": None, "1e": None}
    assert _canonical(spark, [f'{{"n":{k}}}' for k in goldens]) == [v and f'{{"n":{v}}}' for v in goldens.values()]


def test_numbers_equal_python(spark):
    r = random.Random(2)
    numbers = [repr(x) for x in (struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0] for _ in range(300)) if x - x == 0]
    numbers += [f"{r.randint(-9, 9)}{'.%d' % r.randint(0, 10 ** 14) if r.random() < .5 else ''}{r.choice('eE')}{r.choice(['', '+', '-'])}{r.randint(0, 30)}" for _ in range(200)]
    numbers += [str(r.randint(-10 ** 40, 10 ** 40)) for _ in range(50)]
    texts = ['{"s":"1e5 \\\\u0001 \\u0001n7 -0.0 \\"9e9\\"","n":[%s]}' % n for n in numbers]
    texts += ['{"\\u0001k":1e3,"\\u0001\\u0001":"\\u0001"}', '"\\u0001n5"', "[1e400,-1e400]"]
    want = [json.dumps(json.loads(t), sort_keys=True, separators=(",", ":")) for t in texts]
    assert _canonical(spark, texts) == want


def test_marked_numbers_are_numbers(spark):
    row = spark.createDataFrame([('{"can_extract":1e0,"big":%d,"x":1e-9,"s":"\\u0001n5"}' % 2 ** 80,)], "t string").select(
        J.strict_parse("t").alias("v")).select(
        S.refusal_correct("v", "v").alias("same"), S.refusal_correct(F.col("v"), F.parse_json(F.lit('{"can_extract":true}'))).alias("one"),
        J.kind(J.get_field(F.col("v"), "big")).alias("big"), J.kind(J.get_field(F.col("v"), "s")).alias("s"),
        J.flatten_leaves("v").alias("l")).first()
    assert row.same and row.one and row.big == "number" and row.s == "string"
    assert {x.path: x.literal for x in row.l} == {"can_extract": "1.0", "big": str(2 ** 80), "x": "1e-09", "s": '"\\u0001n5"'}


# ------------------------------------------------------------- text forms


def test_ascii_escape_equals_python(spark):
    r = random.Random(7)
    texts = ["".join(chr(r.choice([*range(0, 0x100), 0x20AC, 0x1F600, 0x10FFFF, 0x2028, 0xFFFD, 92, 92, 34])) for _ in range(r.randint(0, 40)))
             for _ in range(300)] + ["", "plain", "\\u001F \\\\u001F"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", F.to_json(F.array("t")).alias("j")).select("i", J.ascii_escape("j").alias("a")).collect()
    assert {x.i: x.a[1:-1] for x in got} == {i: json.dumps(t) for i, t in enumerate(texts)}


def test_pretty_equals_python(spark):
    r = random.Random(8)
    values = [_value(r, 4) for _ in range(60)] + [{}, [], [[]], {"a": {}}, "a,b:{}[]", {"k ,": "v \" \\ }"}]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(999, None)], "id int, t string")
    got = {x.id: x.text for x in pretty_json(df, "id", "t").collect()}
    assert got == {i: json.dumps(v, indent=2) for i, v in enumerate(values)}


# ------------------------------------------------------------- splits and corpora


@pytest.mark.parametrize("n,bucket", [(1, 10), (7, 2), (500, 40), (500, 10 ** 6)])
def test_boundary_split_equals_the_rank(spark, n, bucket):
    df = spark.range(n).select("id", SY.shuffle_key(1, "id").alias("shuffle_key"))
    want = {x.id: x.split for x in SP.exact_split(df).collect()}
    got = SP.boundary_split(df, "shuffle_key", "id", rows_per_bucket=bucket)
    assert {x.id: x.split for x in got.collect()} == want


def test_boundary_split_of_odd_tables(spark):
    df = spark.createDataFrame([(None,)] * 5 + [(1,)] * 20 + [(2,)] * 5, "id long").withColumn("h", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    got = SP.boundary_split(df, "h", "id").groupBy("id").agg(F.countDistinct("split").alias("k"), F.count("*").alias("n")).collect()
    assert sum(x.n for x in got) == 30 and all(x.k == 1 for x in got)
    assert SP.boundary_split(df.limit(0), "h", "id").count() == 0


def test_corpus_is_indexed_by_the_tables_keys(spark):
    keys = spark.createDataFrame([(k * 3 + 5,) for k in range(100)], "idx long")
    index = SY.corpus_index(keys)
    rows = SY.examples(index, keep=("idx",)).collect()
    refusals = sorted(x.idx for x in rows if not x.can_extract)
    assert len(rows) == 100 and refusals == [k * 3 + 5 for k in range(88, 100)]
    assert {x.id for x in rows if x.idx == 5} == {"medical-00005"}


# ------------------------------------------------------------- verdicts


def test_verdicts_go_to_two_folders_in_one_pass(spark, tmp_dir):
    texts = [("a", 'ok {"chosen_index":1,"rejected_index":0,"reason":"é"} done'), ("b", "none"), ("c", '{"chosen_index":"1","rejected_index":0,"reason":"r"}'),
             ("d", '{"chosen_index":1}'), ("e", "}{"), ("f", None), ("g", '{"chosen_index":0,"rejected_index":3,"reason":{"k":1e5}}')]
    df = spark.createDataFrame(texts, "id string, output_text string")
    for _ in range(2):                                       # a rerun replaces both folders
        assert PR.write_verdicts(df, tmp_dir) == {"good": 2, "bad": 5}
    good = PR.read_verdicts(spark, tmp_dir, "good")
    assert sorted((x.id, x.chosen_index, x.rejected_index, x.reason) for x in good.collect()) == [("a", 1, 0, "é"), ("g", 0, 3, '{"k":100000.0}')]
    bad = PR.read_verdicts(spark, tmp_dir, "bad")
    assert sorted(x.id for x in bad.collect()) == ["b", "c", "d", "e", "f"]
    assert "PartitionFilters: [isnotnull(state" in bad._jdf.queryExecution().executedPlan().toString()


def test_preference_pairs_move_rows_once(spark):
    from recordsmith.plans.catalog import queries
    plan = queries()["preference_pairs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and plan.count("hashpartitioning(id") == 1
