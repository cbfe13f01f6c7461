"""Goldens for parsing, canonical form, flatten and scoring (FIXTURES §3)."""

import pytest
from pyspark.sql import functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import scoring as S

FENCE = "```json\n{\"a\":1}\n```"
PARSE = [
    ('{"a":1}', '{"a":1}'),
    ('Sure: {"a":1} done', '{"a":1}'),
    (FENCE, '{"a":1}'),
    ('{"a":1} and {"b":2}', None),
    ('{"a":1}x', '{"a":1}'),
    ("1 2", None), ('{"a":1,}', None), ("{'a':1}", None), ("", None), ("   ", None), ("no json", None),
    ("null", None),
    ("[1]", "[1]"),
    ('[{"a":1}] x', '{"a":1}'),
    ('{"a":1,"a":2}', '{"a":2}'),
    ('{"b": 1, "B": 2, "a": null}', '{"B":2,"a":null,"b":1}'),
    ('{"x": 54.0, "y": 98.60, "z": 1e2}', '{"x":54.0,"y":98.6,"z":100.0}'),
]


def test_extract_and_canonical(spark):
    df = spark.createDataFrame([(r,) for r, _ in PARSE], "raw string")
    out = df.select("raw", J.canonical_json(J.extract_json_block("raw")).alias("c")).collect()
    got = {r.raw: r.c for r in out}
    for raw, want in PARSE:
        assert got[raw] == want, raw


def test_column_and_sql_forms_agree(spark):
    df = spark.createDataFrame([(r,) for r, _ in PARSE], "raw string")
    a = df.select("raw", J.canonical_json(J.extract_json_block(F.col("raw"))).alias("c"))
    b = df.select("raw", J.canonical_json(J.extract_json_block("raw")).alias("c"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_strict_parse_rejects_trailing_text(spark):
    df = spark.createDataFrame([('{"a":1}x',), ('{"a":1}',)], "t string")
    got = [r.v for r in df.select(J.strict_parse("t").isNotNull().alias("v")).collect()]
    assert got == [False, True]


def test_flatten_golden(spark):
    df = spark.createDataFrame([('{"a":[1,{"b":2.0}],"c":null,"e":{},"z":[]}',)], "t string")
    leaves = df.select(J.flatten_leaves(F.parse_json("t")).alias("l")).first().l
    assert sorted((x.path, x.literal) for x in leaves) == [("a[0]", "1"), ("a[1].b", "2.0"), ("c", "null")]


def test_flatten_scalar_root_and_null(spark):
    df = spark.createDataFrame([('"x"',), (None,)], "t string")
    rows = df.select(J.flatten_leaves(J.strict_parse("t")).alias("l")).collect()
    assert [(x.path, x.literal) for x in rows[0].l] == [("", '"x"')]
    assert rows[1].l is None


REFUSAL_TARGET = '{"can_extract": false, "refusal_reason": "No extractable medical facts present.", "record": null}'
F1 = [
    (None, '{"a":1}', 0.0),
    ("{}", '{"a":1}', 0.0),
    ("{}", "{}", 1.0),
    ('{"a":1,"b":2}', '{"a":1,"b":3}', 0.5),
    ('{"can_extract":false,"refusal_reason":null,"record":null}', REFUSAL_TARGET, 2 / 3),
    ('{"a":[1,2]}', '{"a":[2,1]}', 0.0),
    ('{"a":54.0}', '{"a":54}', 0.0),
    ('{"a":1}', '{"a":1,"b":2}', 2 / 3),
]


def test_field_f1_golden(spark):
    df = spark.createDataFrame([(p, t) for p, t, _ in F1], "p string, t string")
    got = df.select(S.field_f1(J.strict_parse(F.col("p")), F.parse_json("t")).alias("f")).collect()
    for (p, t, want), row in zip(F1, got):
        assert row.f == pytest.approx(want), (p, t)


def test_refusal_correct_golden(spark):
    preds = ['{"can_extract": true}', '{"can_extract": 1}', '{"can_extract": "true"}', '{"can_extract": 2}',
             '{"other": 1}', '{"can_extract": null}', "not json", "[1]"]
    want = [True, True, False, False, False, False, False, False]
    df = spark.createDataFrame([(p,) for p in preds], "p string")
    got = df.select(S.refusal_correct(J.extract_json_block("p"),
                                      F.parse_json(F.lit('{"can_extract": true}'))).alias("r")).collect()
    assert [r.r for r in got] == want


def test_confidence_golden(spark):
    fields = ["a", "b", "c", "d", "e", "f", "g", "h", "i", "j"]
    rows = [("not json", 0.0), ('{"can_extract": false, "record": {"a": 1}}', 0.92)]
    expected = [0.45, 0.51, 0.56, 0.62, 0.67, 0.73, 0.78, 0.84, 0.89, 0.95, 0.99]
    for k in range(11):
        rec = ", ".join(f'"{f}": 1' for f in fields[:k])
        rows.append(('{"can_extract": true, "record": {' + rec + "}}", expected[k]))
    rows.append(('{"record": {"a": 0, "b": false, "c": null, "d": "", "e": [], "f": {}}}', 0.56))
    rows.append(('{"can_extract": 0, "record": null}', 0.45))
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = [r.c for r in df.select(S.confidence(J.extract_json_block("t")).alias("c")).collect()]
    assert got == [w for _, w in rows]


def test_exact_match_number_kind(spark):
    from recordsmith.operators.evaluate import score_predictions
    df = spark.createDataFrame([("1", '{"a": 54.0}', '{"a": 54}'), ("2", '{"b": 1, "a": 54}', '{"a": 54, "b": 1}')],
                               "id string, raw_output string, target_text string")
    got = {r.id: r.exact_match for r in score_predictions(df).collect()}
    assert got == {"1": False, "2": True}


def test_schema_conformance(spark):
    fields = {"n": "integer", "s": "string"}
    rows = [('{"can_extract": true, "refusal_reason": null, "record": {"n": 1, "s": "x"}}', True),
            ('{"can_extract": true, "refusal_reason": null, "record": {"n": 1.5, "s": "x"}}', False),
            ('{"can_extract": false, "refusal_reason": "no", "record": null}', True),
            ('{"can_extract": false, "record": null}', False),
            ('{"can_extract": true, "refusal_reason": null, "record": {"n": 1, "s": "x", "t": 2}}', False)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = [r.ok for r in df.select(S.schema_conformance(F.parse_json("t"), fields).alias("ok")).collect()]
    assert got == [w for _, w in rows]
