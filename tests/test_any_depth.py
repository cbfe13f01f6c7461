"""JSON values at any depth, texts that hold old markers, and the checks that must not be lost."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import scoring as S
from recordsmith.operators import pairs as PR
from recordsmith.operators import scan
from recordsmith.operators import split as SP


def _nest(depth, leaf):
    value = leaf
    for k in range(depth):
        value = {f"k{k % 3}": value, "a": k} if k % 2 else [value, {"e": {}, "f": []}]
    return value


def _leaves(value, path=""):
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in _leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list):
        return [x for k, v in enumerate(value) for x in _leaves(v, f"{path}[{k}]")]
    return [(path, json.dumps(value))]


VALUES = [_nest(d, x) for d in (0, 1, 2, 7, 10, 40) for x in (54, 54.0, "é{[", None, True)] + [[], {}, "x"]


def test_flatten_and_canonical(spark):
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(VALUES)], "id int, t string")
    df = df.select("id", J.strict_parse("t").alias("v"))
    out = df.select("id", J.canonical_json("v").alias("c"), J.flatten_leaves("v").alias("l"),
                    J.canonical_json(F.col("v")).alias("c2")).collect()
    for r in out:
        v = VALUES[r["id"]]
        if v is None:
            assert r["c"] is None and r["l"] is None
            continue
        assert r["c"] == json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["c2"]
        assert sorted((x["path"], x["literal"].replace("é", "\\u00e9")) for x in r["l"]) == sorted(_leaves(v))


def test_deep_scores(spark):
    target = _nest(7, 54)
    df = spark.createDataFrame([(json.dumps(_nest(7, 54.0)), json.dumps(target))], "p string, t string")
    p, t = (J.strict_parse(c).alias(c) for c in ("p", "t"))
    row = df.select(p, t).select(S.field_f1(F.col("p"), F.col("t")).alias("f1"),
                                 S.exact_match(F.col("p"), F.col("t")).alias("exact")).first()
    n = len(_leaves(target))
    assert not row["exact"] and row["f1"] == pytest.approx((n - 1) / n)


def test_marker_texts_parse(spark):
    texts = ['{"a":"#e7b1#"}', '["#e7b1#"]', "1 2", '{"a":1}x', '{"a":1}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.to_json(J.strict_parse("t"))).collect()]
    assert got == [texts[0], texts[1], None, None, texts[4]]


def test_running_minimum_of_a_null_run(spark):
    rows = [(None, s, float(100 - s)) for s in range(20)] + [("r", s, float(s)) for s in range(5)] + [("r", None, 7.0)]
    df = spark.createDataFrame(rows, "run string, step long, m double")
    out = {(r["run"], r["step"]): r["running_best"] for r in scan.running_min(df, "run", "step", "m", rows_per_chunk=5).collect()}
    assert [out[None, s] for s in range(20)] == [float(100 - s) for s in range(20)]
    assert out["r", None] == 7.0 and out["r", 4] == 0.0


def test_rank_with_outlier_nulls_and_ties(spark):
    keys = [10 ** 12, None, None] + [k // 3 for k in range(997)]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key long")
    ranked, n = SP.rank_by_key(df, "key", ["id"], rows_per_bucket=50)
    got = [r["id"] for r in ranked.orderBy("rank").collect()]
    want = sorted(range(1000), key=lambda i: (keys[i] is not None, keys[i] or 0, i))
    assert n == 1000 and got == want


def test_missing_or_bad_verdicts_fail_even_when_pruned(spark):
    rows = spark.createDataFrame([("a", "t", "h", ["x", "y"]), ("b", "t", "h", ["x", "y"])],
                                 "id string, input_text string, schema_hint string, candidates array<string>")
    one = spark.createDataFrame([("a", 0, 1, "r")], "id string, chosen_index int, rejected_index int, reason string")
    with pytest.raises(PySparkException):
        PR.preference_pairs(rows, one).select("id").collect()
    assert PR.preference_pairs(rows, one, strict=False).count() == 2
    bad = spark.createDataFrame([("a", '{"chosen_index": 0}')], "id string, output_text string")
    with pytest.raises(PySparkException):
        PR.parse_verdicts(bad)[0].select("id").collect()
    text = spark.createDataFrame([("a", '{"chosen_index": 0, "rejected_index": 1, "reason": ["why", 1.0]}')],
                                 "id string, output_text string")
    assert PR.parse_verdicts(text)[0].first()["reason"] == '["why",1.0]'
