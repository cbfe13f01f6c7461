"""ISO text of dates at any nesting, and predictions that have no example."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from recordsmith.operators.evaluate import join_predictions
from recordsmith.operators.jsonsafe import json_safe


def test_iso_everywhere(spark):
    t = dt.datetime(2026, 2, 8, 1, 2, 3, 450)
    row = (1, t, dt.date(2026, 2, 8), [dt.date(2025, 1, 2), None], {"a": t.replace(microsecond=0)}, (dt.date(2024, 3, 4), 5))
    schema = "i int, t timestamp, d date, l array<date>, m map<string,timestamp>, s struct<d: date, n: int>"
    out = json_safe(spark.createDataFrame([row, (2, None, None, None, None, None)], schema)).orderBy("i").collect()
    assert out[0].asDict(True) == {"i": 1, "t": t.isoformat(), "d": "2026-02-08", "l": ["2025-01-02", None],
                                   "m": {"a": "2026-02-08T01:02:03"}, "s": {"d": "2024-03-04", "n": 5}}
    assert list(out[1])[1:] == [None] * 5


def test_prediction_without_example_fails(spark):
    preds = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, raw_output string")
    examples = spark.createDataFrame([("a", "t")], "id string, target_text string")
    assert join_predictions(preds.where("id = 'a'"), examples).count() == 1
    with pytest.raises(PySparkException):
        join_predictions(preds, examples).select("id").collect()
