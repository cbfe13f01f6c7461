"""Registered queries against their DuckDB oracle SQL on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from recordsmith.plans.catalog import queries
from recordsmith.plans.oracles import oracle_sql
from recordsmith.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
NAMES = sorted(queries())


def _norm(row):
    return tuple(("f", round(v, 9)) if isinstance(v, float) and not math.isnan(v) else ("v", v) for v in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    res = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(cols)
    order = [cols.index(c) for c in sdf.columns]
    duck_rows = sorted((_norm(tuple(r[i] for i in order)) for r in res.fetchall()), key=repr)
    spark_rows = sorted((_norm(tuple(r)) for r in sdf.collect()), key=repr)
    assert spark_rows == duck_rows


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["samples", "json_validity_rate", "exact_match_accuracy", "field_level_f1",
                          "refusal_correctness"]
    assert df.count() == 1
