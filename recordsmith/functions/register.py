"""SQL access to the column functions: ``register_functions(spark)`` creates
session-scoped SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``) whose
bodies are the same SQL text the DataFrame API uses."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from recordsmith.functions import sqltext as Q


def definitions(prefix: str = "rs_") -> dict[str, str]:
    return {
        f"{prefix}py_strip": f"(s STRING) RETURNS STRING RETURN {Q.py_strip('s')}",
        f"{prefix}strict_parse": f"(t STRING) RETURNS VARIANT RETURN {Q.strict_parse('t')}",
        f"{prefix}extract_json_block": f"(raw STRING) RETURNS VARIANT RETURN {Q.extract_json_block('raw')}",
        f"{prefix}canonical_json": f"(v VARIANT) RETURNS STRING RETURN {Q.canonical_json('v')}",
        f"{prefix}flatten_json": ("(v VARIANT) RETURNS ARRAY<STRUCT<path: STRING, literal: STRING>> RETURN "
                                  f"{Q.flatten_leaves('v')}"),
        f"{prefix}refusal_correct": f"(p VARIANT, t VARIANT) RETURNS BOOLEAN RETURN {Q.refusal_correct('p', 't')}",
        f"{prefix}ascii_escape": f"(j STRING) RETURNS STRING RETURN {Q.ascii_escape('j')}",
        f"{prefix}confidence": f"(p VARIANT) RETURNS DOUBLE RETURN {Q.confidence('p')}",
    }


def register_functions(spark: SparkSession, prefix: str = "rs_") -> list[str]:
    names = []
    for name, body in definitions(prefix).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        names.append(name)
    return names


def sql_function(name: str, *args: Column) -> Column:
    """A call of one of the functions on columns of any kind, registered in the active session
    where it is not yet."""
    spark = SparkSession.active()
    if not getattr(spark, "_rs_registered", False):
        register_functions(spark)
        spark._rs_registered = True
    return F.call_function(f"rs_{name}", *args)
