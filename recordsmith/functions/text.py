"""Scalar text helpers with Python string semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_string(col: Column) -> Column:
    """A string value as a JSON string literal, escaped by Spark's JSON writer."""
    wrapped = F.to_json(F.array(col))
    return wrapped.substr(F.lit(2), F.length(wrapped) - 2)
