"""Indented JSON text (X17), keys in the order of the text.

``json.dumps(value, indent=n)`` row by row: the text is cut into tokens (strings, brackets,
commas, colons, other values) that are written again with line breaks (``rowjson.indented``), so
no row leaves its task. Order of keys and the literals stay those of the text, so a body that was
put together with a fixed key order keeps it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordsmith.functions import rowjson as R


def pretty_json(df: DataFrame, id_col: str, text_col: str, indent: int = 2) -> DataFrame:
    """(id, text): the JSON text of every row, indented. The text must be JSON (a null or blank
    text gives no row). Empty containers stay on one line."""
    texts = df.where(F.col(text_col).rlike(r"\S"))
    return texts.select(F.col(id_col).alias("id"), R.indent_text(text_col, indent).alias("text"))
