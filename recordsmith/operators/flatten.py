"""C3 as a table operator: one row per ``(id, path, literal)`` leaf."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import rowjson as R
from recordsmith.functions import scoring as S


def flatten_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Leaves of a VARIANT column, or of a text column of raw outputs, as a long table.

    Row-local: the leaves are built inside each row, deduplicated per path
    (smallest literal on a path collision) and exploded, so no shuffle is
    needed. An unparsable (NULL) or empty document yields no rows, like the
    empty dict of the reference.
    """
    if dict(df.dtypes)[json_col] == "string":
        items = df.select(F.col(id_col), R.leaf_list(json_col, unique=True).alias("_i"))
    else:
        leaves = df.select(F.col(id_col), J.flatten_leaves(json_col).alias("_l"))
        items = leaves.select(F.col(id_col), S.item_set(F.col("_l")).alias("_i"))
    # ``inline_outer`` + a filter on the generated column: a plain ``inline``
    # makes the optimizer infer ``size(_i) > 0`` and push that predicate below
    # the projection, recomputing the whole parse/flatten chain inside it.
    return (items.select(F.col(id_col), F.inline_outer("_i"))
            .where(F.col("path").isNotNull()))
