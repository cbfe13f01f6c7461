"""JSON text -> VARIANT with Python ``json`` semantics, and VARIANT -> text.

Covers C1 (extract_json_block), C2 (canonical_json), C3 (flatten, column
form), X13 (dict.get), X15 (strict parse) and X18 (ASCII escapes). Columns other
than plain names go through the SQL functions, whose bodies are the same SQL text.
Everything is a Column expression, evaluated row-locally inside the JVM:
no shuffle, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recordsmith.functions import sqltext as Q
from recordsmith.functions.register import sql_function

_MAP_T = "map<string,variant>"
_ARR_T = "array<variant>"


def strict_parse(text: Column | str) -> Column:
    """``json.loads`` semantics: the whole text must be exactly one JSON value.

    Returns VARIANT, or NULL when the text is invalid or is the JSON ``null``
    (Python turns that into ``None``). A column name builds the expression
    from SQL text in one call (see ``sqltext``).
    """
    if isinstance(text, str):
        return F.expr(Q.strict_parse(Q.quote(text)))
    return sql_function("strict_parse", text)


def extract_json_block(raw: Column | str) -> Column:
    """Strip; parse the whole text; else parse first-``{``-to-last-``}``."""
    if isinstance(raw, str):
        return F.expr(Q.extract_json_block(Q.quote(raw)))
    return sql_function("extract_json_block", raw)


def as_object(v: Column) -> Column:
    return v.try_cast(_MAP_T)


def as_array(v: Column) -> Column:
    return v.try_cast(_ARR_T)


def kind(v: Column) -> Column:
    """'object' | 'array' | 'string' | 'number' | 'boolean' | 'null' (NULL for SQL NULL)."""
    s = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(s.startswith("OBJECT"), "object")
            .when(s.startswith("ARRAY"), "array")
            .when((s == "STRING") & F.coalesce(v.try_cast("string").startswith(Q.NUMBER_MARK), F.lit(False)), "number")
            .when(s == "STRING", "string")
            .when(s == "BOOLEAN", "boolean")
            .when(s == "VOID", "null")
            .otherwise("number"))


def flatten_leaves(v: Column | str) -> Column:
    """C3 as a column: ``array<struct<path, literal>>`` of the leaves of ``v``.

    Paths are ``a.b[0].c`` and literals are ``json.dumps`` text, as the reference's
    flatten, at any depth: a fold expands the containers that are left, one level a
    round. Empty containers yield nothing; a scalar root has path ''. NULL input gives
    NULL. A column name builds the expression from SQL text in one call.
    """
    return F.expr(Q.flatten_leaves(Q.quote(v))) if isinstance(v, str) else sql_function("flatten_json", v)


def flatten_nodes(v: str) -> Column:
    """All nodes of a column's documents, see ``sqltext.flatten_nodes``."""
    return F.expr(Q.flatten_nodes(Q.quote(v)))


def canonical_json(v: Column | str) -> Column:
    """``json.dumps(v, sort_keys=True, separators=(',', ':'))``, at any depth.

    VARIANT objects already keep keys sorted; the tree is re-printed so that numbers keep
    Python's kind and form. Non-ASCII text stays UTF-8; ``ascii_escape`` gives Python's
    escapes. A column name builds the expression from SQL text in one call.
    """
    return F.expr(Q.canonical_json(Q.quote(v))) if isinstance(v, str) else sql_function("canonical_json", v)


def ascii_escape(text: Column | str) -> Column:
    """A JSON text with all but printable ASCII as ``\\uXXXX``, as ``ensure_ascii``."""
    return F.expr(Q.ascii_escape(Q.quote(text))) if isinstance(text, str) else sql_function("ascii_escape", text)


def parse_target(text: str) -> Column:
    """A target's JSON text (a column name) as VARIANT; fails on invalid text."""
    return F.expr(Q.parse_target(Q.quote(text)))


def get_field(v: Column, key: str) -> Column:
    """X13 ``obj.get(key)`` as VARIANT: NULL when ``v`` is not an object or lacks the key.

    A present JSON ``null`` comes back as a variant null (not SQL NULL), so
    missing and null stay distinguishable.
    """
    return F.try_variant_get(v, f"$['{key}']", "variant")


def is_false(v: Column) -> Column:
    """Python ``x is False``: BOOLEAN false only (``0`` is not ``False``)."""
    return F.coalesce((F.schema_of_variant(v) == "BOOLEAN") & ~v.try_cast("boolean"), F.lit(False))
