"""Row-level scoring of a parsed prediction against its target.

All of these are Column expressions over VARIANT values, so scoring a table
is a narrow projection: no explode, no shuffle, no join. The per-row item
sets of the field-level F1 are small arrays held inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recordsmith.functions import sqltext as Q

from recordsmith.functions.jsonparse import (as_array, as_object, canonical_json,
                                             flatten_leaves, get_field, is_false, kind)
from recordsmith.functions.register import sql_function

# Fixed values of the confidence heuristic.
CONF_REFUSAL = 0.92
CONF_BASE = 0.45
CONF_SPAN = 0.5
CONF_CAP = 0.99
CONF_EXPECTED_FIELDS = 9


def item_set(leaves: Column) -> Column:
    """Leaves as a path-keyed set: one literal per path (the smallest on a collision).

    Paths are unique unless a key contains ``.`` or ``[``; the sort that
    resolves a collision only runs on rows that have one.
    """
    # The sorted leaves are bound once, so that the lambda does not sort them again.
    dedup = F.element_at(F.transform(F.array(F.array_sort(leaves)), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (F.get(s, i - 1)["path"] != x["path"]))), 1)
    unique = F.size(F.array_distinct(F.transform(leaves, lambda x: x["path"]))) == F.size(leaves)
    return F.when(unique, leaves).otherwise(dedup)


def f1_from_counts(tp: Column, n_pred: Column, n_target: Column, pred_missing: Column) -> Column:
    """A5: precision/recall/F1 with the reference's zero rules, same float ops order."""
    precision = tp / n_pred
    recall = tp / n_target
    return (F.when(pred_missing, F.lit(0.0))
            .when((n_pred == 0) & (n_target == 0), F.lit(1.0))
            .when((n_pred == 0) | (n_target == 0), F.lit(0.0))
            .when(tp == 0, F.lit(0.0))
            .otherwise(F.lit(2.0) * precision * recall / (precision + recall)))


def field_f1(pred: Column, target: Column) -> Column:
    """C4: field-level F1 over flattened ``(path, literal)`` items of two VARIANTs."""
    p_items = item_set(F.coalesce(flatten_leaves(pred), F.array()))
    t_items = item_set(F.coalesce(flatten_leaves(target), F.array()))
    tp = F.size(F.array_intersect(p_items, t_items))
    return f1_from_counts(tp, F.size(p_items), F.size(t_items), pred.isNull())


def exact_match(pred: Column, target: Column) -> Column:
    """``canonical_json(pred) == canonical_json(target)`` (None == None is True)."""
    return canonical_json(pred).eqNullSafe(canonical_json(target))


def refusal_correct(pred: Column | str, target: Column | str) -> Column:
    """``pred.get('can_extract') == target.get('can_extract')`` with Python ``==``.

    A prediction that parsed to a non-object would make ``.get`` raise in the
    reference; it counts as not correct here. Column names build the
    expression from SQL text.
    """
    if isinstance(pred, str) and isinstance(target, str):
        return F.expr(Q.refusal_correct(Q.quote(pred), Q.quote(target)))
    return sql_function("refusal_correct", pred, target)


def is_populated(v: Column) -> Column:
    """``v not in (None, "", [], {})`` -- 0 and false count as populated."""
    return ~(v.isNull() | F.is_variant_null(v)
             | F.to_json(v).isin('""', "[]", "{}"))


def populated_count(record: Column) -> Column:
    """Number of populated values of an object (0 for anything that is not one)."""
    values = F.map_values(as_object(record))
    return F.coalesce(F.size(F.filter(values, is_populated)), F.lit(0))


def confidence(pred: Column) -> Column:
    """0.0 unparsable, 0.92 for an explicit refusal, else by populated record fields."""
    return confidence_of(pred.isNull(), is_false(get_field(pred, "can_extract")), populated_count(get_field(pred, "record")))


def confidence_of(missing: Column, refused: Column, populated: Column) -> Column:
    """The same from its three parts."""
    score = F.least(F.lit(CONF_CAP),
                    F.lit(CONF_BASE) + (populated / F.lit(float(CONF_EXPECTED_FIELDS))) * F.lit(CONF_SPAN))
    return (F.when(missing, F.lit(0.0))
            .when(refused, F.lit(CONF_REFUSAL))
            .otherwise(F.round(score, 2)))


def json_valid(pred: Column) -> Column:
    """the prediction parsed (``parsed is not None``)."""
    return pred.isNotNull()


def schema_conformance(v: Column | str, record_fields: dict[str, str]) -> Column:
    """Envelope and record match the expected schema exactly.

    ``record_fields`` maps each record key to its JSON kind ('string',
    'number', 'integer', 'boolean', 'array', 'object'). The envelope must be
    an object with exactly ``can_extract`` (boolean), ``refusal_reason``
    (string or null) and ``record`` (object with exactly those keys, or null).
    """
    if isinstance(v, str):
        return F.expr(Q.schema_conformance(Q.quote(v), record_fields))
    env = as_object(v)
    env_keys = F.array_sort(F.map_keys(env))
    can = get_field(v, "can_extract")
    reason = get_field(v, "refusal_reason")
    record = get_field(v, "record")
    expected_env = F.array(*[F.lit(k) for k in sorted(["can_extract", "refusal_reason", "record"])])
    rec_keys = F.array_sort(F.map_keys(as_object(record)))
    expected_rec = F.array(*[F.lit(k) for k in sorted(record_fields)])

    def kind_ok(key: str, want: str) -> Column:
        val = get_field(record, key)
        k = kind(val)
        if want == "integer":
            return (k == "number") & F.schema_of_variant(val).isin("BIGINT", "INT", "SMALLINT", "TINYINT")
        return k == want

    fields_ok = F.lit(True)
    for key, want in record_fields.items():
        fields_ok = fields_ok & kind_ok(key, want)
    record_ok = (kind(record) == "null") | ((kind(record) == "object") & (rec_keys == expected_rec) & fields_ok)
    return F.coalesce(
        env.isNotNull() & (env_keys == expected_env) & (kind(can) == "boolean")
        & kind(reason).isin("string", "null") & record_ok,
        F.lit(False))


__all__ = ["item_set", "f1_from_counts", "field_f1", "exact_match", "refusal_correct",
           "is_populated", "populated_count", "confidence", "json_valid", "schema_conformance",
           "as_array"]
