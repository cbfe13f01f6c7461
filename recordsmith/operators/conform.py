"""Schema conformance at every level of a document.

A schema is a tree of Python values: a string names the kinds of a value (``"string"``,
``"string or null"``), a dict is an object with exactly these members, a one-element list is
an array of that item, ``Maybe(x)`` is ``x`` or null. It compiles to rows (pattern, parent
pattern, kinds), patterns being paths with ``[]`` for every index. The documents' nodes,
containers too, meet these rows by pattern: a node of no row is unknown, one of another kind
is wrong, and an object with fewer members of its pattern than the schema lists misses some.
The schema's rows are as many as it has places, whatever the documents hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import rowjson as R


@dataclass(frozen=True)
class Maybe:
    """A schema that also allows null."""
    of: object


# The schema that the extraction prompt asks for.
MEDICAL_SCHEMA = {
    "can_extract": "boolean",
    "refusal_reason": "string or null",
    "record": Maybe({
        "patient_name": "string",
        "age": "integer",
        "sex": "string",
        "encounter_date": "string",
        "chief_complaint": "string",
        "diagnoses": ["string"],
        "medications": [{"name": "string", "dose": "string"}],
        "allergies": ["string"],
        "vitals": {"blood_pressure": "string", "heart_rate": "integer", "temperature_f": "number"},
        "follow_up_days": "integer",
    }),
}


def schema_rows(schema, pattern: str = "", parent: str | None = None) -> list[tuple]:
    """(pattern, parent pattern, kinds, members): a row for every place of the schema;
    ``members`` is how many members an object of this place has."""
    nullable = isinstance(schema, Maybe)
    schema = schema.of if nullable else schema
    extra = ["null"] if nullable else []
    if isinstance(schema, dict):
        rows = [(pattern, parent, ["object", *extra], len(schema))]
        for key, of in schema.items():
            rows += schema_rows(of, f"{pattern}.{key}" if pattern else key, pattern)
        return rows
    if isinstance(schema, list):
        return [(pattern, parent, ["array", *extra], None)] + schema_rows(schema[0], pattern + "[]", pattern)
    kinds = schema.split(" or ")
    return [(pattern, parent, [*kinds, *(["integer"] if "number" in kinds else []), *extra], None)]


def _schema_table(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame(schema_rows(schema), "pattern string, parent_pattern string, kinds array<string>, members int")


def _by_path(df: DataFrame, id_col: str, json_col: str, schema) -> DataFrame:
    """(id, path, n_unknown, n_kind, missing, parsed) of the places that matter: nodes with a
    fault, objects that must have members, and every root. ``parsed`` is set on roots alone, and
    false for a document that did not parse. The documents are taken apart once: a node counts
    at its own path and, as a member, at its parent's."""
    if dict(df.dtypes)[json_col] == "string":
        rules: dict[str, list] = {}
        for pattern, _, kinds, members in schema_rows(schema):
            rules.setdefault(pattern, []).append((kinds, members))
        places = df.select(F.col(id_col).alias("id"), F.inline_outer(R.place_list(json_col, rules)))
    else:
        places = _places(df.select(F.col(id_col).alias("id"), J.flatten_nodes(json_col).alias("_n")), schema)
    found = places.groupBy("id", "path").agg(*[F.sum(c).alias(c) for c in ("n_unknown", "n_kind", "want", "has")], F.max("parsed").alias("parsed"))
    return found.select("id", "path", "n_unknown", "n_kind", ((F.col("want") > 0) & (F.col("has") < F.col("want"))).alias("missing"), "parsed")


def _places(documents: DataFrame, schema) -> DataFrame:
    """``rowjson.places`` of documents given as lists of nodes, several rows a path."""
    nodes = documents.select("id", F.inline_outer("_n"))
    rules = F.broadcast(_schema_table(documents.sparkSession, schema))      # a row a place of the schema
    held = nodes.join(rules, "pattern", "left")
    known = F.col("kinds").isNotNull()
    unknown, wrong = F.col("path").isNotNull() & ~known, known & ~F.array_contains("kinds", F.col("kind"))
    want = F.when((F.col("kind") == "object") & F.col("members").isNotNull(), F.col("members")).otherwise(0)
    root = F.when(F.col("parent").isNull(), F.col("path").isNotNull())
    def row(path, n_unknown, n_kind, want, has, parsed):
        return F.struct(path.alias("path"), n_unknown.cast("int").alias("n_unknown"), n_kind.cast("int").alias("n_kind"),
                        want.alias("want"), has.alias("has"), parsed.alias("parsed"))
    no = F.lit(0)
    own = F.when(unknown | wrong | (want > 0) | root.isNotNull(), row(F.col("path"), unknown, F.coalesce(wrong, F.lit(False)), want, no, root))
    member = F.when(F.col("parent").isNotNull() & known & ~F.endswith("pattern", F.lit("[]")),
                    row(F.col("parent"), no, no, no, F.lit(1), F.lit(None).cast("boolean")))
    return held.select("id", F.explode(F.array(own, member)).alias("p")).where(F.col("p").isNotNull()).select("id", "p.*")


def schema_faults(df: DataFrame, id_col: str, json_col: str, schema) -> DataFrame:
    """(id, fault, path) of every fault: ``unknown`` (no such place), ``kind`` (another kind),
    ``missing`` (an object lacks members; the path is the object's). ``json_col`` is VARIANT or
    a text column of raw outputs."""
    kinds = F.concat(F.array_repeat(F.lit("unknown"), F.col("n_unknown").cast("int")), F.array_repeat(F.lit("kind"), F.col("n_kind").cast("int")),
                     F.array_repeat(F.lit("missing"), F.col("missing").cast("int")))
    return _by_path(df, id_col, json_col, schema).select("id", F.explode(kinds).alias("fault"), "path")


def nested_conformance(df: DataFrame, id_col: str, json_col: str, schema) -> DataFrame:
    """(id, schema_ok, n_unknown, n_kind, n_missing, first_fault) of every row with an id.

    A document that did not parse (null) does not conform and has no faults; ``first_fault``
    is the smallest path with a fault. Rows that share an id are one document.
    """
    faulty = F.col("missing") | (F.col("n_unknown") + F.col("n_kind") > 0)
    counts = _by_path(df.where(F.col(id_col).isNotNull()), id_col, json_col, schema).groupBy("id").agg(
        F.max("parsed").alias("parsed"), F.sum("n_unknown").alias("n_unknown"), F.sum("n_kind").alias("n_kind"),
        F.count(F.when(F.col("missing"), 1)).alias("n_missing"), F.min(F.when(faulty, F.col("path"))).alias("first_fault"))
    ok = F.col("parsed") & (F.col("n_unknown") + F.col("n_kind") + F.col("n_missing") == 0)
    return counts.select("id", ok.alias("schema_ok"), "n_unknown", "n_kind", "n_missing", "first_fault")
