"""Order corpus: extraction targets and damaged model outputs derived from driver tables.

The driver tables hold no model outputs, so this source derives one labelled
example per ``orders`` row: a target record in the extraction envelope
(``can_extract`` / ``refusal_reason`` / ``record``) and a prediction text that
is damaged in one of ten ways chosen by ``o_orderkey % 10``. Pending orders
(status ``P``) are refusal targets. Texts use Python ``json.dumps`` default
separators; the prediction puts ``record`` first, so comparison has to be by
value, not by text. Integers only (cents), so every engine prints the same.

Plan: ``orders`` LEFT JOIN ``customer`` (shuffle join on the customer key,
AQE splits a hot customer) LEFT JOIN ``nation`` (25 rows, broadcast by the
size-checked threshold); then one narrow projection. Every order yields
exactly one example.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordsmith.functions.text import json_string
from recordsmith.operators.parallel import spread
from recordsmith.sources.tables import table

# Fixed values of the corpus texts.
REFUSAL_REASON = "No extractable order facts present."
WRONG_REASON = "Not an order."
PROSE_HEAD = "Sure! Here is the extracted record:\n"
PROSE_TAIL = "\nLet me know if you need anything else."
TRAILER = " END"
CUT_CHARS = 12
EXTRA_MEMBER = '"note": "rush"'
NON_OBJECT = "[1]"
BLANK = "   "

# Damage classes, by o_orderkey % 10.
DAMAGES = ["clean", "prose", "trailing", "truncated", "wrong_value",
           "missing_key", "extra_key", "flipped_refusal", "non_object", "blank"]


def _num(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit("null"))


# Texts that the members of a record are put together from, made once an order.
PIECES = ["cents_text", "head", "priority_member", "middle", "tail"]


def _pieces(c: dict) -> dict[str, Column]:
    """``PIECES`` of an order's columns, ``", "`` / ``": "`` separators."""
    name = json_string(c["name"])
    return {
        "cents_text": _num(c["cents"]),
        "head": F.concat(F.lit('"order_id": '), _num(c["key"]), F.lit(', "customer": '), name,
                         F.lit(', "order_date": '), json_string(c["date"])),
        "priority_member": F.concat(F.lit(', "priority": '), json_string(c["priority"])),
        "middle": F.concat(F.lit(', "tags": ['), json_string(c["status"]), F.lit(", "), json_string(c["segment"]),
                           F.lit('], "parties": [{"name": '), name, F.lit(', "nation": '), json_string(c["nation"]),
                           F.lit('}], "amounts": {"total_cents": ')),
        "tail": F.concat(F.lit(', "balance_cents": '), _num(c["balance"]), F.lit("}")),
    }


def _members(*, cents_delta: int = 0, float_amount: bool = False,
             drop_priority: bool = False, extra: bool = False) -> Column:
    """Record members in insertion order, from the columns ``PIECES`` (and ``cents``)."""
    total = _num(F.col("cents") + F.lit(cents_delta)) if cents_delta else F.col("cents_text")
    parts = [F.col("head")]
    if not drop_priority:
        parts += [F.col("priority_member")]
    parts += [F.lit(', "total_cents": '), total, F.col("middle"), F.col("cents_text")]
    if float_amount:
        parts += [F.lit(".0")]
    parts += [F.col("tail")]
    if extra:
        parts += [F.lit(", " + EXTRA_MEMBER)]
    return F.concat(*parts)


def _refusal(reason: str | None = REFUSAL_REASON, extra: bool = False, first_record: bool = True) -> Column:
    body = []
    if first_record:
        body.append('"record": null')
    body.append('"can_extract": false')
    if reason is not None:
        body.append(f'"refusal_reason": "{reason}"')
    if not first_record:
        body.append('"record": null')
    if extra:
        body.append(EXTRA_MEMBER)
    return F.lit("{" + ", ".join(body) + "}")


def _target_refusal() -> Column:
    return F.lit('{"can_extract": false, "refusal_reason": "' + REFUSAL_REASON + '", "record": null}')


def _target_record() -> Column:
    return F.concat(F.lit('{"can_extract": true, "refusal_reason": null, "record": {'),
                    _members(), F.lit("}}"))


def _pred_record(members: Column) -> Column:
    return F.concat(F.lit('{"record": {'), members, F.lit('}, "can_extract": true, "refusal_reason": null}'))


ORDER_SCHEMA_HINT = "order_record_v1"


def _fstr(col: Column) -> Column:
    """f-string rendering of a value (None -> 'None')."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def order_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined order facts every corpus text is built from (one row per order)."""
    orders = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), "o_orderkey")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
         .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left"))
    base = j.select(
        F.col("o_orderkey").alias("key"), F.col("c_name").alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderpriority").alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.col("o_orderstatus").alias("status"), F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"), F.round(F.col("c_acctbal") * 100).cast("bigint").alias("balance"),
        F.coalesce(F.col("o_orderstatus") == "P", F.lit(False)).alias("refusal"))
    c = {k: F.col(k) for k in ("key", "name", "date", "priority", "cents", "status", "segment", "nation", "balance")}
    input_text = F.concat(
        F.lit("Order "), _fstr(c["key"]), F.lit(" for "), _fstr(c["name"]), F.lit(" ("), _fstr(c["nation"]),
        F.lit(") placed "), _fstr(c["date"]), F.lit(", priority "), _fstr(c["priority"]),
        F.lit(", status "), _fstr(c["status"]), F.lit(", segment "), _fstr(c["segment"]),
        F.lit(". Total "), _fstr(c["cents"]), F.lit(" cents; customer balance "), _fstr(c["balance"]),
        F.lit(" cents."))
    target = F.when(F.col("refusal"), _target_refusal()).otherwise(_target_record())
    return base.withColumns(_pieces(c)).select("*", F.format_string("order-%d", F.col("key")).alias("id"),
                       input_text.alias("input_text"), F.lit(ORDER_SCHEMA_HINT).alias("schema_hint"),
                       target.alias("target_text"))


def damaged_text(d: Column) -> Column:
    """The prediction text of damage class ``d`` (0-9) for an ``order_source`` row.

    The expression only names columns, so it is built once per process (``_d``
    stands for the class) and reused; ``d`` is substituted through a
    projection by the callers below.
    """
    return _damaged_template()


@functools.lru_cache(maxsize=1)
def _damaged_template() -> Column:
    d = F.col("_d")
    refusal = F.col("refusal")
    base = F.when(refusal, _refusal()).otherwise(_pred_record(_members()))
    return (
        F.when(d == 0, base)
        .when(d == 1, F.concat(F.lit(PROSE_HEAD), base, F.lit(PROSE_TAIL)))
        .when(d == 2, F.concat(base, F.lit(TRAILER)))
        .when(d == 3, base.substr(F.lit(1), F.length(base) - CUT_CHARS))
        .when(d == 4, F.when(refusal, _refusal(WRONG_REASON))
              .otherwise(_pred_record(_members(cents_delta=1, float_amount=True))))
        .when(d == 5, F.when(refusal, _refusal(None))
              .otherwise(_pred_record(_members(drop_priority=True))))
        .when(d == 6, F.when(refusal, _refusal(extra=True))
              .otherwise(_pred_record(_members(extra=True))))
        .when(d == 7, F.when(refusal, _pred_record(_members())).otherwise(_refusal()))
        .when(d == 8, F.lit(NON_OBJECT))
        .otherwise(F.lit(BLANK)))


def order_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, o_orderkey, damage, can_extract, target_text, raw_output`` -- one row per order."""
    src = order_source(spark, sf_dir).withColumn("_d", F.pmod(F.col("key"), F.lit(10)))
    return src.select("id", F.col("key").alias("o_orderkey"), F.col("_d").cast("int").alias("damage"),
                      (~F.col("refusal")).alias("can_extract"), "target_text",
                      damaged_text(F.col("_d")).alias("raw_output"))


def order_candidates(src: DataFrame, k: int = 4, stride: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """C19 with the damage classes as the generator: ``k`` candidates per row,
    candidate ``j`` being damage class ``(key + stride*j) % 10``."""
    j = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("candidate_index")
    exploded = src.select("*", j).withColumn(
        "_d", F.pmod(F.col("key") + F.lit(stride) * F.col("candidate_index"), F.lit(10)))
    return exploded.select("id", F.col("candidate_index").cast("int").alias("candidate_index"),
                           damaged_text(F.col("_d")).alias("text"), *keep)
