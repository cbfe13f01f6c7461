"""Preference pairs: candidates, judge payload, verdicts, pairs.

Candidates arrive as a long table ``(id, candidate_index, text)``. Per-id
lists are one aggregation (partial aggregation map-side); joins on ``id``
reuse that hash partitioning. The rule-based judge picks best and worst by
``max_by``/``min_by`` over a score struct -- an aggregate, so a hot id with
many candidates is pre-aggregated on every partition instead of being
sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import rowjson as R
from recordsmith.functions import scoring as S
from recordsmith.functions.prompts import JUDGE_INSTRUCTION, SYSTEM_PROMPT, user_prompt
from recordsmith.functions.text import json_string
from recordsmith.operators.evaluate import score_predictions
from recordsmith.operators.pretty import pretty_json

ON_ERROR = ("fail", "quarantine")


def candidate_lists(cands: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id -> candidates`` ordered by ``candidate_index``, with columns that are the same
    for all candidates of an id (``keep``)."""
    return cands.groupBy("id").agg(*[F.first(c).alias(c) for c in keep],
        F.transform(F.array_sort(F.collect_list(F.struct("candidate_index", "text"))),
                    lambda x: x["text"]).alias("candidates"))


def candidates_from_map(df: DataFrame, map_col: str = "value") -> DataFrame:
    """S3: a ``{id: [texts]}`` document (``map<string,array<string>>``) to the long table."""
    pairs = df.select(F.explode(F.col(map_col)).alias("id", "_texts"))
    return pairs.select("id", F.posexplode("_texts").alias("candidate_index", "text"))


def attach_candidates(rows: DataFrame, lists: DataFrame, on_missing: str = "fail") -> DataFrame:
    """Rows with their candidate list; a row without candidates fails the job
    (the reference's dict lookup raises) or, in quarantine mode, gets NULL."""
    joined = rows.join(lists, "id", "left")
    if on_missing == "fail":
        return joined.withColumn("candidates", F.when(
            F.col("candidates").isNull(),
            F.raise_error(F.concat(F.lit("no candidates for id "), F.col("id"))).cast("array<string>"))
            .otherwise(F.col("candidates")))
    return joined


def judge_payload(rows: DataFrame) -> DataFrame:
    """The judge request body: instruction, user prompt, target, candidates.

    Compact JSON with a fixed key order, ASCII-escaped (X18); the target JSON text is
    embedded as it is. ``pretty.pretty_json`` gives the indented form (X17).
    """
    payload = J.ascii_escape(F.concat(
        F.lit('{"instruction":'), json_string(F.lit(SYSTEM_PROMPT)),
        F.lit(',"user_prompt":'), json_string(user_prompt(F.col("input_text"), F.col("schema_hint"))),
        F.lit(',"target_json":'), F.col("target_text"),
        F.lit(',"candidates":'), F.to_json(F.col("candidates")),
        F.lit("}")))
    return rows.select("id", payload.alias("payload"))


def judge_request(rows: DataFrame) -> DataFrame:
    """(id, system, user): the two messages that go to a judge, the body indented."""
    body = pretty_json(judge_payload(rows), "id", "payload")
    return body.select("id", F.lit(JUDGE_INSTRUCTION).alias("system"), F.col("text").alias("user"))


def score_candidates(cands_with_target: DataFrame, record_fields: dict[str, str],
                     target_col: str = "target_text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per-candidate judge criteria: valid JSON, schema match, accuracy, refusal.

    ``target_col`` may be JSON text or VARIANT. Candidates of an example that stand next to
    each other share the reading of its target.
    """
    return score_predictions(cands_with_target.withColumnRenamed("text", "raw_output"), target_col=target_col,
                             keep=("id", "candidate_index", *keep), record_fields=record_fields)


def rule_judge(scored: DataFrame, keep: tuple[str, ...] = (), lists: bool = False) -> DataFrame:
    """Best and worst candidate per id, with columns that are the same for all
    candidates of an id (``keep``) and, with ``lists``, the candidates in index order, all from
    the one aggregation.

    Order: valid, schema match, field F1, refusal correctness (all
    descending), then lower index first. ``chosen`` is the first in that
    order, ``rejected`` the last.
    """
    key = F.struct(F.col("json_valid").cast("int").alias("v"), F.col("schema_ok").cast("int").alias("s"),
                   F.col("field_f1").alias("f"), F.col("refusal_correct").cast("int").alias("r"),
                   (-F.col("candidate_index")).alias("i"))
    info = F.struct(F.col("candidate_index").alias("idx"), F.col("json_valid").alias("valid"),
                    F.col("schema_ok").alias("schema_ok"), F.col("refusal_correct").alias("refusal"))
    carried = [F.first(c).alias(c) for c in keep]
    if lists:
        carried.append(F.transform(F.array_sort(F.collect_list(F.struct("candidate_index", "raw_output"))),
                                   lambda x: x["raw_output"]).alias("candidates"))
    agg = scored.groupBy("id").agg(F.max_by(info, key).alias("_b"), F.min_by(info, key).alias("_w"), *carried)

    def describe(x: Column) -> Column:
        return F.concat(F.lit("valid="), x["valid"].cast("string"), F.lit(" schema="), x["schema_ok"].cast("string"),
                        F.lit(" refusal="), x["refusal"].cast("string"))
    reason = F.concat(F.lit("best ["), describe(F.col("_b")), F.lit("] worst ["), describe(F.col("_w")), F.lit("]"))
    return agg.select("id", F.col("_b.idx").alias("chosen_index"), F.col("_w.idx").alias("rejected_index"),
                      reason.alias("reason"), *keep, *(["candidates"] if lists else []))


def verdict_text(verdicts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The verdict as a judge would answer it: prose around the JSON object."""
    obj = F.to_json(F.struct("chosen_index", "rejected_index", "reason"))
    return verdicts.select("id", F.concat(F.lit("Ranking complete. "), obj).alias("output_text"), *keep)


def parse_verdicts(texts: DataFrame, on_error: str = "fail", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``output_text`` -> (chosen_index, rejected_index, reason).

    Takes the first-``{``-to-last-``}`` span whenever both braces exist.
    ``fail`` raises on a bad verdict (missing braces, unparsable, missing or
    non-integer index, no reason) like the reference; ``quarantine`` returns
    good rows and bad rows separately. Returns ``(good, bad)``.
    """
    if on_error not in ON_ERROR:
        raise ValueError(on_error)
    parsed = _read_verdicts(texts, keep)
    if on_error == "fail":
        # As a filter: column pruning cannot take the check away.
        good = parsed.where(F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(
            F.concat(F.lit("bad judge verdict for id "), F.col("id"))).cast("boolean")))
        good = good.select("id", "chosen_index", "rejected_index", "reason", *keep)
        return good, parsed.where(F.lit(False)).select("id", "output_text")
    return (parsed.where("ok").select("id", "chosen_index", "rejected_index", "reason", *keep),
            parsed.where("NOT ok").select("id", "output_text"))


def _read_verdicts(texts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, output_text, chosen_index, rejected_index, reason, ok) of every verdict text."""
    text = F.col("output_text")
    has_braces = (F.instr(text, "{") > 0) & (F.instr(text, "}") > 0)
    start = F.instr(text, "{")
    end = F.length(text) - F.instr(F.reverse(text), "}") + 1
    # text[find('{'):rfind('}') + 1] -- empty when the braces are reversed.
    span = F.when(end >= start, F.expr("substring(output_text, instr(output_text, '{'), "
                                       "length(output_text) - instr(reverse(output_text), '}') + 2 "
                                       "- instr(output_text, '{'))")).otherwise(F.lit(""))
    spans = texts.select("id", "output_text", has_braces.alias("_braces"), span.alias("_span"), *keep)
    parsed = R.with_verdicts(spans, "_span")
    ok = (F.coalesce("_braces", F.lit(False)) & F.col("chosen_index").isNotNull() & F.col("rejected_index").isNotNull()
          & F.col("reason").isNotNull())
    return parsed.select("id", "output_text", "chosen_index", "rejected_index", "reason", ok.alias("ok"), *keep)


def write_verdicts(texts: DataFrame, path: str) -> dict[str, int]:
    """F8: read every verdict text once and write it, good or not, under ``path``, in folders
    ``state=good`` and ``state=bad``; returns how many went to each. The counts come from the
    same pass. A rerun replaces both folders."""
    parsed = _read_verdicts(texts).withColumn("state", F.when(F.col("ok"), "good").otherwise("bad")).drop("ok")
    seen = Observation()
    counted = parsed.observe(seen, F.count(F.when(F.col("state") == "good", 1)).alias("good"),
                             F.count(F.when(F.col("state") == "bad", 1)).alias("bad"))
    counted.write.mode("overwrite").partitionBy("state").parquet(path)
    return {k: int(v) for k, v in seen.get.items()}


def read_verdicts(spark, path: str, state: str) -> DataFrame:
    """One side of ``write_verdicts``; only its folder is read."""
    schema = "id string, output_text string, chosen_index int, rejected_index int, reason string, state string"
    return spark.read.schema(schema).parquet(path).where(F.col("state") == state).drop("state")


def py_index(arr: Column, i: Column, strict: bool = True) -> Column:
    """Python ``list[i]`` (negative counts from the end). Out of range
    raises (strict) or gives NULL."""
    pos = F.when(i >= 0, i + 1).otherwise(i)
    return F.element_at(arr, pos) if strict else F.try_element_at(arr, pos)


def preference_pairs(rows: DataFrame, verdicts: DataFrame, strict: bool = True,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, prompt, chosen, rejected, label_reason`` (+ same_choice flag).

    ``rows`` carry input_text, schema_hint and candidates; the prompt has no
    system text. A row without a verdict fails the run (strict) or keeps null texts.
    Chosen = rejected is kept and flagged, as the reference does
    not guard against it.
    """
    return pairs_of(rows.join(verdicts, "id", "left"), strict, keep)


def pairs_of(j: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``preference_pairs`` of rows that already carry their candidates and verdict."""
    if strict:
        j = j.where(F.when(F.col("chosen_index").isNotNull(), F.lit(True)).otherwise(F.raise_error(
            F.concat(F.lit("no judge verdict for id "), F.col("id"))).cast("boolean")))
    return j.select(
        "id",
        user_prompt(F.col("input_text"), F.col("schema_hint")).alias("prompt"),
        py_index(F.col("candidates"), F.col("chosen_index"), strict).alias("chosen"),
        py_index(F.col("candidates"), F.col("rejected_index"), strict).alias("rejected"),
        F.col("reason").alias("label_reason"),
        (F.col("chosen_index") == F.col("rejected_index")).alias("same_choice"),
        *keep)
