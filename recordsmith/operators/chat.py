"""Chat-template rendering.

Input is a long table ``(conv_id, turn, role, text)``. Rendering follows the
base model's template without tools:

* a system header: the first turn's text when it is a system turn, else the
  default system text;
* ``user``, ``assistant`` and non-first ``system`` turns as
  ``<|im_start|>role\\ntext<|im_end|>\\n``;
* consecutive ``tool`` turns share one ``user`` block of ``<tool_response>``
  parts; any other role renders nothing;
* optionally the generation suffix ``<|im_start|>assistant\\n``.

Plan: one aggregation by conversation (a single hash shuffle, partial
aggregation map-side). The turns of a conversation are sorted inside that
row, and first/previous/next role come from array positions. No window sort
over all rows is needed. The output is one string per conversation, so a
conversation's turns are held together by design, as the template needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordsmith.functions.jsonparse import ascii_escape
from recordsmith.functions.prompts import (DEFAULT_SYSTEM, IM_END, IM_START, SYSTEM_PROMPT,
                                           TOOL_CLOSE, TOOL_OPEN, generation_prompt, system_block,
                                           turn_block, user_prompt)


def _piece(turns: Column, x: Column, i: Column) -> Column:
    """Rendered text of turn ``x`` at 0-based position ``i`` of sorted ``turns``."""
    role = x["role"]
    text = F.coalesce(x["text"], F.lit(""))
    prev_role = F.when(i > 0, F.get(turns, i - 1)["role"])
    next_role = F.get(turns, i + 1)["role"]
    plain = (role == "user") | (role == "assistant") | ((role == "system") & (i > 0))
    tool = F.concat(
        F.when((i == 0) | ~F.coalesce(prev_role == "tool", F.lit(False)), F.lit(IM_START + "user")).otherwise(F.lit("")),
        F.lit(TOOL_OPEN), text, F.lit(TOOL_CLOSE),
        F.when(~F.coalesce(next_role == "tool", F.lit(False)), F.lit(IM_END + "\n")).otherwise(F.lit("")))
    return (F.when(plain, turn_block(role, text))
            .when(role == "tool", tool)
            .otherwise(F.lit("")))


def render_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         add_generation_prompt: bool = False) -> DataFrame:
    """One rendered ``text`` per conversation."""
    grouped = df.groupBy(conv_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                                             F.col(text_col).alias("text")))).alias("_turns"))
    first = F.get(F.col("_turns"), 0)
    header = F.when(first["role"] == "system", system_block(F.coalesce(first["text"], F.lit(""))))\
        .otherwise(system_block(F.lit(DEFAULT_SYSTEM)))
    body = F.array_join(F.transform("_turns", lambda x, i: _piece(F.col("_turns"), x, i)), "")
    parts = [header, body] + ([generation_prompt()] if add_generation_prompt else [])
    return grouped.select(F.col(conv_col), F.concat(*parts).alias("text"))


def events_as_turns(events: DataFrame) -> DataFrame:
    """Tool-bearing conversations from an event log: one conversation per user
    and day, turns in time order; errors and clicks are tool results, views are
    user turns, the rest assistant turns. Used to exercise the tool branch."""
    role = (F.when(F.col("event_type").isin("error", "click"), F.lit("tool"))
            .when(F.col("event_type") == "view", F.lit("user"))
            .otherwise(F.lit("assistant")))
    return events.select(
        F.format_string("%d-%s", F.col("user_id"), F.date_format("ts", "yyyy-MM-dd")).alias("conv_id"),
        F.struct(F.col("ts").alias("ts"), F.col("event_id").alias("event_id")).alias("turn"),
        role.alias("role"),
        F.concat(F.col("event_type"), F.lit(" "), F.coalesce(F.col("props"), F.lit("null"))).alias("text"))


def sft_text(examples: DataFrame, target_col: str = "target_json") -> DataFrame:
    """System + user + assistant (compact target JSON) as one ``text`` column.

    Replaces every column with ``text``, as the reference's row map does.
    ``target_col`` is a STRUCT (written compact, nulls kept) or JSON text; either is
    ASCII-escaped (X18).
    """
    tgt = F.col(target_col)
    dtype = dict(examples.dtypes)[target_col]
    if dtype.startswith("struct"):
        tgt = F.to_json(tgt, {"ignoreNullFields": "false"})
    return examples.select(F.concat(
        system_block(F.lit(SYSTEM_PROMPT)),
        turn_block(F.lit("user"), user_prompt(F.col("input_text"), F.col("schema_hint"))),
        turn_block(F.lit("assistant"), ascii_escape(tgt))).alias("text"))
