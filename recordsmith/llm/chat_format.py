"""Relational chat formatting (operator 4), by built-in functions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one
role are merged into a block with array functions; blocks are concatenated:

    <s>role[INST]text[NEXT]text[/INST]</s>

Control strings inside a role or text are escaped: a backslash goes after the opening
character of every control string, however many backslashes already stand there, so no
unescaped control string is left and taking one backslash away restores the text. The
formatted text can therefore be cut at its control strings, and every turn read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.common import read_table

# Control strings: <s> </s> [INST] [/INST] [NEXT].
TAIL = r"(/?s>|/?INST\]|NEXT\])"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + TAIL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + TAIL, r"$1$2$3")


def format_chats(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per conversation: (conv_id, segments, formatted).

    ``segments`` is an array of (text, trained) whose texts make up ``formatted``; trained
    segments are the texts of ``trained_role``, without any markup: the loss mask. Null
    texts and null roles count as empty. Turns sort by (turn, role, text), nulls first, so
    ties have one order and repeated rows stay repeated. Rows with a null conv_id form one
    conversation. Other columns are not used. A conversation is one value in one task, as
    its formatted text is one value.
    """
    turns = (df.select(F.col(f"`{conv_id}`").alias("conv_id"),
                       F.struct(F.col(f"`{turn}`").alias("turn"),
                                F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                                F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).alias("t"))
               .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    # Where a new role begins; a block reaches to the next such place.
    starts = turns.withColumn("starts", F.expr(
        "filter(sequence(1, size(turns)), i -> i = 1 OR turns[i - 1].role <> turns[i - 2].role)"))
    blocks = starts.withColumn("blocks", F.expr(
        "transform(starts, (s, k) -> slice(turns, s,"
        " if(k + 1 < size(starts), starts[k + 1], size(turns) + 1) - s))"))

    def segments(block: Column) -> Column:
        name = block[0]["role"]
        train = name == trained_role

        def text_segment(x, k):
            lead = F.when(k == 0, F.concat(F.lit("<s>"), escape(name), F.lit("[INST]"))) \
                    .otherwise(F.lit("[NEXT]"))
            return F.array(F.struct(lead.alias("text"), F.lit(False).alias("trained")),
                           F.struct(escape(x["text"]).alias("text"), train.alias("trained")))

        end = F.array(F.struct(F.lit("[/INST]</s>").alias("text"), F.lit(False).alias("trained")))
        return F.concat(F.flatten(F.transform(block, text_segment)), end)

    out = blocks.withColumn("segments", F.flatten(F.transform("blocks", segments)))
    return out.select("conv_id", "segments",
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """array of (role, text): the turns of a formatted conversation."""
    blocks = F.filter(F.split(formatted, "<s>"), lambda b: b != "")

    def turns(block):
        parts = F.split(block, r"\[INST\]")
        texts = F.split(F.regexp_replace(parts[1], r"\[/INST\]</s>$", ""), r"\[NEXT\]")
        return F.transform(texts, lambda t: F.struct(unescape(parts[0]).alias("role"),
                                                     unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    trained = F.filter(segments, lambda s: s["trained"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")


def op4_chat_format(spark, sf_dir):
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = (format_chats(chats.unionByName(extra))
           .withColumn("turns", read_turns(F.col("formatted")))
           .withColumn("loss", loss_text(F.col("segments"))))
    listed = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(listed, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, coalesce(lag(role) OVER w <> role, true) AS opens FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), f AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|NEXT\])', '\1\2\\\3', 'g') AS e,
         regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|NEXT\])', '\1\2\\\3', 'g') AS r FROM o
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(len(e) + CASE WHEN opens THEN len('<s>[INST][/INST]</s>') + len(r) ELSE len('[NEXT]') END)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
