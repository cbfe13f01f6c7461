"""Chat-template rendering, including tool turns."""

from recordsmith.functions.prompts import DEFAULT_SYSTEM, SYSTEM_PROMPT
from recordsmith.operators.chat import render_conversations, sft_text

S, E = "<|im_start|>", "<|im_end|>"


def _render(spark, rows, gen=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {r.conv_id: r.text for r in render_conversations(df, add_generation_prompt=gen).collect()}


def test_default_system_and_generation_prompt(spark):
    out = _render(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], gen=True)
    assert out[1] == (f"{S}system\n{DEFAULT_SYSTEM}{E}\n{S}user\nhi{E}\n{S}assistant\nyo{E}\n{S}assistant\n")


def test_first_system_emitted_once_later_system_kept(spark):
    out = _render(spark, [(1, 3, "system", "sys"), (1, 5, "user", "q"), (1, 9, "system", "again")])
    assert out[1] == f"{S}system\nsys{E}\n{S}user\nq{E}\n{S}system\nagain{E}\n"


def test_consecutive_tool_turns_share_one_user_block(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "tool", "a"), (1, 2, "tool", "b"), (1, 3, "assistant", "ok"),
            (1, 4, "tool", "c"), (1, 5, "other", "ignored")]
    out = _render(spark, rows)
    assert out[1] == (f"{S}system\n{DEFAULT_SYSTEM}{E}\n{S}user\nq{E}\n"
                      f"{S}user\n<tool_response>\na\n</tool_response>\n<tool_response>\nb\n</tool_response>{E}\n"
                      f"{S}assistant\nok{E}\n"
                      f"{S}user\n<tool_response>\nc\n</tool_response>{E}\n")


def test_sft_text(spark):
    df = spark.createDataFrame([("note", "hint", '{"a":1}')], "input_text string, schema_hint string, target_json string")
    text = sft_text(df).first().text
    assert text.startswith(f"{S}system\n{SYSTEM_PROMPT}{E}\n{S}user\nExtract the medical record")
    assert text.endswith(f"{S}assistant\n{{\"a\":1}}{E}\n")
    assert "Schema hint: hint\nInput note:\nnote" in text
