"""Prompt texts and the chat markup (C6, C7, C9 constants)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The system prompt of the extraction task.
SYSTEM_PROMPT = """You extract structured medical data from noisy notes.
Return exactly one compact JSON object and nothing else.
Always use this schema:
{
  "can_extract": boolean,
  "refusal_reason": string or null,
  "record": {
    "patient_name": string,
    "age": integer,
    "sex": string,
    "encounter_date": string,
    "chief_complaint": string,
    "diagnoses": [string],
    "medications": [{"name": string, "dose": string}],
    "allergies": [string],
    "vitals": {
      "blood_pressure": string,
      "heart_rate": integer,
      "temperature_f": number
    },
    "follow_up_days": integer
  } or null
}

If the note does not contain extractable medical facts, respond with:
{"can_extract": false, "refusal_reason": "...", "record": null}
"""

# The user-prompt template pieces.
USER_PROMPT_HEAD = "Extract the medical record into the required JSON schema.\nSchema hint: "
USER_PROMPT_MID = "\nInput note:\n"

# The ranking instruction given to the judge.
JUDGE_INSTRUCTION = """You are ranking structured JSON extraction outputs.
Choose the best and worst answer for the given target.

Prefer answers that:
1. Are valid JSON.
2. Match the schema exactly.
3. Match the target record accurately.
4. Refuse only when the target should refuse.

Return JSON:
{"chosen_index": int, "rejected_index": int, "reason": "..."}
"""

# Chat markup of the base model's template and its default
# system turn (used when a conversation does not start with one).
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
DEFAULT_SYSTEM = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
TOOL_OPEN = "\n<tool_response>\n"
TOOL_CLOSE = "\n</tool_response>"

DEFAULT_SCHEMA_HINT = "medical_intake_v1"


def user_prompt(input_text: Column, schema_hint: Column) -> Column:
    """C6 ``build_user_prompt``: f-string semantics (None renders as 'None')."""
    def s(c: Column) -> Column:
        return F.coalesce(c, F.lit("None"))
    return F.concat(F.lit(USER_PROMPT_HEAD), s(schema_hint), F.lit(USER_PROMPT_MID), s(input_text))


def turn_block(role: Column, content: Column) -> Column:
    """``<|im_start|>role\\ncontent<|im_end|>\\n``."""
    return F.concat(F.lit(IM_START), role, F.lit("\n"), content, F.lit(IM_END + "\n"))


def system_block(content: Column | None = None) -> Column:
    return turn_block(F.lit("system"), content if content is not None else F.lit(DEFAULT_SYSTEM))


def generation_prompt() -> Column:
    return F.lit(IM_START + "assistant\n")


def inference_prompt(input_text: Column, schema_hint: Column) -> Column:
    """C11: system + user turns and the generation suffix, as one string."""
    return F.concat(system_block(F.lit(SYSTEM_PROMPT)),
                    turn_block(F.lit("user"), user_prompt(input_text, schema_hint)),
                    generation_prompt())
