"""Expressions over a ``messages`` column, ``array<struct<role, content>>``.

Each is a projection: no shuffle, no Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatprep.functions.binding import let
from chatprep.functions.text import strip
from chatprep.schema import MESSAGES

DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant."


@dataclass(frozen=True)
class Template:
    """How one message is written into the training text. The default is the public ChatML form;
    ``missing`` is what a template prints for a null."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_content: str = "<|im_end|>\n"
    missing: str = "None"


CHATML = Template()


def message(role: str | Column, content: str | Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(role.alias("role"), content.alias("content"))


def _present(messages: Column) -> Column:
    return F.coalesce(messages, F.array().cast(MESSAGES))


def is_empty(messages: Column) -> Column:
    return F.coalesce(F.size(messages), F.lit(0)) <= 0


def ensure_system(messages: Column, prompt: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """Put a system message first unless the first message already is one."""
    lacks = is_empty(messages) | ~F.get(messages, F.lit(0))["role"].eqNullSafe("system")
    return F.when(lacks, prepend_system(messages, prompt)).otherwise(messages)


def prepend_system(messages: Column, prompt: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """Put a system message first in any case."""
    return F.concat(F.array(message("system", prompt)), _present(messages))


def build_chat(
    user_message: Column,
    history: Column | None = None,
    prompt: str = DEFAULT_SYSTEM_PROMPT,
) -> Column:
    """A fresh system + user chat, or the history with the user turn appended if it has turns."""
    fresh = F.array(message("system", prompt), message("user", user_message))
    if history is None:
        return fresh
    return F.when(is_empty(history), fresh).otherwise(append_turn(history, "user", user_message))


def append_turn(messages: Column, role: str, content: Column) -> Column:
    return F.concat(_present(messages), F.array(message(role, content)))


def render_message(role: Column, content: Column, template: Template = CHATML) -> Column:
    """One message of a training text; a missing role or content reads ``template.missing``."""
    return F.concat(
        F.lit(template.before_role),
        F.coalesce(role, F.lit(template.missing)),
        F.lit(template.after_role),
        F.coalesce(content, F.lit(template.missing)),
        F.lit(template.after_content),
    )


def render_chat(messages: Column, template: Template = CHATML) -> Column:
    """All messages as one training text."""
    return F.array_join(
        F.transform(messages, lambda m: render_message(m["role"], m["content"], template)), ""
    )


def render_prompt(messages: Column, template: Template = CHATML) -> Column:
    """The training text with an open assistant turn at its end."""
    opening = template.before_role + "assistant" + template.after_role
    return F.concat(render_chat(messages, template), F.lit(opening))


# ---- records of other formats ------------------------------------------------------------------


def qa_to_chat(
    user: Column,
    assistant: Column,
    prompt: str = DEFAULT_SYSTEM_PROMPT,
    null_text: str = "nan",
) -> Column:
    """Two table cells as a chat. A missing cell is written as ``null_text``."""

    def cell(c: Column) -> Column:
        return strip(F.coalesce(c.cast("string"), F.lit(null_text)))

    return F.array(
        message("system", prompt), message("user", cell(user)), message("assistant", cell(assistant))
    )


def _instruction_and_input(instruction: Column, extra: Column) -> Column:
    return strip(F.concat(instruction, F.lit("\n"), extra))


def alpaca_to_chat(
    instruction: Column, extra: Column, output: Column, prompt: str = DEFAULT_SYSTEM_PROMPT
) -> Column:
    """Instruction record as a chat; missing fields are empty, and the instruction alone stays as
    it is."""
    instruction, extra, output = (
        F.coalesce(c, F.lit("")) for c in (instruction, extra, output)
    )
    user = F.when(F.length(extra) > 0, _instruction_and_input(instruction, extra)).otherwise(
        instruction
    )
    return F.array(message("system", prompt), message("user", user), message("assistant", output))


def alpaca_format_strict(
    instruction: Column, extra: Column, output: Column, prompt: str = DEFAULT_SYSTEM_PROMPT
) -> Column:
    """Instruction record as a chat, always stripping; a missing input reads ``None``."""
    user = _instruction_and_input(
        F.coalesce(instruction, F.lit("None")), F.coalesce(extra, F.lit("None"))
    )
    return F.array(message("system", prompt), message("user", user), message("assistant", output))


# Prompts of the word-problem format and of the presets.
MATH_SYSTEM_PROMPT = (
    "You are a helpful math tutor. Solve problems step-by-step and provide your final answer in "
    "\\boxed{}."
)
MATH_QUESTION_HEAD = "Solve this math word problem step by step.\n\nProblem: "
MATH_QUESTION_TAIL = "\n\nShow your work clearly and put your final numerical answer in \\boxed{}."
MATH_ANSWER_HEAD = "\n\nTherefore, the final answer is \\boxed{"
MATH_ANSWER_TAIL = "}."
ADAPTER_HEAD = "Solve this step by step:\n\n"
ADAPTER_TAIL = "\n\nPut your final answer in \\boxed{}."
ANSWER_MARK = "####"

PRESET_PROMPTS = {
    "customer_service": (
        "You are a helpful, empathetic customer support agent for {company_name}. Provide concise, "
        "professional assistance while being understanding of customer concerns."
    ),
    "code_assistant": (
        "You are a helpful programming assistant. Provide clear, well-commented code examples and "
        "explanations."
    ),
}


def preset_prompt(name: str, company_name: str = "ACME") -> str:
    if name not in PRESET_PROMPTS:
        raise ValueError(f"unknown preset: {name}")
    return PRESET_PROMPTS[name].format(company_name=company_name)


def format_preset(messages: Column, name: str, company_name: str = "ACME") -> Column:
    """Training text of a chat that gets the preset's system prompt if it has none."""
    return render_chat(ensure_system(messages, preset_prompt(name, company_name)))


def gsm8k_gold(answer: Column) -> Column:
    """The text after the last answer mark, marks being found from the left.

    Looked for from the right, the last mark is the same one, unless one of its signs more stands
    beside it; only such texts are split.
    """
    last = F.substring_index(answer, ANSWER_MARK, -1)
    longer = F.contains(answer, F.lit(ANSWER_MARK + ANSWER_MARK[0]))
    return strip(F.when(longer, F.element_at(F.split(answer, ANSWER_MARK), -1)).otherwise(last))


def gsm8k_to_chat(question: Column, answer: Column) -> Column:
    rationale = strip(F.substring_index(answer, ANSWER_MARK, 1))
    user = F.concat(F.lit(MATH_QUESTION_HEAD), question, F.lit(MATH_QUESTION_TAIL))
    reply = F.concat(
        rationale, F.lit(MATH_ANSWER_HEAD), gsm8k_gold(answer), F.lit(MATH_ANSWER_TAIL)
    )
    return F.array(
        message("system", MATH_SYSTEM_PROMPT), message("user", user), message("assistant", reply)
    )


def gsm8k_adapter_prompt(question: Column) -> Column:
    return F.concat(F.lit(ADAPTER_HEAD), question, F.lit(ADAPTER_TAIL))


# ---- parts of a conversation -------------------------------------------------------------------


def _is_assistant(m: Column) -> Column:
    return m["role"].eqNullSafe("assistant")


def eval_pair(messages: Column) -> Column:
    """``struct<prompt_messages, expected_response>`` of a conversation.

    Leading assistant turns are skipped; the prompt then runs up to the first assistant turn, whose
    content is the expected response ('' if there is none).
    """

    def split_at(first: Column) -> Column:
        answer = F.array_position(
            F.transform(messages, lambda m, i: _is_assistant(m) & (first > 0) & (i + 1 > first)),
            F.lit(True),
        )
        return let(answer.cast("int"), lambda at: pair(first, at))

    def pair(first: Column, at: Column) -> Column:
        end = F.when(at > 0, at).otherwise(F.size(messages) + 1)
        prompt = F.when(first > 0, F.slice(messages, first, end - first)).otherwise(
            F.array().cast(MESSAGES)
        )
        expected = F.when(at > 0, F.get(messages, at - 1)["content"])
        return F.struct(
            prompt.alias("prompt_messages"),
            F.coalesce(expected, F.lit("")).alias("expected_response"),
        )

    first = F.array_position(F.transform(messages, lambda m: ~_is_assistant(m)), F.lit(True))
    return let(F.coalesce(first, F.lit(0)).cast("int"), split_at)


def conversation_prompt(messages: Column) -> Column:
    """Messages that are not the assistant's, or that equal the first message."""
    return let(
        F.get(messages, F.lit(0)),
        lambda first: F.filter(messages, lambda m: ~_is_assistant(m) | m.eqNullSafe(first)),
    )


def conversation_id(metadata: Column, row_id: Column) -> Column:
    """The record's own id if its metadata has one, else the row id."""
    return F.coalesce(F.try_element_at(metadata, F.lit("id")), row_id.cast("string"))


def preprocess(
    record: Mapping[str, Column],
    data_format: str,
    prompt: str = DEFAULT_SYSTEM_PROMPT,
    template: Template = CHATML,
) -> Column:
    """Training text of one record of the given format."""
    if data_format == "chatml":
        return render_chat(ensure_system(record["messages"], prompt), template)
    if data_format == "alpaca":
        chat = alpaca_format_strict(
            record["instruction"], record.get("input", F.lit("")), record["output"], prompt
        )
        return render_chat(chat, template)
    raise ValueError(f"no rule for format '{data_format}'")
