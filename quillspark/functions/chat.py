"""Conversations as arrays of (role, content) and their rendering to training or prompt text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import strip

# Fixed value: the format instruction given as system message in reward-scored prompts.
FORMAT_INSTRUCTION = """
Respond in the following format:
<think>
...
</think>
<answer>
...
</answer>
"""


@dataclass(frozen=True)
class ChatTemplate:
    """Literals of a header-per-message chat format.

    The template owns both the assistant header and the marker that response-only labels look
    for, so that rendering and labelling cannot drift apart.
    """

    bos: str = "<|begin_of_text|>"
    header_open: str = "<|start_header_id|>"
    header_close: str = "<|end_header_id|>"
    header_gap: str = "\n\n"
    end_of_turn: str = "<|eot_id|>"
    generation_prompt: str = "<|start_header_id|>assistant<|end_header_id|>\n\n"

    @property
    def response_marker(self) -> str:
        return f"{self.header_open}assistant{self.header_close}{self.header_gap}"

    @property
    def special_tokens(self) -> list[str]:
        return [self.bos, self.header_open, self.header_close, self.end_of_turn]


LLAMA3 = ChatTemplate()
# One newline after the header, end-of-text after every turn, and an indented bare open header
# (the template text indents that expression and only tags lose their indentation).
DRAFT = ChatTemplate(
    header_gap="\n",
    end_of_turn="<|end_of_text|>",
    generation_prompt="    <|start_header_id|>assistant<|end_header_id|>",
)


def message(role: str | Column, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def reasoning_target(reasoning: Column, answer: Column, layout: str = "inline") -> Column:
    """Assistant text with tagged reasoning and answer.

    ``inline`` keeps tags and bodies on one line each, ``block`` puts every tag on its own line.
    """
    if layout == "inline":
        pieces = ("<think>", reasoning, "</think>\n<answer>", answer, "</answer>")
    elif layout == "block":
        pieces = ("<think>\n", reasoning, "\n</think>\n<answer>\n", answer, "\n</answer>\n")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def sft_messages(
    system: Column,
    instruction: Column,
    reference: Column,
    reasoning: Column,
    answer: Column,
    compat: bool = False,
) -> Column:
    """System, user and assistant message of one supervised example.

    With ``compat`` a null system prompt, reasoning or answer reads ``None``; otherwise a null
    stays null and the row belongs in the rejected output. Null user parts are never rendered.
    """
    if compat:
        system, reasoning, answer = (
            F.coalesce(c, F.lit("None")) for c in (system, reasoning, answer)
        )
    return F.array(
        message("system", system),
        message("user", F.concat(instruction, F.lit("\n"), reference)),
        message("assistant", reasoning_target(reasoning, answer)),
    )


def rl_prompt(question: Column) -> Column:
    return F.array(message("system", F.lit(FORMAT_INSTRUCTION)), message("user", question))


def render_message(role: Column, content: Column, template: ChatTemplate = LLAMA3) -> Column:
    return F.concat(
        F.lit(template.header_open),
        role,
        F.lit(template.header_close + template.header_gap),
        strip(content),
        F.lit(template.end_of_turn),
    )


def render(
    messages: Column, template: ChatTemplate = LLAMA3, add_generation_prompt: bool = False
) -> Column:
    """Chat text of a message array; null if any message lacks a role or content.

    array_join would silently leave such a message out, hence the explicit guard.
    """
    body = F.array_join(
        F.transform(messages, lambda m: render_message(m["role"], m["content"], template)), ""
    )
    text = F.concat(
        F.when(F.size(messages) > 0, F.lit(template.bos)).otherwise(F.lit("")),
        body,
        F.lit(template.generation_prompt if add_generation_prompt else ""),
    )
    incomplete = F.exists(
        messages, lambda m: m.isNull() | m["role"].isNull() | m["content"].isNull()
    )
    return F.when(~incomplete, text)
