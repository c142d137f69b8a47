"""Rule-based rewards for model completions, as narrow column expressions."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import WHITESPACE_CLASS, last_piece, occurs_once, strip

# Patterns and weights of the scoring rules. (?d) makes "." and "$" see "\n" as the
# only line end, and \A ties the match to the start of the text.
SOFT_FORMAT = rf"(?d)\A<think>.*?</think>{WHITESPACE_CLASS}*<answer>.*?</answer>"
STRICT_FORMAT = r"(?d)\A<think>\n.*?\n</think>\n<answer>\n.*?\n</answer>\n$"
FORMAT_REWARD = 0.5
NUMERIC_REWARD = 0.5
CORRECT_REWARD = 2.0
TAG_REWARD = 0.125
TRAILING_PENALTY = 0.001

# Decimal floating-point literal: digits of any script, single underscores between digits, or
# inf/nan. The quantifiers are possessive, so long digit runs cannot exhaust the regex stack.
_DIGITS = r"\p{Nd}++(?:_\p{Nd}++)*+"
FLOAT_LITERAL = (
    rf"\A(?i:[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf(?:inity)?|nan))\z"
)


def completion_text(completions: Column) -> Column:
    """Content of the first message; only that one is scored."""
    return F.get(completions, F.lit(0))["content"]


def extract_xml_answer(text: Column) -> Column:
    """Stripped text after the last ``<answer>`` and before the next ``</answer>``.

    Neither tag can overlap itself, so byte-level substring_index is exact here.
    """
    tail = F.substring_index(text, "<answer>", -1)
    return strip(F.substring_index(tail, "</answer>", 1))


def extract_hash_answer(text: Column) -> Column:
    """Stripped piece between the first and second ``####``; null without a marker."""
    return strip(F.get(F.split(text, "####", 3), F.lit(1)))


def is_numeric(text: Column) -> Column:
    return strip(F.replace(text, F.lit(","), F.lit(""))).rlike(FLOAT_LITERAL)


@lru_cache(maxsize=1)
def _digit_class() -> str:
    """Regex class of every character that counts as a digit, superscripts included."""
    points = [c for c in range(0x110000) if chr(c).isdigit()]
    runs: list[list[int]] = []
    for c in points:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


def is_digits(text: Column) -> Column:
    return text.rlike(rf"\A{_digit_class()}+\z")


def xml_score(text: Column) -> Column:
    """Tag presence score minus a per-character penalty for text after the closing tag.

    Each of four tag forms earns its share when it occurs exactly once. The answer-opening form
    is charged for everything after the last closed answer line (the whole text if there is
    none), the answer-closing form for what follows it beyond one character.
    """
    once = {
        tag: occurs_once(text, tag)
        for tag in ("<think>\n", "\n</think>\n", "\n<answer>\n", "\n</answer>")
    }
    after_line = F.length(last_piece(text, "\n</answer>\n"))
    after_tag = F.length(F.substring_index(text, "\n</answer>", -1)) - 1
    credit = F.lit(TAG_REWARD)
    zero = F.lit(0.0)
    penalty = F.lit(TRAILING_PENALTY)
    return (
        F.when(once["<think>\n"], credit).otherwise(zero)
        + F.when(once["\n</think>\n"], credit).otherwise(zero)
        + F.when(once["\n<answer>\n"], credit - after_line * penalty).otherwise(zero)
        + F.when(once["\n</answer>"], credit - after_tag * penalty).otherwise(zero)
    )


# Rewards proper. Parameters are bound by name: ``prompts`` and ``completions`` are the
# conversation columns, any other name is a column of the rollout table.


def xmlcount_reward(completions: Column) -> Column:
    return xml_score(completion_text(completions))


def soft_format_reward(completions: Column) -> Column:
    matched = completion_text(completions).rlike(SOFT_FORMAT)
    return F.when(matched, FORMAT_REWARD).otherwise(0.0)


def strict_format_reward(completions: Column) -> Column:
    matched = completion_text(completions).rlike(STRICT_FORMAT)
    return F.when(matched, FORMAT_REWARD).otherwise(0.0)


def numeric_reward(completions: Column) -> Column:
    answer = extract_xml_answer(completion_text(completions))
    return F.when(is_numeric(answer), NUMERIC_REWARD).otherwise(0.0)


def digits_reward(completions: Column) -> Column:
    """Stricter variant of the numeric reward: digits only."""
    answer = extract_xml_answer(completion_text(completions))
    return F.when(is_digits(answer), NUMERIC_REWARD).otherwise(0.0)


def correctness_reward(completions: Column, answer: Column) -> Column:
    same = extract_xml_answer(completion_text(completions)) == answer
    return F.when(same, CORRECT_REWARD).otherwise(0.0)


REWARDS = {
    "xmlcount": xmlcount_reward,
    "soft_format": soft_format_reward,
    "strict_format": strict_format_reward,
    "numeric": numeric_reward,
    "correctness": correctness_reward,
}
