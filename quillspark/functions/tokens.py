"""Token-array expressions: word-level split, truncation, masks, labels, padding, budgets."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.chat import LLAMA3

IGNORED_LABEL = -100

# Tokens added for reference spans, reasoning and answers; the padding token tried
# before end-of-text; sequence limits of the three stages.
ADDED_TOKENS = [
    "<begin_of_ref>",
    "<end_of_ref>",
    "<think>",
    "</think>",
    "<answer>",
    "</answer>",
]
RIGHT_PAD_TOKEN = "<|finetune_right_pad_id|>"
END_OF_TEXT = "<|end_of_text|>"
CPT_MAX_TOKENS = 4096
SFT_MAX_TOKENS = 16384
PROMPT_MAX_TOKENS = 512
COMPLETION_MAX_TOKENS = 4096 - 512

SPECIAL_TOKENS = [*LLAMA3.special_tokens, END_OF_TEXT, RIGHT_PAD_TOKEN, *ADDED_TOKENS]


def word_pattern(special_tokens: Sequence[str] = tuple(SPECIAL_TOKENS)) -> str:
    """Regex whose matches tile the text into words, spaces, newlines and special tokens.

    Words never contain ``<``, so tokens that open with it are tried after the frequent cases.
    """
    longest_first = sorted(special_tokens, key=len, reverse=True)
    bracketed = [re.escape(t) for t in longest_first if t.startswith("<")]
    others = [re.escape(t) for t in longest_first if not t.startswith("<")]
    return "|".join([*others, r"[^ \n<]+", " ", r"\n\n", r"\n", *bracketed, "<"])


def words(text: Column, pattern: str | None = None) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern or word_pattern()), F.lit(0))


def model_tokens(
    text: Column, max_tokens: int | None, pattern: str | None = None, bos: str | None = None
) -> Column:
    """Words of a text, after a beginning token if one is given, up to a maximum if one is."""
    tokens = words(text, pattern)
    if bos is not None:
        tokens = F.concat(F.array(F.lit(bos)), tokens)
    return tokens if max_tokens is None else truncate(tokens, max_tokens)


def truncate(ids: Column, max_tokens: int) -> Column:
    """Keep the first tokens; overflow is dropped, never carried into another row."""
    return F.slice(ids, 1, max_tokens)


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def after_prompt(ids: Column, prompt_ids: Column) -> Column:
    """Generated part of a sequence that starts with its prompt."""
    return F.slice(ids, F.size(prompt_ids) + 1, F.size(ids))


def prompt_budget(ids: Column, max_tokens: int = PROMPT_MAX_TOKENS) -> Column:
    """Last tokens of a prompt."""
    return F.slice(ids, F.greatest(F.lit(1), F.size(ids) - (max_tokens - 1)), F.lit(max_tokens))


def completion_budget(ids: Column, max_tokens: int = COMPLETION_MAX_TOKENS) -> Column:
    return truncate(ids, max_tokens)


def causal_labels(ids: Column, pad_id: Column | int | None = None) -> Column:
    """Next-token labels of unpadded ids.

    Padding is marked by pad_row() from the real length. Passing ``pad_id`` hides every
    occurrence of that id as well, also a real end-of-text when it doubles as padding.
    """
    if pad_id is None:
        return ids
    pad = F.lit(pad_id)
    return F.transform(ids, lambda x: F.when(x == pad, IGNORED_LABEL).otherwise(x))


def response_labels(ids: Column, marker: Sequence[int]) -> Column:
    """Labels that ignore everything up to and including the last response marker.

    Rows without a marker are ignored throughout. Comparing the marker's first id before the
    others keeps the scan at one comparison for nearly all positions.
    """
    if not marker:
        raise ValueError("the response marker has no tokens")
    starts = F.filter(
        # a row shorter than the marker still gets the position 1, which cannot match
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(ids) - len(marker) + 1)),
        lambda at: _matches(ids, at, marker),
    )
    end = F.coalesce(F.array_max(starts) + (len(marker) - 1), F.size(ids))
    # a lambda over the ids would work out `end` again for every element
    return F.concat(F.array_repeat(F.lit(IGNORED_LABEL), end), F.slice(ids, end + 1, F.size(ids)))


def assistant_labels(ids: Column, marker: Sequence[int], end_id: int) -> Column:
    """Labels of all assistant turns: what follows a response marker, up to and including the next
    end-of-turn id or, where a row was cut before it, the end of the row. All else is ignored.

    Markers and ends are paired in one scan over a batch of rows, whatever the number of turns.
    """
    if not marker:
        raise ValueError("the response marker has no tokens")
    marker = list(marker)

    @F.arrow_udf("array<int>")
    def labels(rows: pa.Array) -> pa.Array:
        flat = rows.flatten().to_numpy(zero_copy_only=False)
        lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        found = np.ones(max(0, len(flat) - len(marker) + 1), bool)
        for place, token in enumerate(marker):
            found &= flat[place : place + len(found)] == token
        first = np.flatnonzero(found) + len(marker)
        row_end = bounds[np.searchsorted(bounds, first - len(marker), side="right")]
        first, row_end = first[first <= row_end], row_end[first <= row_end]
        ends = np.append(np.flatnonzero(flat == end_id) + 1, len(flat))
        stop = np.minimum(ends[np.searchsorted(ends, first, side="right").clip(max=len(ends) - 1)], row_end)
        change = np.zeros(len(flat) + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, stop, -1)
        kept = np.where(np.cumsum(change)[:-1] > 0, flat, IGNORED_LABEL).astype(np.int32)
        mask = rows.is_null() if rows.null_count else None
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(kept), mask=mask)

    return labels(ids)


def _matches(ids: Column, at: Column, marker: Sequence[int]) -> Column:
    found = F.get(ids, at - 1) == marker[0]
    for offset, token in enumerate(marker[1:]):
        found = found & (F.get(ids, at + offset) == token)
    return found


def supervised_tokens(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x != IGNORED_LABEL))


def pad_right(values: Column, fill: Column | int, length: Column | int) -> Column:
    """Right-pad (or cut) an array to a length."""
    length = F.lit(length)
    missing = F.greatest(length - F.size(values), F.lit(0))
    return F.concat(F.slice(values, F.lit(1), length), F.array_repeat(F.lit(fill), missing))


def pad_row(ids: Column, pad_id: Column | int, length: Column | int, labels: Column | None = None):
    """Padded ids, mask and (if given) labels of one row, as named columns."""
    padded = {
        "input_ids": pad_right(ids, pad_id, length),
        "attention_mask": pad_right(attention_mask(ids), 0, length),
    }
    if labels is not None:
        padded["labels"] = pad_right(labels, IGNORED_LABEL, length)
    return padded
