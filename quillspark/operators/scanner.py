"""Registered tokens in texts, any number of them at the cost of one pass over the text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SEGMENTS = "array<struct<text: string, token: boolean>>"


class TokenScanner:
    """Splits texts at tokens: of those that begin first, the longest; then on after its end."""

    def __init__(self, tokens: Sequence[str]):
        self.automaton = ahocorasick.Automaton()
        for token in tokens:
            self.automaton.add_word(token, len(token))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Where tokens stand, from left to right."""
        # ends only rise, so the last token at a start is its longest
        found = {end - size + 1: end + 1 for end, size in self.automaton.iter(text)}
        chosen, at = [], 0
        for start in sorted(found):
            if start >= at:
                at = found[start]
                chosen.append((start, at))
        return chosen

    def split(self, text: str) -> list[tuple[str, bool]]:
        """The text in pieces, each a token or what stands between two."""
        pieces, at = [], 0
        for start, end in self.spans(text):
            if start > at:
                pieces.append((text[at:start], False))
            pieces.append((text[start:end], True))
            at = end
        if at < len(text):
            pieces.append((text[at:], False))
        return pieces


    def words(self, text: str, between: Callable[[str], list[str]]) -> list[str]:
        """The tokens, and what ``between`` makes of what stands between two."""
        out, at = [], 0
        for start, end in self.spans(text):
            if start > at:
                out += between(text[at:start])
            out.append(text[start:end])
            at = end
        if at < len(text):
            out += between(text[at:])
        return out


def registered_words(
    spark: SparkSession,
    tokens: Sequence[str],
    pattern: str,
    bos: str | None = None,
    max_tokens: int | None = None,
    convert: Callable[[pa.Array], pa.Array] | None = None,
    kind: str = "array<string>",
) -> Callable[[Column], Column]:
    """Expression for the words of a text where tokens are registered, in one pass; null stays null.

    As split_registered and then all matches of ``pattern`` in what stands between the tokens. The
    pattern must mean the same to Python's re as to Java's, as that of word_pattern does. ``bos``
    stands before them, if one is given, and only the first ``max_tokens`` are kept. ``convert``
    makes something else (of type ``kind``) of the lists, so that words never leave the worker.

    Rows go back as they are done, so that a task holds the words of WORDS_BYTES and not of a batch.
    """
    shared = spark.sparkContext.broadcast(list(dict.fromkeys(tokens)))
    first = [] if bos is None else [bos]

    @F.arrow_udf(kind)
    def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner, between = TokenScanner(shared.value), re.compile(pattern).findall
        for batch in batches:
            for start, end in _row_cuts(batch, WORDS_BYTES):
                found = [
                    None if t is None else (first + scanner.words(t, between))[:max_tokens]
                    for t in batch.slice(start, end - start).to_pylist()
                ]
                lists = pa.array(found, pa.list_(pa.string()))
                del found
                yield lists if convert is None else convert(lists)
            pa.default_memory_pool().release_unused()

    return words


#: Bytes of the texts whose words are Python strings at once.
WORDS_BYTES = 1_000_000


def _row_cuts(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows of at most ``size`` bytes; a text is never cut."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + size, side="right")) - 1)
        yield start, end
        start = end


def split_registered(spark: SparkSession, tokens: Sequence[str]) -> Callable[[Column], Column]:
    """Expression that splits a text at tokens into (text, token or not); null stays null.

    The tokens are a list the driver holds anyway; each task builds its automaton once.
    """
    shared = spark.sparkContext.broadcast(list(dict.fromkeys(tokens)))
    built: list[TokenScanner] = []

    @F.arrow_udf(SEGMENTS)
    def split(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(TokenScanner(shared.value))
        offsets, pieces, tokens = [0], [], []
        for text in texts.to_pylist():
            for piece, is_token in built[0].split(text) if text is not None else ():
                pieces.append(piece)
                tokens.append(is_token)
            offsets.append(len(pieces))
        columns = [pa.array(pieces, pa.string()), pa.array(tokens, pa.bool_())]
        rows = pa.StructArray.from_arrays(columns, ["text", "token"])
        mask = texts.is_null() if texts.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows, mask=mask)

    return split
