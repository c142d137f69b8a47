"""Token counts by heap-and-linked-list byte-pair merging over a sentencepiece vocabulary.

The count of a word is its number of symbols minus its merges; no ids are formed. Merge order
and vocabulary come from the model file, whose own encoder is only used in tests.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.words import slices

#: Fixed value: the sign that stands for a blank in the vocabulary.
BLANK = "▁"

#: Words remembered by one Python worker, which bounds its memory.
REMEMBERED = 500_000


class MergeCounter:
    """Counts tokens of texts. ``model`` is the content of a model file of the kind BPE with
    byte fallback that keeps its input as it is, adds a blank before it and has no piece with a
    blank inside; other models are refused."""

    def __init__(self, model: bytes, remembered: int = REMEMBERED):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        probe = " a  ﬁ\tB\n "
        if pieces.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("the model changes its input beyond a leading blank")
        usual = [
            i
            for i in range(pieces.get_piece_size())
            if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))
        ]
        self.scores = {pieces.id_to_piece(i): pieces.get_score(i) for i in usual}
        if any(BLANK in p.lstrip(BLANK) for p in self.scores):
            raise ValueError("a piece continues over a blank")
        merged = {c for p in self.scores if len(p) > 1 for c in p}
        # a character outside every longer piece never merges: words end there, too
        apart = "".join(c for c in "\n\t\r\v\f" if c not in merged)
        self.word = re.compile(f"[{apart}]|{BLANK}*[^{BLANK}{apart}]+|{BLANK}+")
        self.remembered = remembered
        self.known: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        """Pop the best adjacent pair (highest score, then leftmost) until none is a piece."""
        scores, n = self.scores, len(word)
        text, before, after = list(word), list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            pair = text[left] + text[right]
            if (score := scores.get(pair)) is not None:
                heapq.heappush(heap, (-score, left, right, pair))

        for i in range(n - 1):
            offer(i, i + 1)
        merges = 0
        while heap:
            _, left, right, pair = heapq.heappop(heap)
            if not text[left] or not text[right] or after[left] != right:
                continue
            if text[left] + text[right] != pair:
                continue
            merges += 1
            text[left], text[right] = pair, ""
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                offer(left, following)
            if before[left] >= 0:
                offer(before[left], left)
        # symbols that are no piece are single characters, spelled in bytes
        spelled = sum(len(s.encode()) - 1 for s in text if s and s not in scores)
        return n - merges + spelled

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = self.word.findall(BLANK + text.replace(" ", BLANK))
        known = self.known
        try:
            return sum([known[w] for w in words])
        except KeyError:
            pass
        total = 0
        for word in words:
            if (n := known.get(word)) is None:
                n = self.count_word(word)
                if len(known) >= self.remembered:
                    known.clear()
                if len(word) <= 64:
                    known[word] = n
            total += n
        return total


def count_tokens(docs: DataFrame, model: bytes, limit: int = 4096) -> DataFrame:
    """One row (doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    A null or empty text has no bytes and no tokens. Repeated rows and null ids each give their
    row; an empty table gives none. Other columns of ``docs`` are not read. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = MergeCounter(shared.value)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            counts = np.zeros(len(texts), np.int64)
            for start, stop in slices(texts):
                rows = texts.slice(start, stop - start).to_pylist()
                counts[start:stop] = [counter.count(t) for t in rows]
            sizes = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(counts), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
