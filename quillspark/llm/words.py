"""Words of whole texts in Arrow batches, and hashes over them."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: A word, as a regular expression of both Java and RE2.
WORD = r"[^\x20\x09-\x0D]+"

#: Text handled at once inside a task; one longer text is handled alone.
SLICE_BYTES = 4 << 20
#: The same where several arrays of 64-bit numbers are made of each word.
SMALL_SLICE = 1 << 20


_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def giving_back(items: Iterator, each: bool = False) -> Iterator:
    """The items; when they are through, unused memory goes back to the system, with ``each``
    also after every item.

    Python workers live on, and the stages that follow share their executor's memory with them.
    """
    try:
        for item in items:
            yield item
            if each:
                _give_back()
    finally:
        _give_back()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    _trim(0)


def plain_texts(texts: pa.Array) -> pa.Array:
    """The strings with null as empty."""
    return pc.fill_null(texts, "")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (start, stop) of about ``limit`` bytes of text each, covering every row."""
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(plain_texts(texts)).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


def parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about SLICE_BYTES of text in ``column``, without a copy."""
    for batch in batches:
        texts = batch.column(column)
        for start, stop in slices(texts):
            yield batch.slice(start, stop - start)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order and, for n texts, their n + 1 offsets."""
    lists = pc.ascii_split_whitespace(plain_texts(texts))
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), before[offsets]


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of every word; each distinct word is hashed once."""
    coded = words.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    known = np.fromiter(
        (digest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary)
    )
    return known[coded.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def list_array(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


#: A-Z to a-z, byte by byte; no byte of a longer UTF-8 character is among them.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


def byte_kinds(separators: bytes, breaks: bytes = b"") -> np.ndarray:
    """Kind of every byte for cut_words: 0 in words, 1 between them, 2 also between pieces."""
    kinds = np.zeros(256, np.uint8)
    kinds[np.frombuffer(separators, np.uint8)] = 1
    kinds[np.frombuffer(breaks, np.uint8)] = 2
    return kinds


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts one after the other and, for n texts, their n + 1 offsets."""
    texts = plain_texts(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    held = texts.buffers()[2]
    data = np.empty(0, np.uint8) if held is None else np.frombuffer(held, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def cut_words(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts with A-Z lower-cased, cut at ASCII bytes by their kind.

    Gives the words, for n texts n + 1 offsets into them, and whether each word continues the
    piece of the word before it.
    """
    data, offsets = text_bytes(texts)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(offsets), np.int64), np.zeros(0, bool)
    kind = kinds[data]
    inside = kind == 0
    edge = np.zeros(len(data) + 1, bool)  # between two texts
    edge[offsets] = True
    before, after = np.roll(inside, 1), np.roll(inside, -1)
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    letters = _LOWERED[data[inside]]
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(letters))
    firsts = np.searchsorted(starts, offsets)
    pieces = np.searchsorted(np.flatnonzero(kind == 2), starts)
    continues = np.concatenate([[False], pieces[1:] == pieces[:-1]])[: len(starts)]
    continues[firsts[:-1][firsts[:-1] < len(starts)]] = False
    return words, firsts, continues
