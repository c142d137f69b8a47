"""Token ids of whole texts through a tokenizer file, inside Arrow batches.

A tokenizer that drops white space treats every blank-separated word by itself. Then each word
is encoded once and remembered, which is several times as fast as encoding every text anew; any
other tokenizer gets whole texts. Both give the ids that the tokenizer gives for the whole text.
A Python worker keeps its encoder from task to task, so that common words are encoded once a worker.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quillspark.llm.words import plain_texts, split_words

#: Words that one Python worker remembers at most, and how many of them it keeps, those last met,
#: when there are more: both bound its memory.
REMEMBERED, KEPT = 400_000, 200_000
#: Longer words are encoded anew each time.
LONGEST = 64

#: ASCII marks other than quotes and the brackets of special strings.
_MARKS = r"!-&(-/:;=?@\[\\\]^_`{}~"
_PROBES = ["Words, and words.", "a-b", "it's 12 ß", "(", "The!!", " \t a\n\nb ", "don't", "Été, Übel"]


def _listed(words: pa.Array) -> list[str]:
    """Words, which hold no line ends, as a list, by way of one text."""
    if not len(words):
        return []
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")
    return lines[0].as_py().split("\n")


class Remembered:
    """Words and their ids, looked up a whole array at a time."""

    def __init__(self):
        self.words = pa.array([], pa.string())
        self.pool = np.empty(0, np.uint32)
        self.firsts, self.sizes, self.met = (np.empty(0, np.int64) for _ in range(3))
        self.time = 0

    def ids_of(self, words: pa.Array, encode) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids and, for each of the distinct words, its first place there and its size.
        ``encode`` gives the ids of a list of words that are not remembered."""
        self.time += 1
        found = pc.index_in(words, value_set=self.words)
        missing = found.is_null().to_numpy(zero_copy_only=False)
        place = pc.fill_null(found, 0).to_numpy()
        self.met[place[~missing]] = self.time
        new = words.filter(pa.array(missing))
        values = encode(_listed(new))
        sizes = np.fromiter(map(len, values), np.int64, len(values)) >> 2
        firsts = np.cumsum(sizes) - sizes + len(self.pool)
        pool = np.concatenate([self.pool, np.frombuffer(b"".join(values), np.uint32)])
        at, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        at[~missing], size[~missing] = self.firsts[place[~missing]], self.sizes[place[~missing]]
        at[missing], size[missing] = firsts, sizes
        self._add(new, pool, firsts, sizes)
        return pool, at, size

    def _add(self, new: pa.Array, pool: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> None:
        short = pc.binary_length(new).to_numpy() <= LONGEST
        self.words = pa.concat_arrays([self.words, new.filter(pa.array(short))])
        self.firsts = np.concatenate([self.firsts, firsts[short]])
        self.sizes = np.concatenate([self.sizes, sizes[short]])
        self.met = np.concatenate([self.met, np.full(int(short.sum()), self.time)])
        self.pool = pool
        if len(self.words) > REMEMBERED:
            kept = np.sort(np.argpartition(-self.met, KEPT)[:KEPT])
            self.words, self.met, sizes = self.words.take(pa.array(kept)), self.met[kept], self.sizes[kept]
            ends = np.cumsum(sizes)
            self.pool = pool[np.repeat(self.firsts[kept] - (ends - sizes), sizes) + np.arange(ends[-1])]
            self.firsts, self.sizes = ends - sizes, sizes


class TextEncoder:
    """Ids of Arrow string arrays. ``tokenizer`` is the content of a tokenizer file."""

    def __init__(self, tokenizer: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer)
        self.letters: dict[int, str] = {}
        self.marks: dict[str, list[int]] = {}
        self.words = Remembered()
        words = [w for p in _PROBES for w in p.split()]
        self.by_word = all(
            self._library([p])[0] == [i for ids in self._library(p.split()) for i in ids]
            for p in _PROBES
        )
        if self.by_word and self.tokenizer.pre_tokenizer and self.tokenizer.normalizer:
            self._tabulate_letters()
            if any(self._direct(w) not in (None, self._library([w])[0]) for w in words):
                self.letters = {}

    def _tabulate_letters(self) -> None:
        """What the tokenizer makes of single Latin letters before it merges them."""
        for code in range(0x41, 0x250):
            if not chr(code).isalpha():
                continue
            plain = self.tokenizer.normalizer.normalize_str(chr(code))
            parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)
            if len(plain) == 1 and len(parts) == 1:
                self.letters[code] = parts[0][0]
        known = "".join(map(chr, self.letters))
        self.pattern = re.compile(f"([{known}]+)([{_MARKS}]*)")

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _direct(self, word: str) -> list[int] | None:
        """Ids of a word of Latin letters and marks after them, from the merge model alone."""
        if not self.letters or not (found := self.pattern.fullmatch(word)):
            return None
        letters, marks = found.groups()
        merged = self.tokenizer.model.tokenize
        ids = [t.id for t in merged(letters.translate(self.letters))]
        if not marks:
            return ids
        if (tail := self.marks.get(marks)) is None:
            tail = [t.id for t in merged(marks)]
            if len(marks) < 4:
                self.marks[marks] = tail
        return ids + tail

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Little-endian ids of words."""
        found, others = [], []
        for i, word in enumerate(words):
            if (ids := self._direct(word)) is None:
                others.append(i)
                found.append(b"")
            else:
                found.append(array("I", ids).tobytes())
        for i, ids in zip(others, self._library([words[i] for i in others])):
            found[i] = array("I", ids).tobytes()
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and, for n texts, n + 1 offsets into them; null counts as empty."""
        if not self.by_word:
            rows = self._library(plain_texts(texts).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
            return np.array([i for r in rows for i in r], np.uint32), offsets
        words, places = split_words(texts)
        coded = words.dictionary_encode()
        pool, firsts, sizes = self.words.ids_of(coded.dictionary, self._ids_of)
        index = coded.indices.to_numpy()
        lengths = sizes[index]
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        flat = pool[np.repeat(firsts[index] - ends[:-1], lengths) + np.arange(ends[-1])]
        return flat, ends[places]

    def encode_with_end(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As encode, with ``end_id`` after the ids of every text."""
        flat, offsets = self.encode(texts)
        offsets = offsets + np.arange(len(offsets))
        inner = np.ones(offsets[-1], bool)
        inner[offsets[1:] - 1] = False
        closed = np.full(offsets[-1], end_id, np.uint32)
        closed[inner] = flat
        return closed, offsets


_encoders: dict[bytes, TextEncoder] = {}


def worker_encoder(tokenizer: bytes) -> TextEncoder:
    """The encoder of this Python worker, which goes on from task to task with what it remembers."""
    key = hashlib.blake2b(tokenizer).digest()
    if key not in _encoders:
        _encoders.clear()  # one tokenizer at a time
        _encoders[key] = TextEncoder(tokenizer)
    return _encoders[key]
