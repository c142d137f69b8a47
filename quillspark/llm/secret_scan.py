"""Secrets in texts: rules as regular expressions, found through a trigram inverted index.

Each rule's expression yields a Boolean query of trigrams that any match must hold. Tasks index the
trigrams that some rule asks for, slice by slice, answer the queries from the posting lists and run
the expressions over the documents that remain. Rules without a mandatory trigram scan all texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from re import _constants as ops
from re import _parser as parser

from quillspark.llm.words import _LOWERED, plain_texts, slices, text_bytes

#: Strings that a part of an expression may stand for before a query no longer tells them apart.
MOST_STRINGS = 64

#: A conjunction of disjunctions of conjunctions: for every piece of an expression, one of its
#: strings has to occur, that is all trigrams of it.
Query = list[list[frozenset[int]]]


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    Patterns are read alike by Python, Java and RE2, so no flags: letters in either case are
    classes.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @cached_property
    def query(self) -> Query | None:
        """Trigrams that every match holds; None if there are none."""
        return trigram_query(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost matches that do not overlap; short ones are dropped after that."""
        found = re.finditer(self.pattern, text)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


_KEYS = "|".join(map(any_case, ["password", "passwd", "secret", "token"]))
_KEYS += f"|{any_case('api')}_?{any_case('key')}"

# The three base rules. Runs of 32 hexadecimal digits are matched as such, which are
# the matches of [0-9a-f]+ with 32 characters or more.
BASE_RULES = [
    Rule("assign", rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]{32,}", 0, 32),
]
# Published forms of further credentials.
MORE_RULES = [
    Rule("private_key", "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login_url", r"://[A-Za-z0-9._~%-]{1,64}:[A-Za-z0-9._~%!$&*+=-]{1,64}@"),
]
RULES = BASE_RULES + MORE_RULES


def trigrams(text: str) -> frozenset[int]:
    """Trigrams of a string's bytes with A-Z lower-cased, as numbers."""
    b = _LOWERED[np.frombuffer(text.encode(), np.uint8)].astype(int)
    return frozenset((b[:-2] << 16 | b[1:-1] << 8 | b[2:]).tolist())


def trigram_query(pattern: str) -> Query | None:
    """The Boolean query of an expression, or None if matches need not hold any trigram."""
    runs = _runs(parser.parse(pattern))
    query = [[trigrams(s) for s in sorted(run)] for run in runs if run and all(len(s.encode()) > 2 for s in run)]
    return query or None


def _runs(parts) -> list[set[str]]:
    """Sets of lower-cased strings: a match holds a string of each, in this order."""
    runs, now = [], {""}
    for op, value in parts:
        strings = _strings(op, value)
        if strings is None:  # nothing is known of this part but what must stand inside
            runs.append(now)
            if op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and value[0] > 0:
                runs += _runs(value[2])
            elif op is ops.SUBPATTERN:
                runs += _runs(value[3])
            now = {""}
        elif len(now) * len(strings) > MOST_STRINGS:
            runs.append(now)
            now = strings
        else:
            now = {a + b for a, b in product(now, strings)}
    return [*runs, now]


def _strings(op, value) -> set[str] | None:
    """All strings that a part matches, lower-cased; None if they are too many or unknown."""
    if op is ops.LITERAL:
        return {chr(value).lower() if value < 128 else chr(value)}
    if op is ops.IN:
        return _members(value)
    if op is ops.BRANCH:
        found = [_sequence(branch) for branch in value[1]]
        return None if None in found else _bounded(set().union(*found))
    if op is ops.SUBPATTERN:
        return _sequence(value[3])
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
        least, most, inner = value
        once = _sequence(inner)
        if once is None or most is parser.MAXREPEAT or most > 8:
            return None
        powers = [{"".join(p) for p in product(once, repeat=n)} for n in range(least, most + 1) if len(once) ** n <= MOST_STRINGS]
        return _bounded(set().union(*powers)) if len(powers) == most - least + 1 else None
    return {""} if op is ops.AT else None


def _members(value) -> set[str] | None:
    found: set[str] = set()
    for op, member in value:
        if op is ops.LITERAL:
            found |= _strings(op, member)
        elif op is ops.RANGE and member[1] - member[0] < MOST_STRINGS:
            found |= set().union(*(_strings(ops.LITERAL, c) for c in range(member[0], member[1] + 1)))
        else:
            return None
    return _bounded(found)


def _sequence(parts) -> set[str] | None:
    found = {""}
    for op, value in parts:
        strings = _strings(op, value)
        if strings is None or len(found) * len(strings) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, strings)}
    return found


def _bounded(strings: set[str]) -> set[str] | None:
    return strings if len(strings) <= MOST_STRINGS else None


class TrigramIndex:
    """Posting lists of the wanted trigrams over the texts of a slice."""

    def __init__(self, texts: pa.Array, wanted: np.ndarray):
        """``wanted`` says for every trigram whether it is indexed."""
        data, offsets = text_bytes(texts)
        self.size, self.postings = len(texts), {}
        if len(data) < 3:
            return
        b = _LOWERED[data].astype(np.int32)
        codes = b[:-2] << 16
        codes |= b[1:-1] << 8
        codes |= b[2:]
        places = np.flatnonzero(wanted[codes])
        owners = np.searchsorted(offsets, places, side="right") - 1
        inside = places + 3 <= offsets[owners + 1]
        codes, owners = codes[places[inside]].astype(np.int64), owners[inside]
        pairs = np.unique(codes * self.size + owners)
        keys, starts = np.unique(pairs // self.size, return_index=True)
        self.postings = dict(zip(keys.tolist(), np.split(pairs % self.size, starts[1:])))

    def _all_of(self, grams: frozenset[int]) -> np.ndarray:
        lists = sorted((self.postings.get(g, _NONE) for g in grams), key=len)
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), lists)

    def candidates(self, query: Query | None) -> np.ndarray:
        """Documents that may match, ascending; all if there is no query."""
        if query is None:
            return np.arange(self.size)
        found = [reduce(np.union1d, map(self._all_of, run)) for run in query]
        return reduce(np.intersect1d, found)


_NONE = np.empty(0, np.int64)


def wanted_trigrams(rules: list[Rule]) -> np.ndarray:
    wanted = np.zeros(1 << 24, bool)
    for rule in rules:
        for run in rule.query or []:
            for grams in run:
                wanted[list(grams)] = True
    return wanted


def scan(texts: pa.Array, rules: list[Rule], wanted: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """By document, the spans found: (start, number of the rule, end) in code points, sorted."""
    texts = plain_texts(texts)
    index = TrigramIndex(texts, wanted)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for number, rule in enumerate(rules):
        rows = index.candidates(rule.query)
        if rule.query is None:  # a full scan, in Arrow
            rows = rows[pc.match_substring_regex(texts, rule.pattern).to_numpy(zero_copy_only=False)]
        for row, text in zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist()):
            for start, end in rule.spans(text):
                found.setdefault(row, []).append((start, number, end))
    return {row: sorted(spans) for row, spans in found.items()}


def _listed(spans: list[tuple[int, int, int]], rules: list[Rule]) -> str:
    return ",".join(f"{rules[number].kind}:{start}:{end}" for start, number, end in spans)


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """Secrets of every whole text: doc_id, a count n_<kind> for each of the first ``base`` rules,
    ``base_sha256`` of their spans and ``spans`` of all rules.

    A span reads kind:start:end in code points, end exclusive; spans go by start, then by the order
    of the rules, joined by commas. Null and empty texts have none, and base_sha256 is that of the
    empty string. Rows stay as they are, repeated and null ids too; an empty table gives no rows;
    other columns than doc_id and text are not read. No shuffle.
    """
    counts = [f"n_{rule.kind}" for rule in rules[:base]]
    schema = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in counts], "base_sha256 string", "spans string"])
    shared = docs.sparkSession.sparkContext.broadcast(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = shared.value
        wanted = wanted_trigrams(rules)
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                size = stop - start
                numbers = np.zeros((base, size), np.int64)
                digests, spans = [nothing] * size, [""] * size
                for row, found in scan(batch.column(1).slice(start, size), rules, wanted).items():
                    first = [s for s in found if s[1] < base]
                    for _, number, _ in first:
                        numbers[number, row] += 1
                    digests[row] = hashlib.sha256(_listed(first, rules).encode()).hexdigest()
                    spans[row] = _listed(found, rules)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, size),
                        *[pa.array(n) for n in numbers],
                        pa.array(digests, pa.string()),
                        pa.array(spans, pa.string()),
                    ],
                    ["doc_id", *counts, "base_sha256", "spans"],
                )

    return docs.select(docs["doc_id"].cast("bigint"), "text").mapInArrow(run, schema)
