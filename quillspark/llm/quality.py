"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import operator
import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.words import SMALL_SLICE, giving_back, plain_texts, slices

# Fixed values of the base check.
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_marks",
    "n_letters",
    "n_upper",
    "n_bare",
    "n_stutter",
)
_MEASURED = "struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">"

GOOD, BAD = 1, -1


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of WINDOW words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    size = len(seen)
    if size < 6000:  # five ids fit in one exact 64-bit number
        keys = ids[:n].copy()
        for i in range(1, WINDOW):
            keys *= size
            keys += ids[i : i + n]
    else:
        keys = ids[:n]
        for i in range(1, WINDOW):
            keys = np.unique(keys * size + ids[i : i + n], return_inverse=True)[1]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


def _duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


_MARKS = string.punctuation.encode()
_WHITE = bytes([*range(9, 14), 32])


def _byte_classes() -> np.ndarray:
    """256 x 5: first bytes of characters outside white space, symbols, marks, letters, capitals.

    Every character beyond ASCII counts as a letter; capitals are those of ASCII.
    """
    table = np.zeros((256, 5), np.int64)
    table[:, 0] = [b not in _WHITE and b & 0xC0 != 0x80 for b in range(256)]
    table[list(SYMBOLS.encode()), 1] = 1
    table[list(_MARKS), 2] = 1
    table[list(string.ascii_letters.encode()), 3] = 1
    table[0xC0:, 3] = 1
    table[list(string.ascii_uppercase.encode()), 4] = 1
    return table


_CLASSES = _byte_classes()


def _measure(texts: pa.Array) -> pa.StructArray:
    """The measures of every text, null as empty."""
    rows = []
    for text in plain_texts(texts).cast(pa.binary()).to_pylist():
        words = text.split()
        classes = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES
        bare = sum(1 for w in words if len(w) < 4 and not w.strip(_MARKS))
        stutter = sum(map(operator.eq, words, words[1:]))
        lines, repeated = _duplicate_lines(text), _repeated(words)
        rows.append((len(words), *classes[:2], lines, repeated, *classes[2:], bare, stutter))
    columns = np.array(rows, np.int64).reshape(len(rows), len(MEASURES))
    return pa.StructArray.from_arrays([pa.array(c) for c in columns.T.copy()], list(MEASURES))


def measures(text: Column) -> Column:
    """Struct of MEASURES over the whole text; a null text counts as empty."""

    @F.arrow_udf(_MEASURED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in giving_back(batches):
            parts = [_measure(texts.slice(a, b - a)) for a, b in slices(texts, SMALL_SLICE)]
            empty = pa.array([], pa.struct([(m, pa.int64()) for m in MEASURES]))
            yield pa.concat_arrays(parts) if parts else empty

    return run(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (
        m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEATED_PERCENT
    )


@dataclass(frozen=True)
class Rule:
    """Votes BAD at or beyond ``bad``, GOOD up to ``good``, else abstains; ``value`` is a share
    that is null (abstention) where it is not defined."""

    name: str
    good: float
    bad: float
    value: str

    def vote(self, m: Column) -> Column:
        share = _SHARES[self.value](m)
        return (
            F.when(share >= self.bad, F.lit(BAD))
            .when(share <= self.good, F.lit(GOOD))
            .otherwise(F.lit(0))
        )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


_SHARES = {
    "shortness": lambda m: F.lit(1.0) / (m["n_words"] + 1),
    "symbols": lambda m: _share(m["n_symbols"], m["n_words"]),
    "repeats": lambda m: _share(m["n_repeat_words"], m["n_words"]),
    "lines": lambda m: _share(m["n_dup_lines"], m["n_words"]),
    "long words": lambda m: _share(m["word_chars"], m["n_words"]),
    "marks": lambda m: _share(m["n_marks"], m["word_chars"]),
    "stutter": lambda m: _share(m["n_stutter"], m["n_words"]),
    "bare words": lambda m: _share(m["n_bare"], m["n_words"]),
    "capitals": lambda m: _share(m["n_upper"], m["n_letters"]),
}

RULES = (
    Rule("length", 1 / 21, 1 / 11, "shortness"),
    Rule("symbols", 0.05, 0.3, "symbols"),
    Rule("repeats", 0.05, 0.2, "repeats"),
    Rule("lines", 0.005, 0.03, "lines"),
    Rule("words", 9.0, 14.0, "long words"),
    Rule("marks", 0.07, 0.12, "marks"),
    Rule("stutter", 0.05, 0.2, "stutter"),
    Rule("separators", 0.05, 0.15, "bare words"),
    Rule("capitals", 0.2, 0.5, "capitals"),
)


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and for each rule the chances of voting good and bad given a
    good and given a bad document (the rest abstains)."""

    prior: float
    chances: tuple[tuple[tuple[float, float], tuple[float, float]], ...]

    def posterior(self, votes: Sequence[int]) -> float:
        """Chance of a good document; the prior if every rule abstains with equal chances."""
        odds = np.log(self.prior) - np.log1p(-self.prior)
        for vote, (good, bad) in zip(votes, self.chances):
            odds += np.log(_chance(good, vote)) - np.log(_chance(bad, vote))
        return float(1 / (1 + np.exp(-np.clip(odds, -50, 50))))


def _chance(pair: tuple[float, float], vote: int) -> float:
    return pair[0] if vote == GOOD else pair[1] if vote == BAD else 1 - pair[0] - pair[1]


def fit_votes(
    counts: dict[tuple[int, ...], int], n_rules: int, rounds: int = 200, prior: float = 0.9
) -> LabelModel:
    """Expectation-maximisation over vote patterns and their numbers of documents.

    Every rule starts as a detector of one kind of junk: it seldom votes bad on a good document,
    and often votes good on junk of another kind. Pseudo counts of that start keep the two
    classes from changing places and every chance off 0 and 1. No documents at all give the
    start itself.
    """
    patterns = np.array(sorted(counts), np.int64).reshape(len(counts), n_rules)
    weights = np.array([counts[tuple(p)] for p in patterns.tolist()], float)
    total = weights.sum()
    start_good, start_bad = np.tile([0.8, 0.03], (n_rules, 1)), np.tile([0.5, 0.35], (n_rules, 1))
    good, bad, pseudo = start_good, start_bad, 1 + 0.005 * total
    voted_good, voted_bad = patterns == GOOD, patterns == BAD
    silent = patterns == 0
    for _ in range(rounds):
        def log_chance(c: np.ndarray) -> np.ndarray:
            rest = 1 - c.sum(axis=1)
            return voted_good @ np.log(c[:, 0]) + voted_bad @ np.log(c[:, 1]) + silent @ np.log(rest)

        odds = np.log(prior / (1 - prior)) + log_chance(good) - log_chance(bad)
        belief = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        mass, other = weights * belief, weights * (1 - belief)

        def update(m: np.ndarray, start: np.ndarray) -> np.ndarray:
            votes = np.stack([m @ voted_good, m @ voted_bad], axis=1)
            return (votes + pseudo * start) / (m.sum() + pseudo)

        good, bad = update(mass, start_good), update(other, start_bad)
        moved = (mass.sum() + 0.9 * pseudo) / (total + pseudo)
        done, prior = abs(moved - prior) < 1e-9, moved
        if done:
            break
    pairs = tuple((tuple(map(float, g)), tuple(map(float, b))) for g, b in zip(good, bad))
    return LabelModel(float(prior), pairs)


def fit_rules(rows: DataFrame, m: str, rules: Sequence[Rule] = RULES) -> LabelModel:
    """Label model over the rows of ``rows`` whose measures, in column ``m``, pass the base check.

    Documents that fail it are gone whatever the rules say; left in, they would make up the bad
    class alone and hide the junk that only the rules see.

    Counted per vote pattern before the shuffle; at most 3 ** len(rules) patterns come to the
    driver, whatever the number of documents.
    """
    votes = F.array(*[r.vote(F.col(m)).cast("int") for r in rules])
    passed = rows.where(~base_failed(F.col(m)))
    counted = passed.groupBy(votes.alias("votes")).agg(F.count(F.lit(1)).alias("n")).collect()
    return fit_votes({tuple(r.votes): r.n for r in counted}, len(rules))


def quality(m: Column, model: LabelModel, rules: Sequence[Rule] = RULES) -> Column:
    """Posterior probability of a good document, from the log odds that each vote adds."""
    odds = F.lit(float(np.log(model.prior) - np.log1p(-model.prior)))
    for rule, (good, bad) in zip(rules, model.chances):
        gain = {v: float(np.log(_chance(good, v)) - np.log(_chance(bad, v))) for v in (GOOD, BAD, 0)}
        vote = rule.vote(m)
        odds = odds + F.when(vote == GOOD, gain[GOOD]).when(vote == BAD, gain[BAD]).otherwise(gain[0])
    return 1 / (1 + F.exp(-odds))


def judge(rows: DataFrame, m: str, model: LabelModel, threshold: float = 0.5) -> DataFrame:
    """Add MEASURES, ``base_failed``, ``quality`` and ``kept`` to rows that have measures ``m``.

    Every row gets a verdict: null and empty texts fail the base check. Repeated rows get equal
    verdicts. Input columns of the added names are replaced. Whole texts of any length count.
    """
    added = {*MEASURES, "base_failed", "quality", "kept"}
    column = F.col(m)
    failed = base_failed(column)
    score = quality(column, model)
    return rows.select(
        *[c for c in rows.columns if c != m and c not in added],
        *[column[name].alias(name) for name in MEASURES],
        failed.alias("base_failed"),
        score.alias("quality"),
        (~failed & (score >= threshold)).alias("kept"),
    )


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that pass the base check and the label model, columns unchanged.

    The texts are measured twice, for the model and for the verdict, so that nothing is
    shuffled or stored. An empty table stays empty. Columns of any name are kept.
    """
    name = "_measures"
    while name in docs.columns:
        name += "_"
    model = fit_rules(docs.select(measures(F.col("text")).alias("m")), "m")
    m = measures(F.col("text"))
    taken = docs.withColumn(name, m)
    column = F.col(name)
    verdict = ~base_failed(column) & (quality(column, model) >= threshold)
    return taken.where(verdict).drop(name)
