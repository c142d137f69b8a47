"""Toxicity by a weighted lexicon, matched with Aho-Corasick in folded text.

The lexicon is learnt from labelled documents: beginnings of words that toxic documents hold far
more often than others, and phrases around them that clear documents hold (exceptions). A text's
score is the weight of its matches outside exceptions, against its length, calibrated to 0..1.

A lexicon whose automata fit SHIPPED_CHARACTERS goes to the driver and the tasks. A larger one stays
in tables: the automaton then holds its terms cut as short as fits, and the words that it finds are
joined with the terms and the exceptions. Both give the same scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.sampling import first_rows, hash_sample
from quillspark.llm.words import SMALL_SLICE, plain_texts, slices
from quillspark.session import store

# Letters of other scripts that look like Latin ones, and signs used for letters.
HOMOGLYPHS = {
    # Cyrillic
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ɡ": "g", "һ": "h", "н": "h",
    "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q",
    "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M",
    "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    # Greek
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_ZERO_WIDTH = "​‌‍⁠﻿­"

_LOOKALIKE = str.maketrans({**HOMOGLYPHS, **{c: None for c in _ZERO_WIDTH}})
_SIGNS = str.maketrans(SUBSTITUTES)
_MIXED = re.compile(r"\S*[013457@$]\S*")
_OTHER = re.compile(r"[\W_]+")
_FULL_WIDTH = {code: code - 0xFEE0 for code in range(0xFF01, 0xFF5F)}
_LOOKALIKE.update(_FULL_WIDTH)

#: Lengths of the beginnings of words that the lexicon is drawn from.
SHORTEST, LONGEST = 4, 12
#: Characters of terms and exceptions, so nodes of automata, that go to the driver and to every
#: worker: some 50 MB there.
SHIPPED_CHARACTERS = 1_000_000


def _resolve(match: re.Match) -> str:
    word = match[0]
    inner = word.rstrip("$@!?.,;:")  # signs after a word are no letters of it
    if not any(c.isalpha() for c in inner):
        return word
    return inner.translate(_SIGNS) + word[len(inner) :]


def fold(text: str) -> str:
    """Lower case, look-alikes and digits as letters, all else as single blanks at both ends."""
    text = text.translate(_LOOKALIKE) if not text.isascii() else text
    text = _MIXED.sub(_resolve, text).lower()
    return " " + _OTHER.sub(" ", text).strip() + " "


def beginnings(words: set[str]) -> set[str]:
    """Beginnings of SHORTEST to LONGEST letters; shorter words whole, with a closing blank."""
    found = {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
    return found | {w + " " for w in words if len(w) < SHORTEST}


@dataclass
class Lexicon:
    """Weights of beginnings of words, exception phrases and the calibration of scores."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    bias: float = -3.0
    slopes: tuple[float, float] = (1.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(" " + term, (term, weight))
        found.make_automaton()
        return found

    def exception_automaton(self) -> ahocorasick.Automaton | None:
        if not self.exceptions:
            return None
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", len(phrase) + 2)
        found.make_automaton()
        return found


@dataclass
class StoredLexicon:
    """A lexicon in tables: terms (term, gain), exceptions (term), and beginnings of all terms."""

    coarse: Lexicon
    terms: DataFrame
    exceptions: DataFrame
    bias: float = -3.0
    slopes: tuple[float, float] = (1.0, 0.0)


def matches(folded: str, terms: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """(start of the word, end of the match, weight); of terms at one word, the longest."""
    best: dict[int, tuple[int, float]] = {}
    if len(terms):
        for end, (term, weight) in terms.iter(folded):
            best[end - len(term) + 1] = (end + 1, weight)
    return [(start, end, weight) for start, (end, weight) in best.items()]


def weigh(folded: str, terms: ahocorasick.Automaton, exceptions: ahocorasick.Automaton | None) -> float:
    """Weight of all matches outside exception phrases."""
    found = matches(folded, terms)
    if not found or exceptions is None:
        return sum(w for _, _, w in found)
    spans = [(end - size + 2, end) for end, size in exceptions.iter(folded)]
    return sum(w for s, _, w in found if not any(a <= s < b for a, b in spans))


def around(folded: str, start: int) -> tuple[str, str, str]:
    """The word before, the word at ``start`` and the one after it; empty where there is none."""
    before = folded[folded.rfind(" ", 0, start - 1) + 1 : start - 1] if start > 1 else ""
    end = folded.index(" ", start)
    after = folded.find(" ", end + 1)
    return before, folded[start:end], folded[end + 1 : after] if after > 0 else ""


def evidence(weight: float, length: int) -> tuple[float, float]:
    """Calibration inputs: the weight itself and the weight per thousand characters."""
    return float(np.log1p(weight)), float(np.log1p(1000 * weight / (length + 200)))


def _labelled_texts(rows: DataFrame) -> DataFrame:
    return rows.select("text", F.col("label").cast("int").alias("label"))


def _term_counts(batches, choose) -> Counter:
    """Documents per (term, label) of one task, one count per document."""
    counts: Counter = Counter()
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for text, label in zip(plain_texts(batch.column(0)).to_pylist(), labels):
            for term in choose(fold(text)):
                counts[term, label] += 1
            if len(counts) > 500_000:
                yield counts
                counts = Counter()
    if counts:
        yield counts


def _count_documents(rows: DataFrame, choose) -> DataFrame:
    """(term, label, n): documents of each label that ``choose`` finds a term in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for counts in _term_counts(batches, choose):
            terms, labels = zip(*counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(terms, pa.string()),
                    pa.array(labels, pa.int32()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["term", "label", "n"],
            )

    parts = _labelled_texts(rows).mapInArrow(run, "term string, label int, n bigint")
    return parts.groupBy("term", "label").agg(F.sum("n").alias("n"))


def learn_lexicon(
    rows: DataFrame,
    min_documents: int = 4,
    precision: float = 0.9,
    calibration_rows: int = 20_000,
    shipped: int = SHIPPED_CHARACTERS,
) -> Lexicon | StoredLexicon:
    """A lexicon from rows (text, label 0 or 1), all of which are counted.

    Candidates are all beginnings of words, and short words whole, counted in Spark under both
    labels. One becomes a term if ``min_documents`` toxic documents hold it, ``precision`` of the
    documents that hold it are toxic and no shorter term begins it. The weight is the smoothed log
    ratio of the shares.

    Phrases of a term's word and a neighbour become exceptions if three clear documents hold them
    and no larger share of those that do is toxic than of all rows (or a tenth). The two
    calibration slopes are fitted on the ``calibration_rows`` rows with the smallest hashes of
    their doc_id, or of their text if they have none. Without labels of both kinds the lexicon is
    empty.

    Terms and exceptions come to the driver and the workers if they have ``shipped`` characters or
    fewer, after a count; else the lexicon stays in tables, with the same scores.
    """
    key = ["doc_id"] if "doc_id" in rows.columns else []
    rows = store(rows.where("label in (0, 1)").select("text", "label", *key), "labelled")
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clear = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clear:
        return Lexicon({})
    terms = store(_terms(rows, toxic, clear, min_documents, precision), "lexicon")
    room = shipped - _characters(terms)
    lexicon: Lexicon | StoredLexicon
    if room >= 0:
        lexicon = Lexicon({r.term: r.gain for r in terms.orderBy(F.length("term"), "term").collect()})
        counts = _shipped_phrases(rows, lexicon)
    else:
        coarse = Lexicon(dict.fromkeys(_cut(terms, shipped), 0.0))
        lexicon = StoredLexicon(coarse, terms, terms.select("term").limit(0))
        counts = _stored_phrases(rows, lexicon)
    exceptions = store(_exceptions(counts, toxic / (toxic + clear)), "exceptions")
    if isinstance(lexicon, StoredLexicon):
        lexicon.exceptions = exceptions
    elif _characters(exceptions) <= room:
        lexicon.exceptions = [r.term for r in exceptions.orderBy("term").collect()]
    else:
        lexicon = StoredLexicon(Lexicon(dict.fromkeys(lexicon.weights, 0.0)), terms, exceptions)
    _calibrate(rows, lexicon, calibration_rows)
    return lexicon


def _terms(rows: DataFrame, toxic: int, clear: int, least: int, precision: float) -> DataFrame:
    """(term, gain): precise beginnings that no shorter one begins."""
    counts = _count_documents(rows, lambda t: beginnings(set(t.split()))).groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("hits"), F.sum("n").alias("n")
    )
    hits, other = F.col("hits"), F.col("n") - F.col("hits")
    gain = F.log((hits + 0.5) / (toxic + 1)) - F.log((other + 0.5) / (clear + 1))
    precise = (hits >= least) & (hits >= precision * F.col("n"))
    terms = store(counts.where(precise).select("term", gain.alias("gain")).where("gain > 0"), "terms")
    sizes = F.sequence(F.lit(SHORTEST), F.length("term") - 1)
    starts = F.explode(F.transform(sizes, lambda n: F.substring(F.col("term"), F.lit(1), n)))
    begun = terms.where(F.length("term") > SHORTEST).select("term", starts.alias("start"))
    begun = begun.join(terms.select(F.col("term").alias("start")), "start").select("term").distinct()
    return terms.join(begun, "term", "left_anti")


def _characters(terms: DataFrame) -> int:
    return terms.agg(F.sum(F.length("term"))).first()[0] or 0


def _cut(terms: DataFrame, most: int) -> list[str]:
    """The distinct beginnings of the terms, as long as ``most`` characters allow.

    The last resort is the empty one, which begins every word.
    """
    size = F.explode(F.sequence(F.lit(1), F.lit(LONGEST)))
    cuts = terms.select(size.alias("size"), "term").selectExpr("size", "left(term, size) as start").distinct()
    sizes = cuts.groupBy("size").agg(F.sum(F.length("start")).alias("n")).where(F.col("n") <= most)
    best = sizes.agg(F.max("size")).first()[0]
    return [""] if best is None else [r.start for r in cuts.where(F.col("size") == best).collect()]


def _shipped_phrases(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(term, label, n): documents of each label that hold a phrase of a term's word."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    cached: list = []

    def phrases(folded: str) -> set[str]:
        if not cached:
            cached.append(shared.value.automaton())
        found = set()
        for start, _, _ in matches(folded, cached[0]):
            before, word, after = around(folded, start)
            found.update({f"{before} {word}"} if before else ())
            found.update({f"{word} {after}"} if after else ())
        return found

    return _count_documents(rows, phrases)


def _stored_phrases(rows: DataFrame, lexicon: StoredLexicon) -> DataFrame:
    """The same by a join."""
    numbered = store(rows.select(F.monotonically_increasing_id().alias("_row"), "text", "label"), "numbered")
    hits = _hits(_candidates(numbered.select("_row", "text"), lexicon.coarse), lexicon.terms)
    held = hits.select("_row", F.explode(F.array(*map(F.expr, _PHRASES))).alias("term")).where("term like '% %'")
    labelled = held.distinct().join(numbered.select("_row", "label"), "_row")
    return labelled.groupBy("term", "label").agg(F.count(F.lit(1)).alias("n"))


def _exceptions(counts: DataFrame, share: float) -> DataFrame:
    counts = counts.groupBy("term").agg(
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clear"),
        F.sum("n").alias("n"),
    )
    toxic = F.col("n") - F.col("clear")
    return counts.where((F.col("clear") >= 3) & (toxic <= max(share, 0.1) * F.col("n"))).select("term")


#: A word with its neighbours, as phrases; without that neighbour the word alone, which no phrase is.
_PHRASES = "concat_ws(' ', nullif(before, ''), word)", "concat_ws(' ', word, nullif(after, ''))"
_FOUND = pa.schema(
    [
        ("_row", pa.int64()),
        ("length", pa.int64()),
        ("before", pa.string()),
        ("word", pa.string()),
        ("after", pa.string()),
        ("n", pa.int64()),
    ]
)


def _candidates(rows: DataFrame, coarse: Lexicon) -> DataFrame:
    """Words of rows (_row, text) that a beginning of ``coarse`` begins, with their neighbours.

    Equal ones of a text are counted (n). Each text also gives one row with its ``length``.
    """
    shared = rows.sparkSession.sparkContext.broadcast(coarse)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value.automaton()
        for batch in batches:
            for start, stop in slices(batch.column(1), SMALL_SLICE):
                part = batch.slice(start, stop - start)
                found: list[tuple] = []
                for row, text in zip(part.column(0).to_pylist(), plain_texts(part.column(1)).to_pylist()):
                    folded = fold(text)
                    found.append((row, len(folded), None, None, None, 1))
                    places = (at for at, _, _ in matches(folded, terms) if at < len(folded))
                    words = Counter(around(folded, at) for at in places if folded[at] != " ")
                    found += [(row, None, *words_at, n) for words_at, n in words.items()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found), _FOUND.types)]
                yield pa.RecordBatch.from_arrays(columns, schema=_FOUND)

    return store(
        rows.mapInArrow(
            run, "_row bigint, length bigint, before string, word string, after string, n bigint"
        ),
        "candidates",
    )


def _hits(found: DataFrame, terms: DataFrame) -> DataFrame:
    """Found words that a term begins, with its gain; no two terms begin one word."""
    size = F.length("word")
    longer = F.transform(
        F.sequence(F.lit(SHORTEST), F.least(size, F.lit(LONGEST))),
        lambda n: F.substring(F.col("word"), F.lit(1), n),
    )
    starts = F.when(size < SHORTEST, F.array(F.concat("word", F.lit(" ")))).otherwise(longer)
    return found.where("word is not null").withColumn("term", F.explode(starts)).join(terms, "term")


def _calibrate(rows: DataFrame, lexicon: Lexicon | StoredLexicon, most: int) -> None:
    """Two slopes and a bias by penalised Newton steps on a bounded sample."""
    sample = hash_sample(rows, most, "doc_id" if "doc_id" in rows.columns else "text")
    scored, e = _with_evidence(sample.select("_place", "label", "text"), lexicon)
    numbers = scored.select("_place", "label", e["x"].alias("x"), e["y"].alias("y"))
    data = first_rows(numbers, most, "label", "x", "y").collect()
    x = np.array([(1.0, r.x, r.y) for r in data]).reshape(len(data), 3)
    y = np.array([r.label for r in data], float)
    b = np.array([-3.0, 1.0, 0.0])
    start = b.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        w = p * (1 - p) + 1e-9
        step = np.linalg.solve(
            x.T @ (x * w[:, None]) + 0.05 * np.eye(3), x.T @ (y - p) - 0.05 * (b - start)
        )
        b += step
        if np.abs(step).max() < 1e-8:
            break
    lexicon.bias, lexicon.slopes = float(b[0]), (float(b[1]), float(b[2]))


def _evidence_column(df: DataFrame, lexicon: Lexicon):
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf("struct<x: double, y: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms, exceptions = shared.value.automaton(), shared.value.exception_automaton()
        for texts in batches:
            pairs = []
            for start, stop in slices(texts):
                for text in plain_texts(texts.slice(start, stop - start)).to_pylist():
                    folded = fold(text)
                    pairs.append(evidence(weigh(folded, terms, exceptions), len(folded)))
            columns = np.array(pairs, float).reshape(len(pairs), 2)
            yield pa.StructArray.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], ["x", "y"])

    return run


def _unused(df: DataFrame, name: str) -> str:
    while name in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def _with_evidence(df: DataFrame, lexicon: Lexicon | StoredLexicon) -> tuple[DataFrame, Column]:
    """The rows with a further column, and that column: the evidence (x, y) of their text."""
    name = _unused(df, "_evidence")
    if isinstance(lexicon, Lexicon):
        return df.withColumn(name, _evidence_column(df, lexicon)(F.col("text"))), F.col(name)
    row = _unused(df, "_row")
    numbered = store(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = _candidates(numbered.select(F.col(row).alias("_row"), "text"), lexicon.coarse)
    hits = _hits(found, lexicon.terms)
    for phrase in _PHRASES:
        hits = hits.withColumn("term", F.expr(phrase)).join(lexicon.exceptions, "term", "left_anti")
    weights = hits.groupBy("_row").agg(F.sum(F.col("gain") * F.col("n")).alias("weight"))
    lengths = found.where("length is not null").select("_row", "length")
    weight = F.coalesce("weight", F.lit(0.0))
    e = F.struct(F.log1p(weight).alias("x"), F.log1p(1000 * weight / (F.col("length") + 200)).alias("y"))
    pairs = lengths.join(weights, "_row", "left").select(F.col("_row").alias(row), e.alias(name))
    return numbered.join(pairs, row).drop(row), F.col(name)


def score_toxicity(
    docs: DataFrame, lexicon: Lexicon | StoredLexicon, threshold: float = 0.7
) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 at ``threshold`` or more) from ``text`` alone.

    Whole texts are matched. Null and empty texts have no matches and get the score of a text
    without any. Columns of these names are replaced; rows and other columns stay as they are. No
    shuffle; with a lexicon in tables, found words are joined and rows are stored once.
    """
    rows, e = _with_evidence(docs.drop("score", "predicted"), lexicon)
    a, b = lexicon.slopes
    odds = F.lit(lexicon.bias) + e["x"] * a + e["y"] * b
    scored = rows.withColumn("score", 1 / (1 + F.exp(-odds))).drop(e)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
