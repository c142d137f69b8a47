import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.llm import collocations as module
from quillspark.llm.collocations import (
    _merge,
    _opened,
    _summed,
    collocations,
    count_stripes,
    exact_score,
    extensions,
    frequent_phrases,
    merge_stripes,
    word_counts,
)

SCHEMA = "doc_id bigint, text string, lang string, prefix string"


def brute_force(rows, least, most):
    found = []
    by_lang = defaultdict(list)
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            by_lang["und" if lang is None else lang].append(re.findall(r"[^\x20\x09]+", piece))
    for lang, pieces in by_lang.items():
        f = Counter()
        for words in pieces:
            for m in range(1, 5):
                f.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rowset = []
        for p, a in candidates.items():
            longer = [
                c for q, c in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if any(100 * c >= 80 * a for c in longer):
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rowset.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rowset)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x") for i, (t, lang) in enumerate(rows)], SCHEMA)


def rows_of(found):
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    words = ["the", "of", "Über", "naïve", "x-1", "AND", "'s", "日本", "\u007f", "z" * 300]
    phrases = ["in the Middle of", "once upon a time", "a b a b a b"]

    def sentence():
        some = draw.choices(words, [9, 7, 3, 2, 2, 2, 1, 1, 1, 1], k=draw.randint(0, 9))
        if draw.random() < 0.5:
            some.insert(draw.randint(0, len(some)), draw.choice(phrases))
        return draw.choice([" ", "  ", "\t"]).join(some)

    rows = []
    for i in range(200):
        marks = [draw.choice([". ", ",", "\n", "\r\n", "!?", "\x0b"]) for _ in range(4)]
        rows.append(("".join(sentence() + m for m in marks), draw.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", None), (" \t\n.,", "fr"), rows[0], rows[0]]


@pytest.mark.parametrize("least,most", [(3, 2000), (10, 7), (1, 50)])
def test_phrases_equal_brute_force(spark, corpus, least, most):
    got = rows_of(collocations(table(spark, corpus).repartition(3), least, most))
    want = brute_force(corpus, least, most)
    assert got == want and len(got) > 10


def test_phrases_do_not_depend_on_bounds(spark, corpus, monkeypatch):
    want = brute_force(corpus, 4, 2000)
    monkeypatch.setattr(module, "COUNT_BYTES", 500)  # many slices, so stripes of one prefix meet
    monkeypatch.setattr(module, "HOT_SHARE", 20_000)  # all prefixes are hot
    monkeypatch.setattr(module, "MOST_BITS", 1 << 12)
    monkeypatch.setattr(module, "BITS_PER_PHRASE", 1)
    assert rows_of(collocations(table(spark, corpus).repartition(2), 4)) == want


def test_empty_table_and_texts_without_phrases(spark):
    assert rows_of(collocations(table(spark, []).limit(0))) == []
    assert rows_of(collocations(table(spark, [(None, None), ("", "en"), ("word", "en")]), 1)) == []


def test_long_text(spark):
    rows = [("one two " * 100_000, "en"), ("one two. " * 10, "en")]
    (row,) = [r for r in rows_of(collocations(table(spark, rows), 30)) if r[2] == "one two one two"]
    assert row[3] == 99_999


def test_stripes_give_extensions_totals_and_best(spark):
    docs = table(spark, [("a b a b a c. a", "en"), ("b a b", "en")]).select("lang", "text")
    words = word_counts(docs)
    merged = merge_stripes(count_stripes(docs, 1, frequent_phrases(words, 10)), 1).cache()
    totals = merged.groupBy("prefix").agg(F.sum("total").alias("t"), F.max("best").alias("b"))
    assert {(r.prefix, r.t, r.b) for r in totals.collect()} == {("a", 5, 3), ("b", 4, 3), ("c", 1, 0)}
    assert {(r.phrase, r.f) for r in extensions(merged).collect()} == {("a b", 3), ("b a", 3), ("a c", 1)}


def test_stripes_add_element_by_element():
    def rows(*stripes):
        columns = zip(*[(f"{p}\ten", 0, " ".join(s), list(s.values())) for p, s in stripes])
        types = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.int32())]
        names = ["key", "part", "nexts", "counts"]
        return _opened(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names))

    merged, owners = _merge(rows(("a", {"": 2, "x": 1}), ("a", {"y": 4, "x": 5}), ("b", {"x": 1})))
    assert merged["key"].to_pylist() == ["a\ten", "b\ten"] and np.bincount(owners).tolist() == [3, 1]
    summed = _summed(merged, owners, 2).to_pylist()
    assert [(r["lang"], r["prefix"]) for r in summed] == [("en", "a"), ("en", "b")]
    assert dict(zip(summed[0]["nexts"], summed[0]["counts"])) == {"x": 6, "y": 4}
    assert (summed[0]["total"], summed[0]["best"], summed[1]["nexts"], summed[1]["total"]) == (12, 6, [], 1)


def test_scores_beyond_64_bits(spark):
    a, rest = 5_000_000_000_000, 9_000_000_000_001
    row = spark.range(1).select(exact_score(F.lit(a), F.lit(rest), F.lit(rest)).alias("s")).first()
    assert row.s == 2_000_000 * a // (2 * rest)
