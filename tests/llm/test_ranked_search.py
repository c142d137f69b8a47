import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillspark.llm import ranked_search as module
from quillspark.llm.ranked_search import Best, Block, Shard, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, k):
    """Rankings of (row of items): [(doc_id, score)], from the definition."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    big_n, big_l = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    rankings = []
    for _, text in items:
        scores = []
        for doc_id, c in counted:
            m = 50 + 50 * sum(c.values()) * big_n // big_l
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((doc_id, score))
        scores.sort(key=lambda s: (-s[1], s[0] is not None, s[0] or 0))
        rankings.append(scores[:k])
    return rankings


def tables(spark, docs, items):
    docs = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, score string")
    return docs.repartition(3), spark.createDataFrame(items, "item_id bigint, text string").coalesce(1)


def rows_of(ranked):
    return sorted((r.item_id is not None, r.item_id or 0, r["rank"], r.doc_id, r.score) for r in ranked.collect())


def wanted(docs, items, k):
    rows = [
        (i is not None, i or 0, place, *found)
        for (i, _), ranking in zip(items, brute_force(docs, items, k))
        for place, found in enumerate(ranking, 1)
    ]
    return sorted(rows)


@pytest.fixture
def corpus():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]

    def text(n):
        return " ".join(draw.choices(words, weights, k=n))

    docs = [(i, text(draw.randint(0, 60))) for i in range(300)]
    items = [(i, text(draw.randint(1, 15))) for i in range(20)]
    return docs, items


@pytest.mark.parametrize("k", [1, 5, 50])
def test_rankings_equal_brute_force(spark, corpus, k):
    docs, items = corpus
    assert rows_of(ranked_search(*tables(spark, docs, items), k=k)) == wanted(docs, items, k)


def test_rankings_do_not_depend_on_bounds(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(module, "BLOCK_PAIRS", 30)
    monkeypatch.setattr(module, "WANTED_TERMS", 3)
    assert rows_of(ranked_search(*tables(spark, docs, items), k=7)) == wanted(docs, items, 7)


def test_unusual_rows(spark):
    docs = [
        (None, "Straße 5 köln"), (4, None), (5, ""), (6, ".,; \t\n"), (7, "STRAßE straße"),
        (7, "STRAßE straße"), (3, "köln_straße"), (9, "a " * 50_000 + "köln"), (1, "\u0000köln\u007f"),
    ]
    items = [(None, "köln"), (1, None), (2, ""), (3, "Straße, straße KÖLN"), (3, "a"), (8, "absent")]
    got, want = rows_of(ranked_search(*tables(spark, docs, items))), wanted(docs, items, 50)
    assert got == want and len(got) > 8


def test_ties_go_by_id_with_null_first(spark):
    docs = [(i, "same words here") for i in (5, 3, None, 9, 3, 1)] + [(20 + i, "other") for i in range(9)]
    ranked = ranked_search(*tables(spark, docs, [(1, "words")]), k=4).orderBy("rank").collect()
    assert [(r["rank"], r.doc_id) for r in ranked] == [(1, None), (2, 1), (3, 3), (4, 3)]


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty_tables(spark, empty):
    docs = [] if empty in ("docs", "both") else [(1, "a b")]
    items = [] if empty in ("items", "both") else [(1, "a")]
    found = ranked_search(*tables(spark, docs, items))
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def shard_of(contributions, documents):
    """A block with one item holding all terms, rarest first, and its shard."""
    frequency = [len(c) for c in contributions]
    table = pa.table(
        {
            "item": np.zeros(len(frequency), np.int64),
            "term": [f"t{i}" for i in range(len(frequency))],
            "df": frequency,
            "w": np.ones(len(frequency), np.int64),
        }
    )
    block = Block(table, (documents, documents))
    index = np.concatenate([np.full(len(c), i) for i, c in enumerate(contributions)])
    rows = np.concatenate([list(c) for c in contributions])
    added = np.concatenate([list(c.values()) for c in contributions])
    ids = np.arange(documents)
    return block, Shard(block, index, rows, added, ids, np.ones(documents, bool))


def test_accumulators_stop_where_no_new_document_can_enter():
    rare = {i: 1000 + i for i in range(20)}
    frequent = {i: 3 for i in range(5000)}
    block, shard = shard_of([rare, frequent], 5000)
    best = Best(5)
    assert shard.search(block.plans[0], best) == 20
    assert best.ids.tolist() == [19, 18, 17, 16, 15]
    assert best.scores.tolist() == [1022, 1021, 1020, 1019, 1018]  # survivors get their exact scores


def test_a_document_that_ties_is_not_shut_out():
    block, shard = shard_of([{8: 10, 9: 10}, {1: 10, 2: 5, 3: 5}], 10)
    best = Best(2)
    shard.search(block.plans[0], best)
    assert best.ids.tolist() == [1, 8]
