import random

import pytest
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.functions.tokens import ADDED_TOKENS, RIGHT_PAD_TOKEN
from quillspark.operators import encode as E
from quillspark.operators.vocabulary import (
    UNKNOWN,
    LookupLimit,
    add_tokens,
    build_vocabulary,
    resolve_pad,
    template_tokens,
    token_ids,
)
from quillspark.session import store


@pytest.fixture(scope="module")
def corpus(spark):
    chosen = random.Random(5)
    words = ["the"] * 20 + [f"w{i}" for i in range(40)] + ["<think>", "\n", "é", "a<b"]
    texts = [" ".join(chosen.choices(words, k=chosen.randint(1, 40))) for _ in range(200)]
    texts += ["", "the the", "\n\n"]
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string").persist()


@pytest.fixture(scope="module")
def full_vocab(corpus):
    return build_vocabulary(corpus, 10_000).persist()


def table(df):
    return {r.id: (r.input_ids, r.attention_mask) for r in df.collect()}


def test_vocabulary_order_and_cutoff(spark):
    df = spark.createDataFrame([("b b b a a c d d",), ("system",)], "text string")
    vocab = {r.token: r.id for r in build_vocabulary(df, 3, reserved=["<unk>", "system"]).collect()}
    # the space occurs most often, then b, then a before d
    assert vocab == {"<unk>": 0, "system": 1, " ": 2, "b": 3, "a": 4}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 100])
def test_vocabulary_against_brute_force(spark, corpus, size):
    from collections import Counter

    from quillspark.functions.tokens import words

    rows = corpus.select(F.explode(words(F.col("text"))).alias("t")).collect()
    reserved = template_tokens()
    counts = Counter(r.t for r in rows if r.t not in reserved)
    ranked = sorted(counts, key=lambda t: (-counts[t], t.encode()))[:size]
    got = build_vocabulary(corpus, size).orderBy("id").collect()
    assert [r.token for r in got] == [*reserved, *ranked]
    assert [r.id for r in got] == list(range(len(got)))


def test_added_tokens_follow_the_largest_id(spark):
    vocab = spark.createDataFrame([("a", 0), ("<think>", 7)], schemas.VOCABULARY)
    got = {r.token: r.id for r in add_tokens(vocab, ADDED_TOKENS).collect()}
    assert got["<think>"] == 7
    assert [got[t] for t in ADDED_TOKENS if t != "<think>"] == [8, 9, 10, 11, 12]


@pytest.mark.parametrize(
    "tokens, options, want",
    [
        ({"<pad>": 1, RIGHT_PAD_TOKEN: 2, "<|end_of_text|>": 3}, {"pad_token": "<pad>"}, 1),
        ({RIGHT_PAD_TOKEN: 2, "<|end_of_text|>": 3}, {}, 2),
        ({RIGHT_PAD_TOKEN: 2, "<|end_of_text|>": 3}, {"fallback": None}, 3),
        ({"<|end_of_text|>": 3}, {}, 3),
        ({"<|end_of_text|>": 3}, {"pad_token": "absent"}, 3),
    ],
)
def test_pad_resolution(spark, tokens, options, want):
    vocab = spark.createDataFrame(list(tokens.items()), schemas.VOCABULARY)
    assert [r.pad_id for r in resolve_pad(vocab, **options).collect()] == [want]


def test_lookup_and_join_agree(corpus, full_vocab):
    small = full_vocab.where(F.col("id") < 30)
    looked_up = table(E.encode(corpus, small, 15))
    assert table(E.encode_by_join(corpus, small, 15)) == looked_up
    assert looked_up[200] == ([], [])
    assert any(0 in ids for ids, _ in looked_up.values())
    assert all(len(ids) == len(mask) <= 15 for ids, mask in looked_up.values())
    assert table(E.encode_by_join(corpus, small)) == table(E.encode(corpus, small))


ODD_ROWS = [(1, "the w1"), (None, "the w1 w2"), (2, "w2"), (2, "w1 the"), (2, "w1 the"), (3, None), (None, ""), (4, "")]


def test_paths_agree_on_null_repeated_and_empty_rows(spark, full_vocab):
    df = spark.createDataFrame(ODD_ROWS, "id int, text string")
    none = LookupLimit(rows=0)

    def rows(frame, *columns):
        return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)

    columns = ("id", "text", "input_ids", "attention_mask")
    looked_up, by_join = E.encode(df, full_vocab), E.encode(df, full_vocab, limit=none)
    assert rows(looked_up, *columns) == rows(by_join, *columns) and by_join.columns == looked_up.columns
    ids = looked_up.select("id", "input_ids")
    want = sorted(ODD_ROWS, key=repr)
    assert rows(E.decode(ids, full_vocab), "id", "text") == want
    assert rows(E.decode(ids, full_vocab, limit=none), "id", "text") == want


def test_a_text_is_split_once(spark, corpus, full_vocab):
    vocab = store(full_vocab, "vocabulary")
    plan = E.encode_by_join(corpus, vocab)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # done before the rows were stored


def test_whole_vocabulary_is_numbered_like_a_cut_one(corpus):
    assert build_vocabulary(corpus, None).orderBy("id").collect() == build_vocabulary(corpus, 10**6).orderBy("id").collect()


def test_beginning_token(corpus, full_vocab):
    plain = table(E.encode(corpus, full_vocab, 14))
    for begun in (
        E.encode(corpus, full_vocab, 15, bos="<|begin_of_text|>"),
        E.encode_by_join(corpus, full_vocab, 15, bos="<|begin_of_text|>"),
    ):
        assert {k: v[0] for k, v in table(begun).items()} == {k: [1, *v[0]] for k, v in plain.items()}


def test_truncated_ids_are_a_prefix(corpus, full_vocab):
    whole, cut = table(E.encode(corpus, full_vocab, 10**6)), table(E.encode(corpus, full_vocab, 7))
    assert all(cut[k][0] == whole[k][0][:7] for k in whole)


def test_decode_restores_the_text(corpus, full_vocab):
    encoded = E.encode(corpus, full_vocab, 10**6).select("id", "input_ids", F.col("text").alias("want"))
    for decoded in (
        E.decode(encoded, full_vocab),
        E.decode_by_join(encoded, full_vocab),
    ):
        rows = decoded.collect()
        assert len(rows) == 203 and all(r.text == r.want for r in rows)


def test_unknown_ids_and_null_rows(spark, full_vocab):
    df = spark.createDataFrame([(1, [99999, 1]), (2, None), (3, [])], "id int, input_ids array<int>")
    want = {1: UNKNOWN + template_tokens()[1], 2: None, 3: ""}
    assert {r.id: r.text for r in E.decode(df, full_vocab).collect()} == want
    assert {r.id: r.text for r in E.decode_by_join(df, full_vocab).collect()} == want
    texts = spark.createDataFrame([(1, None), (2, "the")], "id int, text string")
    assert table(E.encode(texts, full_vocab, 5))[1] == (None, None)
    assert table(E.encode_by_join(texts, full_vocab, 5))[1] == (None, None)


def test_size_check(full_vocab):
    assert LookupLimit().admits(full_vocab)
    assert not LookupLimit(chars=5).admits(full_vocab) and not LookupLimit(rows=5).admits(full_vocab)


def test_lookup_path_has_no_shuffle(corpus, full_vocab):
    plan = E.encode(corpus, full_vocab, 15)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_token_ids(full_vocab):
    assert token_ids(full_vocab, ["<|eot_id|>", "no such word"]) == [4, 0]


def test_plugin(spark, corpus):
    opened = spark.sparkContext.accumulator(0)

    def factory():
        opened.add(1)
        return lambda texts: [[len(w) for w in t.split()] for t in texts]

    data = corpus.coalesce(2)
    cut = table(E.encode_with(data, factory, 5))
    assert 0 < opened.value <= 2
    whole = table(E.encode_with(data, factory))
    assert all(cut[k][0] == whole[k][0][:5] for k in whole)
    assert cut[201][0] == [3, 3] and cut[200][0] == []
    nulls = spark.createDataFrame([(1, None), (2, "the")], "id int, text string")
    assert table(E.encode_with(nulls, factory, 5)) == {1: (None, None), 2: ([3], [1])}
    with pytest.raises(Exception, match="rows for"):
        E.encode_with(data, lambda: lambda texts: [[1]] * (len(texts) + 1)).collect()


@pytest.mark.parametrize("block", [1, 200, 10**6])
def test_a_word_is_joined_once_for_a_block(spark, corpus, full_vocab, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK_BYTES", block)
    small = store(full_vocab.where(F.col("id") < 30), "vocabulary")
    joined, seen = E.encode_by_join(corpus.coalesce(1), small, keep=["id"]), []
    assert joined.columns == ["id", "input_ids", "attention_mask"]
    assert table(joined) == table(E.encode(corpus, small))
    monkeypatch.setattr(E, "store", lambda df, name: seen.append(store(df, name)) or seen[-1])
    encoded = E.encode(corpus, full_vocab).select("id", "text", "input_ids")
    decoded = E.decode_by_join(encoded.coalesce(1).withColumnRenamed("text", "want"), full_vocab)
    assert all(r.text == r.want for r in decoded.collect()) and decoded.count() == 203
    listed = seen[0].where("_items is not null").select(F.explode("_items"))
    distinct = encoded.select(F.explode("input_ids")).distinct().count()
    if block == 10**6:  # one block: each id once, whatever its occurrences
        assert listed.count() == distinct
    if block == 1:
        assert seen[0].select("_block").distinct().count() == 203


def test_null_ids_and_odd_columns_by_join(spark, full_vocab):
    rows = [(1, [1, None, 99999], {"a": 1}), (None, None, None), (1, [], {}), (1, [1, None, 99999], {"a": 1})]
    df = spark.createDataFrame(rows, "id int, input_ids array<int>, extra map<string, int>")
    first = template_tokens()[1] + UNKNOWN * 2
    got = E.decode_by_join(df, full_vocab).collect()
    assert sorted(got, key=repr) == sorted(E.decode(df, full_vocab).collect(), key=repr)
    assert sorted((r.text for r in got), key=repr) == sorted([first, None, "", first], key=repr)


def test_conversion_goes_by_slices(spark, corpus, full_vocab, monkeypatch):
    import pyarrow as pa

    sizes = []
    lists = pa.array([[1, 2], None, [], list(range(500)), [3]], pa.list_(pa.int32()))
    monkeypatch.setattr(E, "SLICE_BYTES", 40)
    whole = E._in_slices(lists, lambda part: sizes.append(len(part.flatten())) or part)
    assert whole.equals(lists) and sizes == [2, 500, 1]
    assert E._in_slices(lists[:0], lambda part: part).equals(lists[:0])
    assert E._in_slices(lists[2:], lambda part: part).equals(lists[2:])
