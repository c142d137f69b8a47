import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import tokens as K

IDS = F.col("ids")


def ids_of(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "i int, ids array<int>")


def values(df, column):
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_words_tile_the_text(evaluate):
    samples = ["", " ", "a  b", "\n\n\n", "x<y", "<think>a</think>", "<|eot_id|>\n\nhi", "é\t😀 \r\n"]
    assert ["".join(w) for w in evaluate(K.words(F.col("text")), *samples)] == samples


def test_special_tokens_stay_whole(evaluate):
    (words,) = evaluate(K.words(F.col("text")), "<|start_header_id|>assistant<|end_header_id|>\n\n\nhi")
    assert words == ["<|start_header_id|>", "assistant", "<|end_header_id|>", "\n\n", "\n", "hi"]


def test_special_tokens_without_bracket(evaluate):
    pattern = K.word_pattern(["[PAD]", "<x>"])
    assert evaluate(K.words(F.col("text"), pattern), "[PAD]a<x>") == [["[PAD]", "a", "<x>"]]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.text(st.sampled_from("ab<>|/_ \n\té😀think"), max_size=30), min_size=200, max_size=200
    )
)
def test_words_tile_any_text(evaluate, samples):
    assert ["".join(w) for w in evaluate(K.words(F.col("text")), *samples)] == samples


@pytest.mark.parametrize(
    "ids, labels",
    [
        ([1, 2, 9, 9, 5, 9, 9, 7, 8], [-100] * 7 + [7, 8]),
        ([1, 2, 3], [-100] * 3),
        ([1, 9, 9], [-100] * 3),
        ([9], [-100]),
        ([], []),
        ([9, 9, 4], [-100, -100, 4]),
        ([9, 9, 9, 4], [-100, -100, -100, 4]),
    ],
)
def test_response_labels(spark, ids, labels):
    assert values(ids_of(spark, ids), K.response_labels(IDS, [9, 9])) == [labels]


def test_response_labels_against_brute_force(spark):
    chosen = random.Random(3)
    rows = [[chosen.randint(1, 3) for _ in range(chosen.randint(0, 12))] for _ in range(500)]
    marker = [1, 2, 1]

    def expected(ids):
        hits = [p for p in range(len(ids)) if ids[p : p + 3] == marker]
        end = hits[-1] + 3 if hits else len(ids)
        return [-100] * end + ids[end:]

    got = values(ids_of(spark, *rows), K.response_labels(IDS, marker))
    assert got == [expected(r) for r in rows]
    for ids, labels in zip(rows, got):
        assert K.IGNORED_LABEL in labels or not ids


def test_causal_labels(spark):
    df = ids_of(spark, [1, 2, 5], [])
    assert values(df, K.causal_labels(IDS)) == [[1, 2, 5], []]
    assert values(df, K.causal_labels(IDS, 2)) == [[1, -100, 5], []]
    assert values(df, K.supervised_tokens(K.causal_labels(IDS, 2))) == [2, 0]


def test_truncation_keeps_a_prefix(spark):
    df = ids_of(spark, [1, 2, 3], [1], [])
    assert values(df, K.truncate(IDS, 2)) == [[1, 2], [1], []]
    assert values(df, K.attention_mask(K.truncate(IDS, 2))) == [[1, 1], [1], []]


def test_budgets_and_slices(spark):
    df = ids_of(spark, [1, 2, 3], [1], [])
    assert values(df, K.prompt_budget(IDS, 2)) == [[2, 3], [1], []]
    assert values(df, K.completion_budget(IDS, 2)) == [[1, 2], [1], []]
    assert values(df, K.after_prompt(IDS, F.array(F.lit(1)))) == [[2, 3], [], []]


def test_pad_right(spark):
    df = ids_of(spark, [1, 2, 3], [1], [])
    assert values(df, K.pad_right(IDS, 0, 2)) == [[1, 2], [1, 0], [0, 0]]
