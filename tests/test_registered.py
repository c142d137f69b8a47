import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions.tokens import SPECIAL_TOKENS, word_pattern
from quillspark.operators.encode import decode, decode_by_join, encode, encode_by_join, numbers_text
from quillspark.operators.scanner import TokenScanner
from quillspark.operators.vocabulary import (
    LookupLimit,
    add_byte_tokens,
    add_tokens,
    build_vocabulary,
    byte_ids,
    registered_tokens,
)
from quillspark.session import store

TEXTS = ["see <tool> now <tool>", "a<tool>b", "<tools><tool", "", None, "pre[X]post [X] [XY]", "é<think>日本</think>"]


def brute_force(text, tokens):
    pieces, plain, at = [], "", 0
    while at < len(text):
        here = [t for t in tokens if text.startswith(t, at)]
        if not here:
            plain, at = plain + text[at], at + 1
            continue
        if plain:
            pieces.append((plain, False))
        pieces.append((max(here, key=len), True))
        plain, at = "", at + len(pieces[-1][0])
    return pieces + [(plain, False)] if plain else pieces


@given(st.lists(st.text("abc", min_size=1, max_size=5), min_size=1, max_size=8), st.text("abcd", max_size=40))
@settings(max_examples=400, deadline=None)
def test_scanner_equals_brute_force(tokens, text):
    assert TokenScanner(tokens).split(text) == brute_force(text, tokens)


@pytest.fixture(scope="module")
def base(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    return store(build_vocabulary(df, 3), "vocabulary")


def by_token(vocab):
    return {r.token: r.id for r in vocab.collect()}


def ids_of(spark, vocab, texts, how=encode, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.input_ids for r in how(df, vocab, **options).orderBy("i").collect()]


@pytest.mark.parametrize("how", [encode, encode_by_join])
def test_registered_tokens_are_emitted_with_no_further_argument(spark, base, how):
    vocab = store(add_tokens(base, ["<tool>", "[X]", "[XY]"]), "vocabulary")
    ids = by_token(vocab)
    got = ids_of(spark, vocab, TEXTS, how)
    assert [got[0].count(ids["<tool>"]), got[1].count(ids["<tool>"]), got[2].count(ids["<tool>"])] == [2, 1, 0]
    assert got[3] == [] and got[4] is None
    assert [i for i in got[5] if i in (ids["[X]"], ids["[XY]"])] == [ids["[X]"], ids["[X]"], ids["[XY]"]]
    assert got[1][1] == ids["<tool>"] and len(got[1]) == 3


def test_tokens_of_the_formats_stay_beside_registered_ones(spark, base):
    vocab = store(add_tokens(base, ["<tool>", *SPECIAL_TOKENS]), "vocabulary")
    ids = by_token(vocab)
    (got,) = ids_of(spark, vocab, ["<think>x<tool></think>"])
    assert [got[0], got[2], got[3]] == [ids["<think>"], ids["<tool>"], ids["</think>"]]


def test_truncation_and_beginning_with_registered_tokens(spark, base):
    vocab = store(add_tokens(base, ["<tool>", "<s>"]), "vocabulary")
    ids = by_token(vocab)
    (got,) = ids_of(spark, vocab, ["<tool>" * 9], max_tokens=3, bos="<s>")
    assert got == [ids["<s>"], ids["<tool>"], ids["<tool>"]]


def test_words_that_are_registered_keep_their_id(spark, base):
    word = base.where("id > 10").first()
    vocab = store(add_tokens(base, [word.token, "new"]), "vocabulary")
    ids = by_token(vocab)
    assert ids[word.token] == word.id and ids["new"] == max(by_token(base).values()) + 1
    assert registered_tokens(vocab) == sorted([word.token, "new"])
    again = add_tokens(vocab, ["newer"])
    assert registered_tokens(again) == sorted([word.token, "new", "newer"])
    assert registered_tokens(base) == [] and add_tokens(base, []).count() == base.count()
    with pytest.raises(ValueError):
        add_tokens(base, [""])


def test_ten_thousand_tokens(spark, base):
    draw = random.Random(2)
    tokens = [f"<t{i}>" for i in range(10_000)]
    vocab = store(add_tokens(base, tokens), "vocabulary")
    ids = by_token(vocab)
    texts = ["x".join(draw.choices(tokens, k=50)) for _ in range(200)]
    known = set(ids[t] for t in tokens)
    for text, got in zip(texts, ids_of(spark, vocab, texts)):
        assert [i for i in got if i in known] == [ids[t] for t in text.split("x")]


# bytes

ANY = ["", None, "plain text", "é日本😀\u0000\n\n  <x>", "<0x41>", "a" * 300, "\n \n", "<|eot_id|>é"]


@pytest.fixture(scope="module", params=[0, 3])
def with_bytes(request, spark, base):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    return store(add_byte_tokens(build_vocabulary(df, request.param)), "vocabulary")


@pytest.mark.parametrize("encoder,decoder", [(encode, decode), (encode_by_join, decode_by_join)])
def test_any_text_comes_back(spark, with_bytes, encoder, decoder):
    df = spark.createDataFrame(list(enumerate(ANY)), "i int, text string")
    rows = encoder(df, with_bytes).select("i", "input_ids")
    assert [r.text for r in decoder(rows, with_bytes).orderBy("i").collect()] == ANY


@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=20))
@settings(max_examples=4, deadline=None)
def test_generated_texts_come_back(spark, with_bytes, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = encode(df, with_bytes).select("i", "input_ids")
    assert [r.text for r in decode(rows, with_bytes).orderBy("i").collect()] == texts


@pytest.mark.parametrize("most", [1, 2, 5, 100])
def test_both_ways_give_the_same_bytes(spark, with_bytes, most):
    one = ids_of(spark, with_bytes, ANY, max_tokens=most)
    assert one == ids_of(spark, with_bytes, ANY, encode_by_join, max_tokens=most)
    assert max(len(x or []) for x in one) == min(most, 300)
    in_bytes = byte_ids(with_bytes)
    assert one[3][:2] == [in_bytes[b] for b in "é日".encode()[:2]][:most]


def test_cut_characters_are_replaced(spark, with_bytes):
    df = spark.createDataFrame([("日本",)], "text string")
    for encoder, decoder in ((encode, decode), (encode_by_join, decode_by_join)):
        rows = encoder(df, with_bytes, max_tokens=4).select("input_ids")
        assert decoder(rows, with_bytes).first().text == "日�"


def test_a_vocabulary_too_large_to_ship_joins(spark, with_bytes):
    df = spark.createDataFrame([("é x",)], "text string")
    small = LookupLimit(rows=1)
    assert encode(df, with_bytes, limit=small).first() == encode(df, with_bytes).first()


def test_without_all_bytes_words_are_unknown(spark, base):
    vocab = store(add_byte_tokens(base).where("token != '<0x41>'"), "vocabulary")
    assert byte_ids(vocab) is None
    assert ids_of(spark, vocab, ["outside"]) == [[by_token(base)["<unk>"]]]


def test_word_pattern_is_unchanged():
    assert word_pattern(["<a>"]).endswith("<a>|<") and F.lit is not None


def test_words_and_tokens_in_one_pass(spark, texts):
    from quillspark.functions.tokens import word_pattern, words
    from quillspark.operators.scanner import registered_words, split_registered

    tokens = ["e", "the", "on the", "\n", "é", "<|eot_id|>", "a\n"]
    odd = ["", None, "the one on the <|eot_id|> a\n\n\n<e é\t😀e", "e", "x", " \n<", "on th"]
    df = texts(*odd)
    pieces = split_registered(spark, tokens)(F.col("text"))
    want = F.flatten(F.transform(pieces, lambda s: F.when(s["token"], F.array(s["text"])).otherwise(words(s["text"]))))
    got = registered_words(spark, tokens, word_pattern())(F.col("text"))
    rows = df.select(want.alias("want"), got.alias("got")).collect()
    assert len(rows) == len(odd) and all(r.want == r.got for r in rows)


def test_registered_words_do_not_pass_the_scanner_as_pieces(spark, texts):
    from quillspark.operators import encode as E
    from quillspark.operators.vocabulary import add_tokens, build_vocabulary

    df = texts("the one")
    vocab = add_tokens(build_vocabulary(df, 10), ["e"]).persist()
    plan = E.encode(df, vocab)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


@given(st.lists(st.one_of(st.none(), st.text("ab é", max_size=9)), max_size=12), st.integers(1, 30))
@settings(max_examples=100, deadline=None)
def test_rows_are_taken_a_few_bytes_at_a_time(texts, size):
    from quillspark.operators.scanner import _row_cuts

    sizes = [len((t or "").encode()) for t in texts]
    array = pa.array([None, "before", *texts], pa.string())[2:]
    cuts = list(_row_cuts(array, size))
    assert [i for a, b in cuts for i in range(a, b)] == list(range(len(texts)))
    assert all(a < b and (b == a + 1 or sum(sizes[a:b]) <= size) for a, b in cuts)


def test_a_task_holds_the_words_of_a_few_rows_and_not_of_a_batch(spark):
    from quillspark.operators.scanner import WORDS_BYTES, registered_words

    words = []

    def sizes(lists):
        words.append(len(lists.flatten()))
        return pc.list_value_length(lists)

    scan = registered_words(spark, ["e", "th"], word_pattern(), "<s>", 5, sizes, "int").func
    batch = pa.array([None, *["the one two"] * 300_000, ""], pa.string())
    given_back = [len(part) for part in scan(iter([batch, batch[:0], batch[:2]]))]
    assert sum(given_back) == len(batch) + 2 and max(given_back) <= WORDS_BYTES / len("the one two") + 3
    assert max(words) <= 5 * max(given_back)  # cut before they are looked up


def test_words_do_not_leave_the_worker_between_scan_and_lookup(spark, base):
    vocab = store(add_tokens(base, ["e"]), "vocabulary")
    df = spark.createDataFrame([(1, "the one")], "doc_id bigint, text string")
    plan = encode(df, vocab, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_numbers_are_written_a_few_rows_at_a_time():
    ids = pa.array([[1, 20, 3] * 1000, None, []] * 2000, pa.list_(pa.int32()))
    mask = pa.array([[1, 1, 1] * 1000, None, []] * 2000, pa.list_(pa.int32()))
    parts = list(numbers_text("ids", "mask").func(iter([(ids, mask), (ids[:0], mask[:0])])))
    assert max(len(p) for p in parts) < 1100
    for name, lists in (("ids", ids), ("mask", mask)):
        got = [row[name] for part in parts for row in part.to_pylist()]
        assert got == [None if r is None else " ".join(map(str, r)) for r in lists.to_pylist()]
