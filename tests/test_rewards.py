import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import rewards as R
from quillspark.functions.text import WHITESPACE, WHITESPACE_CLASS, last_piece, occurs_once, strip

TEXT = F.col("text")
PERFECT = "<think>\na\n</think>\n<answer>\n4\n</answer>\n"

# text, extracted, xmlcount, soft, strict, numeric, correct (answer is "4"), total
ROLLOUTS = [
    (PERFECT, "4", 0.5, 0, 0.5, 0.5, 2.0, 3.5),
    (PERFECT[:-1], "4", 0.462, 0, 0, 0.5, 2.0, 2.962),
    ("<think>a</think>\n<answer>4</answer>", "4", 0.0, 0.5, 0, 0.5, 2.0, 3.0),
    (PERFECT + "xyz", "4", 0.494, 0, 0, 0.5, 2.0, 2.994),
    ("42", "42", 0.0, 0, 0, 0.5, 0, 0.5),
    ("<answer>1</answer> junk <answer>2", "2", 0.0, 0, 0, 0.5, 0, 0.5),
    ("a</answer>b", "a", 0.0, 0, 0, 0, 0, 0.0),
    ("", "", 0.0, 0, 0, 0, 0, 0.0),
    ("x\n<answer>\n7", "7", 0.113, 0, 0, 0.5, 0, 0.613),
]
NUMERIC = "-42|3.14|1,000|1_000|nan|-inf|+Infinity| 1 |1e5|1.|.5|+1.5E-3|١٢".split("|")
NOT_NUMERIC = "|.|-|1d|1f|0x1p3|1__0|_1|1e|--1|1e_5|1 0|$5|50%".split("|")


def completions(spark, texts, answer="4"):
    rows = [(i, [("assistant", t)], answer) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "i int, completion array<struct<role string, content string>>, answer string"
    )


def test_rollout_table(spark):
    from quillspark.operators.rollouts import score

    scored = score(completions(spark, [r[0] for r in ROLLOUTS]))
    extracted = R.extract_xml_answer(R.completion_text(F.col("completion")))
    rows = scored.select("*", extracted.alias("extracted")).orderBy("i").collect()
    for row, (_, want, *rewards) in zip(rows, ROLLOUTS):
        assert row.extracted == want
        got = [row.xmlcount, row.soft_format, row.strict_format, row.numeric, row.correctness]
        assert [round(v, 6) for v in [*got, row.reward]] == rewards


def test_null_answer_earns_nothing(spark):
    df = completions(spark, [PERFECT], answer=None)
    reward = R.correctness_reward(F.col("completion"), F.col("answer"))
    assert df.select(reward).first()[0] == 0.0


def test_only_first_message_counts(spark):
    df = completions(spark, ["1"]).withColumn(
        "completion", F.concat("completion", F.array(F.struct(F.lit("x").alias("role"), F.lit("y").alias("content"))))
    )
    assert df.select(R.completion_text(F.col("completion"))).first()[0] == "1"


def test_numeric_rule(evaluate):
    assert evaluate(R.is_numeric(TEXT), *NUMERIC) == [True] * len(NUMERIC)
    assert evaluate(R.is_numeric(TEXT), *NOT_NUMERIC) == [False] * len(NOT_NUMERIC)


def test_numeric_rule_survives_long_digit_runs(evaluate):
    long = "1_" * 200_000
    assert evaluate(R.is_numeric(TEXT), long + "1", long) == [True, False]


def test_numeric_rule_agrees_with_float(evaluate):
    chosen = random.Random(1)
    pieces = list("0189._+-eE \u00a0\u2003\u0663naifty")
    samples = ["".join(chosen.choices(pieces, k=chosen.randint(0, 7))) for _ in range(4000)]

    def accepted(text):
        try:
            return float(text) is not None
        except ValueError:
            return False

    assert evaluate(R.is_numeric(TEXT), *samples) == [accepted(s) for s in samples]


def test_digits_rule_agrees_with_isdigit(evaluate):
    samples = ["", "12", "-1", "1 2", "²", "٣٤", "①", "½", "x", "1.0", "𝟗", "1\n"]
    assert evaluate(R.is_digits(TEXT), *samples) == [s.isdigit() for s in samples]


def test_format_patterns_agree_with_re(evaluate):
    strict = re.compile(R.STRICT_FORMAT.removeprefix("(?d)"))
    soft = re.compile(R.SOFT_FORMAT.removeprefix("(?d)").replace(WHITESPACE_CLASS, r"\s"))
    samples = [
        PERFECT,
        PERFECT + "\n",
        PERFECT + "\n\n",
        PERFECT.replace("a", "a\r\u2028\u0085b"),
        PERFECT.replace("a", "a\nb"),
        " " + PERFECT,
        PERFECT[:-1] + "\r",
        *[f"<think>a</think>{gap}<answer>b</answer>" for gap in (*WHITESPACE, "", "x", "\u200b")],
        "<think>a\nb</think><answer>c</answer>",
        "<think>a\rb</think><answer>c\u2028</answer> tail\n",
        "<think></think><answer></answer>",
        "<think>a</think><answer>b",
    ]
    assert evaluate(TEXT.rlike(R.STRICT_FORMAT), *samples) == [bool(strict.match(s)) for s in samples]
    assert evaluate(TEXT.rlike(R.SOFT_FORMAT), *samples) == [bool(soft.match(s)) for s in samples]


@pytest.mark.parametrize(
    "text, want",
    [
        ("work\n#### 42", "42"),
        ("x #### 1,000\n", "1,000"),
        ("a####b####c", "b"),
        ("#####", "#"),
        ("no marker", None),
        ("########", ""),
    ],
)
def test_hash_answer(evaluate, text, want):
    assert evaluate(R.extract_hash_answer(TEXT), text) == [want]


def test_whitespace_set_is_what_python_strips(evaluate):
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    samples = [f"{w}a{w}b{w}" for w in WHITESPACE] + ["\u200ba\u200b", ""]
    assert evaluate(strip(TEXT), *samples) == [s.strip() for s in samples]


TAGGED = st.lists(
    st.sampled_from(
        ["<think>", "</think>", "<answer>", "</answer>", "\n", "\n", " ", "7", "é", "😀", "####"]
    ),
    max_size=14,
).map("".join)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TAGGED, min_size=200, max_size=200))
def test_reward_properties(texts, samples):
    df = texts(*samples).select(
        "i",
        "text",
        R.xml_score(TEXT).alias("xml"),
        TEXT.rlike(R.SOFT_FORMAT).alias("soft"),
        TEXT.rlike(R.STRICT_FORMAT).alias("strict"),
        R.extract_xml_answer(TEXT).alias("answer"),
        last_piece(TEXT, "\n</answer>\n").alias("tail"),
        occurs_once(TEXT, "\n<answer>\n").alias("once"),
    )
    for row in df.collect():
        assert row.xml <= 0.5 + 0.001 + 1e-9
        assert not (row.soft and row.strict)
        after_tag = row.text.rpartition("<answer>")[2]
        assert row.answer == after_tag.partition("</answer>")[0].strip()
        assert row.tail == row.text.split("\n</answer>\n")[-1]
        assert row.once == (row.text.count("\n<answer>\n") == 1)
