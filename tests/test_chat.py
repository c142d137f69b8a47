import pytest
from pyspark.sql import functions as F

from quillspark.functions.chat import DRAFT, LLAMA3, reasoning_target, render, rl_prompt
from quillspark.operators.mapping import format_qa, format_sft
from quillspark.plans.inputs import conversation_texts
from quillspark import schemas

MESSAGES = "array<struct<role string, content string>>"


def rendered(spark, messages, **options):
    df = spark.createDataFrame([(messages,)], f"m {MESSAGES}")
    return df.select(render(F.col("m"), **options)).first()[0]


def test_render_headers_and_trimming(spark):
    got = rendered(spark, [("system", " s\n"), ("user", "\u3000u")])
    assert got == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\ns<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\nu<|eot_id|>"
    )


def test_render_open_header(spark):
    got = rendered(spark, [("user", "u")], add_generation_prompt=True)
    assert got.endswith("u<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n")
    assert got.endswith(LLAMA3.response_marker)


def test_render_draft_format(spark):
    got = rendered(spark, [("user", "u")], template=DRAFT, add_generation_prompt=True)
    assert got == (
        "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\nu<|end_of_text|>"
        "    <|start_header_id|>assistant<|end_header_id|>"
    )


@pytest.mark.parametrize("messages", [[("user", None)], [(None, "x")], [("user", "a"), None]])
def test_render_never_leaves_out_a_message(spark, messages):
    assert rendered(spark, messages) is None


def test_render_without_messages(spark):
    assert rendered(spark, []) == ""


SFT_ROWS = [
    ("s", "i", "r", "think", "out"),
    ("s", "i", "r", "think", None),
    ("系统", "指示", "参考", "推理", "答案"),
    ("s", None, "r", "think", "out"),
    (None, "i", "r", None, "out"),
]


def test_sft_text_and_rejected_rows(spark):
    text, rejected = format_sft(spark.createDataFrame(SFT_ROWS, schemas.SFT))
    rows = [r.text for r in text.collect()]
    assert len(rows) == 2 and rejected.count() == 3
    assert "<|end_header_id|>\n\ni\nr<|eot_id|>" in rows[0]
    assert "<think>think</think>\n<answer>out</answer><|eot_id|>" in rows[0]
    assert "<think>推理</think>\n<answer>答案</answer>" in rows[1]


def test_sft_compat_prints_missing_targets(spark):
    text, rejected = format_sft(spark.createDataFrame(SFT_ROWS, schemas.SFT), compat=True)
    rows = [r.text for r in text.collect()]
    assert len(rows) == 4 and rejected.count() == 1
    assert "<answer>None</answer>" in rows[1]
    assert "\n\nNone<|eot_id|>" in rows[3] and "<think>None</think>" in rows[3]


def test_target_layouts(spark):
    df = spark.range(1).select(
        reasoning_target(F.lit("r"), F.lit("a")).alias("inline"),
        reasoning_target(F.lit("r"), F.lit("a"), "block").alias("block"),
    )
    assert tuple(df.first()) == (
        "<think>r</think>\n<answer>a</answer>",
        "<think>\nr\n</think>\n<answer>\na\n</answer>\n",
    )
    with pytest.raises(ValueError):
        reasoning_target(F.lit("r"), F.lit("a"), "other")


def test_qa_merge_overwrites_answer(spark):
    df = format_qa(spark.createDataFrame([("q", "w #### 7 "), ("p", "none")], schemas.QA))
    first, second = df.orderBy(F.desc("question")).collect()
    assert df.columns == ["question", "answer", "prompt"]
    assert (first.question, first.answer, second.answer) == ("q", "7", None)
    assert [m.role for m in first.prompt] == ["system", "user"]
    assert first.prompt[0].content.startswith("\nRespond in the following format:\n<think>\n")
    assert first.prompt[1].content == "q"


def test_rl_prompt_is_narrow(spark):
    df = spark.createDataFrame([("q",)], "question string")
    plan = df.select(rl_prompt(F.col("question")))._jdf.queryExecution().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("first", [0, 5])
def test_long_conversations_are_one_text(spark, first):
    turns = spark.range(first, first + 3000).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.lit("user").alias("role"),
        F.concat(F.lit("t"), "id").alias("text"),
    )
    other = spark.createDataFrame(
        [(2, 0, "user", "x"), (3, 0, "user", None), (3, 1, "user", "y")],
        "conv_id int, turn long, role string, text string",
    )
    got = conversation_texts(turns.unionByName(other), turns_per_part=100)
    assert got.columns == ["conv_id", "text"]
    rows = {r.conv_id: r.text for r in got.collect()}
    want = "<|begin_of_text|>" + "".join(
        f"<|start_header_id|>user<|end_header_id|>\n\nt{i}<|eot_id|>" for i in range(first, first + 3000)
    )
    assert rows[1] == want and rows[3] is None and rows[2].startswith("<|begin_of_text|>")
