import json

import pytest
from pyspark.sql import functions as F

from quillspark.operators import predict as P
from quillspark.sources.prompts import read_prompt_lines, write_prediction_lines
from quillspark.streaming.prompts import predict_folder

GREEDY = P.GenerationParameters(temperature=0.0)


def _local_echo():
    """A nested function travels to the workers by value; this module is not there."""

    def factory():
        return lambda texts, parameters: [f"[{t}]" for t in texts]

    return factory


echo = _local_echo()


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def predicted(spark, *values):
    return [json.loads(r.value) for r in P.predict_lines(lines(spark, *values), echo, GREEDY).collect()]


GOOD = [
    '{"prompt":"p","k":1}',
    '{"messages":[{"role":"user","content":"hi"}],"prompt":"ignored"}',
    '{"response":"old","prompt":"q","x":{"b":[1,null],"a":2.5}}',
    '{"prompt":"naïve 😀 日本","n":12345678901234567890}',
    ' {"prompt":"quote \\" and \\\\ and \\n"}\u3000',
    '{"prompt":"first","prompt":"last"}',
    '{"response":"r","prompt":"first","prompt":"last"}',
    '{"messages":[]}',
]
BAD = [
    "{bad",
    '{"k":1}',
    "[1]",
    '"text"',
    "null",
    '{"prompt":5}',
    '{"prompt":null}',
    '{"messages":null,"prompt":"p"}',
    '{"messages":[{"role":"user"}]}',
    '{"messages":"text"}',
    '{"prompt":"a"} trailing',
    '{"prompt":"a"}{"prompt":"b"}',
    '{"prompt":"a"},{"prompt":"b"}',
    '{"prompt":"a"}] [{}',
    '{"prompt":"a"}} {',
]


def test_records_pass_through_with_their_response(spark):
    got = predicted(spark, *GOOD, "", "   ", "\u2003\u0085")
    assert len(got) == len(GOOD)
    open_header = "<|start_header_id|>assistant<|end_header_id|>\n\n"
    texts = ["p", None, "q", "naïve 😀 日本", 'quote " and \\ and \n', "last", "last", open_header]
    texts[1] = f"<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nhi<|eot_id|>{open_header}"
    for record, line, text in zip(got, GOOD, texts):
        assert record == {**json.loads(line.strip()), "response": f"[{text}]"}


def test_number_formats_and_key_order_survive(spark):
    line = '{"z":1.0,"prompt":"p","a":{"y":1e5,"b":2}}'
    (row,) = P.predict_lines(lines(spark, line), echo, GREEDY).collect()
    assert row.value == line[:-1] + ',"response":"[p]"}'


def test_null_response_is_written(spark):
    df = lines(spark, '{"prompt":"p"}').select(
        P.with_response(F.col("value"), F.lit(None).cast("string")).alias("value")
    )
    assert json.loads(df.first().value) == {"prompt": "p", "response": None}


NUMBERS = '{"n":[1.50,1e400,-0,123456789012345678901234567890123456789012345],"prompt":"p"'


@pytest.mark.parametrize("old", ["", ',"response":"old"', ',"response":{"a":[1,"}"]}'])
@pytest.mark.parametrize("constant", ["", ',"c":[NaN,-Infinity,Infinity]'])
def test_numbers_stay_as_written(spark, old, constant):
    line = NUMBERS + old + constant + "}"
    (row,) = P.predict_lines(lines(spark, line), echo, GREEDY).collect()
    assert row.value == NUMBERS + constant + ',"response":"[p]"}'


def test_lines_need_not_be_stripped(spark):
    rendered = P.render_prompts(lines(spark, '{"prompt":"q"}  ', ' {"prompt":"r" } '))
    got = P.prediction_lines(P.generate(P.fail_on_error(rendered), echo, GREEDY)).collect()
    assert [json.loads(r.value)["response"] for r in got] == ["[q]", "[r]"]


def test_very_long_lines(spark):
    df = spark.range(1).select(
        F.concat(F.lit('{"x":"'), F.repeat(F.lit("ab\\n "), F.lit(26_000_000)), F.lit('","prompt":"p"}')).alias("value")
    )
    predicted_rows = P.predict_lines(df, echo, GREEDY)
    row = predicted_rows.select(F.length("value").alias("n"), F.right("value", F.lit(20)).alias("end")).first()
    assert row.n > 130_000_000 and row.end == '"p","response":"[p]"}'[-20:]


def test_results_are_counted(spark):
    with pytest.raises(Exception, match="results for"):
        P.predict_lines(lines(spark, '{"prompt":"a"}'), lambda: lambda texts, p: [], GREEDY).collect()
    prompts = spark.createDataFrame([(1, [1, 2]), (2, [])], "id int, input_ids array<int>")
    sizes = spark.sparkContext.accumulator(0)

    def open_model():
        def run(rows, parameters):
            sizes.add(len(rows) > 1)
            return [r + [9] for r in rows]

        return run

    got = P.generate_tokens(prompts, open_model, GREEDY, batch_size=1).collect()
    assert {r.id: r.output_ids for r in got} == {1: [1, 2, 9], 2: [9]} and sizes.value == 0


@pytest.mark.parametrize("line", BAD)
def test_unusable_lines_stop_the_job(spark, line):
    with pytest.raises(Exception, match="prompt line"):
        predicted(spark, '{"prompt":"fine"}', line)


def test_unusable_lines_can_be_set_aside(spark):
    rendered = P.render_prompts(P.drop_blank_lines(lines(spark, *GOOD, *BAD, " ")))
    usable, unusable = P.quarantine(rendered)
    assert usable.count() == len(GOOD)
    assert sorted(r.value for r in unusable.collect()) == sorted(BAD)
    assert {r.error for r in unusable.collect()} == {
        "not a JSON object",
        "neither messages nor prompt",
        "unusable messages",
        "unusable prompt",
    }


def test_lines_are_parsed_once_and_never_shuffled(spark):
    usable, _ = P.quarantine(P.render_prompts(P.drop_blank_lines(lines(spark, *GOOD))))
    plan = P.prediction_lines(P.generate(usable, echo))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "Exchange" not in plan


def test_predictor_is_opened_once_per_task_and_sees_the_parameters(spark):
    opened = spark.sparkContext.accumulator(0)

    def factory():
        opened.add(1)
        return lambda texts, p: [f"{p.max_new_tokens} {p.top_p} {p.do_sample}" for _ in texts]

    prompts = spark.range(0, 1000, 1, 3).select(F.col("id").cast("string").alias("text"))
    rows = P.generate(prompts, factory).collect()
    assert {r.response for r in rows} == {"1024 0.9 True"} and opened.value == 3
    assert not P.GenerationParameters(temperature=0).do_sample


def test_files_in_and_out(spark, tmp_path):
    source = tmp_path / "prompts.jsonl"
    source.write_text('{"prompt":"é"}\n\n   \n{"prompt":"b","k":[1]}\r\n', encoding="utf-8")
    target = tmp_path / "deep" / "er" / "predictions"
    write_prediction_lines(
        P.predict_lines(read_prompt_lines(spark, str(source)), echo, GREEDY), str(target)
    )
    text = "".join(p.read_text(encoding="utf-8") for p in target.glob("part-*"))
    assert [json.loads(x) for x in text.splitlines()] == [
        {"prompt": "é", "response": "[é]"},
        {"prompt": "b", "k": [1], "response": "[b]"},
    ]
    assert "é" in text


def test_folder_inference_sets_unusable_lines_aside(spark, tmp_path):
    prompts, output, rejected = (tmp_path / n for n in ("prompts", "predictions", "rejected"))
    prompts.mkdir()
    (prompts / "1.jsonl").write_text('{"prompt":"a"}\nbroken\n{"k":1}\n')
    for _ in range(2):
        predict_folder(
            spark, str(prompts), str(output), str(tmp_path / "state"), echo, GREEDY, rejected=str(rejected)
        ).awaitTermination()
    assert [json.loads(r.value)["response"] for r in spark.read.text(str(output)).collect()] == ["[a]"]
    bad = spark.read.schema("value string, error string").json(str(rejected)).collect()
    assert {(r.value, r.error) for r in bad} == {
        ("broken", "not a JSON object"),
        ('{"k":1}', "neither messages nor prompt"),
    }


def test_folder_inference_resumes(spark, tmp_path):
    prompts, output = tmp_path / "prompts", tmp_path / "predictions"
    prompts.mkdir()

    def run():
        predict_folder(
            spark, str(prompts), str(output), str(tmp_path / "state"), echo, GREEDY, files_per_batch=1
        ).awaitTermination()
        return sorted(json.loads(r.value)["response"] for r in spark.read.text(str(output)).collect())

    (prompts / "1.jsonl").write_text('{"prompt":"a"}\n{"prompt":"b"}\n')
    (prompts / "2.jsonl").write_text('\n{"prompt":"c"}\n')
    assert run() == ["[a]", "[b]", "[c]"]
    (prompts / "3.jsonl").write_text('{"prompt":"d"}\n')
    assert run() == ["[a]", "[b]", "[c]", "[d]"]
