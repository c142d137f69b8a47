import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.mapping import map_batches, merge_columns, replace_columns, tensor_columns
from quillspark.sources.corpus import read_corpus, read_json, read_qa, read_sft
from quillspark.sources.prompts import write_tokens
from quillspark import schemas

LAYOUTS = {
    "pretty": '\n[\n  {"text": "a",\n   "x": [1, 2]},\n  {"text": "b\\n"}\n]\n',
    "one_line": '[{"text":"a","x":[1,2]},{"text":"b\\n"}]\n',
    "lines": '{"text":"a","x":[1,2]}\n\n   {"text":"b\\n"}\n',
}


@pytest.fixture
def folder(tmp_path):
    for name, content in LAYOUTS.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "data.json").write_text(content)
    return tmp_path


@pytest.mark.parametrize("layout", LAYOUTS)
def test_three_layouts_read_the_same(spark, folder, layout):
    df = read_corpus(spark, str(folder / layout / "data.json"))
    assert df.columns == ["text"]
    assert [r.text for r in df.collect()] == ["a", "b\n"]


def test_mixed_folder(spark, folder):
    paths = [str(folder / name) for name in LAYOUTS]
    rows = read_corpus(spark, paths, layout="array").collect()
    assert sorted(r.text for r in rows) == ["a"] * 3 + ["b\n"] * 3


@pytest.mark.parametrize("order", [("pretty", "lines"), ("lines", "pretty"), ("one_line", "lines")])
def test_each_file_has_its_own_layout(spark, tmp_path, order):
    for i, name in enumerate(order):
        more = '{"text":"c"}\n' * 500 if name == "lines" else ""
        (tmp_path / f"{i} a.json").write_text(LAYOUTS[name] + more)
    rows = sorted(r.text for r in read_corpus(spark, str(tmp_path)).collect())
    assert rows == sorted(["a", "b\n"] * 2 + ["c"] * 500)


def test_line_files_beside_lists_are_still_split(spark, tmp_path):
    (tmp_path / "0.json").write_text(LAYOUTS["pretty"])
    (tmp_path / "1.json").write_text('{"text":"c"}\n' * 200_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = read_corpus(spark, str(tmp_path))
        parts = df.select(F.spark_partition_id().alias("p")).distinct().count()
        assert df.count() == 200_002 and parts > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("content", ['{"text":"%s"}', '[\n{"text":"%s"}\n]'])
def test_long_texts(spark, tmp_path, content):
    (tmp_path / "data.json").write_text(content % ("x" * 21_000_000))
    assert read_corpus(spark, str(tmp_path)).select(F.length("text")).first()[0] == 21_000_000


@pytest.mark.parametrize(
    "content",
    [
        '{"text":"a"}\n{"text',
        '{"text":"a"} tail',
        '{"text":"a"}{"text":"b"}',
        '{"text":"a"}] [{}',
        '[\n{"text":"a"}\n]\n[{"text":"b"}]',
        "5",
        "null",
    ],
)
def test_anything_else_stops_the_job(spark, tmp_path, content):
    path = tmp_path / "data.json"
    path.write_text(content)
    with pytest.raises(Exception, match="not a JSON record|MALFORMED"):
        read_corpus(spark, str(path)).collect()


def test_list_file_is_not_skipped_among_lines(spark, folder):
    with pytest.raises(Exception, match="not a JSON record"):
        read_corpus(spark, str(folder / "pretty"), layout="lines").collect()
    with pytest.raises(ValueError):
        read_corpus(spark, str(folder / "pretty"), layout="other")


def test_empty_file(spark, tmp_path):
    (tmp_path / "data.json").write_text("\n \n")
    assert read_corpus(spark, str(tmp_path / "data.json")).collect() == []


def test_sft_and_missing_fields(spark, tmp_path):
    (tmp_path / "sft.json").write_text('{"instruction":"i","reference":"r","extra":1}\n')
    (row,) = read_sft(spark, str(tmp_path / "sft.json")).collect()
    assert row.instruction == "i" and row.system_prompt is None
    assert len(row) == 5


def test_qa_splits(spark, tmp_path):
    df = spark.createDataFrame([("q", "a #### 1")], schemas.QA)
    df.write.parquet(str(tmp_path / "train"))
    df.write.json(str(tmp_path / "test"))
    assert read_qa(spark, str(tmp_path)).collect() == df.collect()
    assert read_qa(spark, str(tmp_path), "test", "json").collect() == df.collect()
    with pytest.raises(ValueError):
        read_qa(spark, str(tmp_path), "test", "orc")


def test_token_shards(spark, tmp_path):
    df = spark.createDataFrame([([1, 2], [1, 1], "x")], "input_ids array<int>, attention_mask array<int>, text string")
    write_tokens(df, str(tmp_path / "tokens"))
    back = spark.read.parquet(str(tmp_path / "tokens"))
    assert back.columns == ["input_ids", "attention_mask"] == tensor_columns(df).columns
    assert back.first().input_ids == [1, 2]
    with pytest.raises(Exception, match="already exists"):
        write_tokens(df, str(tmp_path / "tokens"))


def test_column_maps(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    merged = merge_columns(df, {"a": F.col("a") + 10, "c": F.col("a") + F.col("b")})
    # all new columns see the input row, as a mapped record does
    assert merged.first().asDict() == {"a": 11, "b": 2, "c": 3}
    assert replace_columns(df, {"c": F.col("b")}).first().asDict() == {"c": 2}


def test_replaced_columns_prune_the_scan(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = replace_columns(documents, {"n": F.length("text")})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan


def test_batch_callback(spark):
    df = spark.createDataFrame([(1, "a", [1, 2]), (2, "b", None)], "id int, text string, xs array<int>")

    def double(columns):
        assert set(columns) == {"id", "text", "xs"}
        return {"text": [t * 2 for t in columns["text"]], "n": [len(x or []) for x in columns["xs"]]}

    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())])
    out = map_batches(df, double, schema, remove_columns=["xs"])
    assert out.columns == ["id", "text", "n"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "aa", 2), (2, "bb", 0)]


def test_read_json_takes_any_schema(spark, folder):
    schema = T.StructType([T.StructField("x", T.ArrayType(T.LongType()))])
    rows = read_json(spark, str(folder / "lines"), schema).collect()
    assert [r.x for r in rows] == [[1, 2], None]


def test_map_on_arrow_arrays(spark):
    import pyarrow.compute as pc

    df = spark.createDataFrame([("ab", 1), (None, 2)], "text string, n int")
    schema = T.StructType([T.StructField("size", T.LongType())])
    got = map_batches(df, lambda c: {"size": pc.utf8_length(c["text"])}, schema, ["text"], arrow=True)
    assert sorted(map(tuple, got.collect())) == [(1, 2), (2, None)]
