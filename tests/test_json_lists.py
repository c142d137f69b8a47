import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.sources.corpus import read_json
from quillspark.sources.json_lists import pieces, read_lists

SCHEMA = T.StructType.fromDDL("text string, x array<struct<y: string>>, n bigint")
ODD = ['"', "\\", "}", "{", "[", "]", ",", "\n", "é", "😀", " ", "\\\"", "}]", "a", "b", " ", "\\\\", "\x01"]


@pytest.fixture
def ranges(spark):
    """Reads in ranges of so many bytes."""
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")

    def cut(size):
        spark.conf.set(key, str(size))

    yield cut
    spark.conf.set(key, before)


def records(n, seed, most=40):
    draw = random.Random(seed)

    def text():
        return "".join(draw.choices(ODD, k=draw.randint(0, most)))

    return [
        {"text": draw.choice([text(), None]), "x": [{"y": text()} for _ in range(draw.randint(0, 2))], "n": i}
        for i in range(n)
    ]


def wanted(rows):
    return sorted((r["n"], r["text"], tuple(x["y"] for x in r["x"])) for r in rows)


def read(spark, path):
    rows = read_json(spark, str(path), SCHEMA).collect()
    return sorted((r.n, r.text, tuple(x.y for x in r.x)) for r in rows)


@pytest.mark.parametrize("indent,ascii,size", [(None, True, 60), (2, False, 60), (None, False, 500), (2, True, 500), (2, False, 10**7)])
def test_lists_read_as_the_whole_file_does(spark, tmp_path, ranges, indent, ascii, size):
    rows = records(80 if size < 100 else 300, size)
    content = json.dumps(rows, indent=indent, ensure_ascii=ascii)
    (tmp_path / "data.json").write_text(content)
    ranges(size)
    if size < 1000:
        parts = pieces(spark, str(tmp_path)).select("start").distinct().count()
        assert parts > len(content) / size / 8
    assert read(spark, tmp_path) == wanted(json.loads(content))


def test_many_files_of_both_kinds(spark, tmp_path, ranges):
    every = []
    for i in range(4):
        rows = records(50, i)
        for r in rows:
            r["n"] += 1000 * i
        every += rows
        lines = "\n".join(json.dumps(r) for r in rows)
        (tmp_path / f"{i} data.json").write_text(lines if i % 2 else json.dumps(rows, indent=1))
    ranges(200)
    assert read(spark, tmp_path) == wanted(every)


def test_a_record_over_many_ranges(spark, tmp_path, ranges):
    rows = [{"text": "}" * 5000 + "\\\"" * 50, "x": [{"y": "{[" * 500}], "n": i} for i in range(3)]
    (tmp_path / "data.json").write_text(json.dumps(rows))
    ranges(100)
    assert read(spark, tmp_path) == wanted(rows)


@pytest.mark.parametrize("content", ["[]", " [ ]\n", "\n[\n\n]\n \n"])
def test_empty_lists(spark, tmp_path, content):
    (tmp_path / "data.json").write_text(content)
    assert read(spark, tmp_path) == []


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "data.json").write_bytes(b'\xef\xbb\xbf[{"n":1,"x":[]}]')
    assert read(spark, tmp_path) == [(1, None, ())]


BROKEN = {
    "trailing text": '[{"n":1},{"n":2}] x',
    "trailing brace": '[{"n":1},{"n":2}]}',
    "trailing record": '[{"n":1},{"n":2}] {"n":3}',
    "second list": '[{"n":1},{"n":2}]\n[{"n":3}]',
    "no end": '[{"n":1},{"n":2}',
    "no end after a comma": '[{"n":1},{"n":2},',
    "torn record": '[{"n":1},{"n":2',
    "torn string": '[{"n":1},{"n":"2}]',
    "no comma": '[{"n":1} {"n":2}]',
    "two commas": '[{"n":1},,{"n":2}]',
    "comma at the end": '[{"n":1},{"n":2},]',
    "comma at the start": '[,{"n":1}]',
    "number": '[{"n":1},2]',
    "null": '[null,{"n":1}]',
    "inner list": '[[{"n":1}]]',
    "text between": '[{"n":1}, x {"n":2}]',
    "bad value": '[{"n":1},{"n":tru}]',
    "mixed brackets": '[{"n":1},{"x":[1}]]',
}


@pytest.mark.parametrize("name,size", [*((n, 8) for n in BROKEN), ("trailing text", 10**6), ("number", 10**6), ("no comma", 10**6)])
def test_anything_else_stops_the_job(spark, tmp_path, ranges, name, size):
    (tmp_path / "data.json").write_text(BROKEN[name])
    ranges(size)
    with pytest.raises(Exception, match="not a JSON record|MALFORMED"):
        read(spark, tmp_path)


def test_ranges_are_read_by_many_tasks(spark, tmp_path, ranges):
    rows = [{"text": "x" * 100, "x": [], "n": i} for i in range(20_000)]
    (tmp_path / "data.json").write_text(json.dumps(rows))
    ranges(100_000)
    df = read_lists(spark, str(tmp_path / "data.json"), SCHEMA)
    assert df.count() == 20_000 and df.agg(F.sum("n")).first()[0] == sum(range(20_000))
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 20


def test_changed_splits_are_noticed(spark, tmp_path, ranges):
    (tmp_path / "data.json").write_text(json.dumps(records(200, 3)))
    ranges(1000)
    df = read_lists(spark, str(tmp_path / "data.json"), SCHEMA)
    ranges(300)
    with pytest.raises(Exception, match="splits of the files changed"):
        df.select("n").collect()
