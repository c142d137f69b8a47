"""JSON and parquet inputs with declared schemas."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark import schemas
from quillspark.functions.text import is_blank, strip
from quillspark.sources.json_lists import pieces, read_lists

LAYOUTS = ("auto", "lines", "array")


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType, layout: str = "auto"
) -> DataFrame:
    """Records from newline-delimited JSON and from files holding a top-level list.

    ``auto`` and ``array`` look at the first character of each file for the start of a list;
    ``lines`` takes every file as lines. Line files are read in splits, and so are lists, whatever
    their size and however their lines are laid out (see json_lists). Anything that is not a record
    stops the job, so trailing text is never skipped silently.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    lists, others = ([], path) if layout == "lines" else _layouts(spark, path)
    frames = []
    if others or not lists:
        lines = spark.read.text(others or path).where(~is_blank(F.col("value")))
        frames.append(lines.select(F.inline(_records(strip(F.col("value")), schema))))
    if lists:
        frames.append(read_lists(spark, lists, schema))
    return reduce(DataFrame.unionByName, frames)


def _layouts(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    """List files and other files, by their first character that is no white space.

    One name per file comes to the driver, as in any listing of the files.
    """
    texts = pieces(spark, path).where(~is_blank(F.col("value")))
    place = F.struct("start", F.monotonically_increasing_id())
    opens = F.startswith(strip(F.col("value")), F.lit("["))
    heads = texts.select("file", place.alias("place"), opens.alias("opens"))
    files = heads.groupBy("file").agg(F.min_by("opens", "place").alias("opens")).collect()
    named = sorted((unquote(r.file), r.opens) for r in files)
    return [f for f, is_list in named if is_list], [f for f, is_list in named if not is_list]


def _records(text: Column, schema: T.StructType) -> Column:
    """Records of a text that is one JSON object or one list of objects, as an array.

    from_json ignores what follows the first value. Inside brackets that is an error or a second
    element unless it closes the bracket itself, and inside braces that remainder is an error.
    """
    record = schema.simpleString()
    enclosed = F.concat(F.lit("["), text, F.lit("]"))
    strict = {"mode": "FAILFAST", "maxStringLen": str(2**31 - 1)}
    single = F.from_json(enclosed, F.lit(f"array<{record}>"), strict)
    nested = F.from_json(enclosed, F.lit(f"array<array<{record}>>"), strict)
    records = F.when(F.startswith(text, F.lit("[")), F.flatten(nested)).otherwise(single)
    keys = F.json_object_keys(F.concat(F.lit('{"r":'), text, F.lit("}")))
    whole = F.coalesce(keys == F.array(F.lit("r")), F.lit(False))
    nested_value = F.startswith(text, F.lit("[")) | F.startswith(text, F.lit("{"))
    return F.when(whole & nested_value, records).otherwise(
        F.raise_error(F.concat(F.lit("not a JSON record: "), text)).cast(f"array<{record}>")
    )


def read_corpus(spark: SparkSession, path: str | list[str], layout: str = "auto") -> DataFrame:
    """Pre-training records; other fields than ``text`` are not read."""
    return read_json(spark, path, schemas.CORPUS, layout)


def read_sft(
    spark: SparkSession, path: str | list[str] = "data/sft_data.json", layout: str = "auto"
) -> DataFrame:
    return read_json(spark, path, schemas.SFT, layout)


def read_qa(
    spark: SparkSession, folder: str, split: str = "train", file_format: str = "parquet"
) -> DataFrame:
    """A named split of a question/answer set, kept as ``folder/split``."""
    path = f"{folder.rstrip('/')}/{split}"
    if file_format == "json":
        return read_json(spark, path, schemas.QA)
    if file_format != "parquet":
        raise ValueError("file_format must be 'parquet' or 'json'")
    return spark.read.schema(schemas.QA).parquet(path)
