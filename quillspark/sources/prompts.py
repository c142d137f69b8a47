"""Line-oriented prompt input and the outputs of inference and tokenisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.operators.mapping import tensor_columns
from quillspark.operators.predict import drop_blank_lines

#: Where a line stands: its file, the start of the range it was read in, its place in that range.
PLACE = ("file", "range", "line")


def read_prompt_lines(spark: SparkSession, path: str | list[str], places: bool = False) -> DataFrame:
    """One stripped JSON object text per row (``value``); blank lines are skipped.

    With ``places`` the rows carry PLACE, whose order is that of the files by name and of the
    lines within them. A range is read by one task from start to end, so the numbers that Spark
    gives its rows rise within it.
    """
    lines = spark.read.text(path)
    if places:
        source = [
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("range"),
            F.monotonically_increasing_id().alias("line"),
        ]
        lines = lines.select(*source, "value")
    return drop_blank_lines(lines)


def write_prediction_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of JSONL part files, UTF-8 without escapes; missing parents are created."""
    lines.select("value").write.mode(mode).text(path)


def write_ordered_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Part files that give the lines in the order of their places when read by name, one after
    the other, and a manifest.

    The lines are range partitioned once by PLACE; no task sorts more than its own part. The
    manifest, in ``path/_manifest``, has a JSON row for every part file: its name, its lines and
    the number of lines before it.
    """
    ordered = lines.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    ordered.select("value").write.mode(mode).text(path)
    written = lines.sparkSession.read.text(path).groupBy(F.col("_metadata.file_name").alias("part"))
    # one row per part file
    parts = sorted((r.part, r.n) for r in written.agg(F.count(F.lit(1)).alias("n")).collect())
    rows, before = [], 0
    for part, n in parts:
        rows.append((part, n, before))
        before += n
    manifest = lines.sparkSession.createDataFrame(rows, "part string, lines bigint, first bigint")
    manifest.coalesce(1).write.mode(mode).json(f"{path.rstrip('/')}/_manifest")


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(number, value): the lines of write_ordered_lines with their place over all files, from 0."""
    manifest = spark.read.schema("part string, lines bigint, first bigint").json(f"{path.rstrip('/')}/_manifest")
    # a range holds a part of a file; its lines are numbered on from the ranges before it
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    ranges = lines.groupBy("part", "range").agg(F.min("line").alias("base"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    starts = ranges.withColumn("before", before).join(manifest, "part")
    starts = starts.select("part", "range", "base", (F.col("first") + F.col("before")).alias("start"))
    placed = lines.join(F.broadcast(starts), ["part", "range"])
    return placed.select((F.col("start") + F.col("line") - F.col("base")).alias("number"), "value")


def write_tokens(
    df: DataFrame,
    path: str,
    columns: tuple[str, ...] = ("input_ids", "attention_mask"),
    mode: str = "errorifexists",
) -> None:
    """Token columns as parquet shards."""
    tensor_columns(df, columns).write.mode(mode).parquet(path)
