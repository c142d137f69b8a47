"""Reference-shaped input records derived from the given tables, row by row and in full."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.chat import LLAMA3, ChatTemplate, message, render

#: Turns put together in one step; it changes no result.
TURNS_PER_PART = 1024


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def sft_examples(spark: SparkSession, folder: str) -> DataFrame:
    """Five-column examples, one per document; the label is missing for French ones."""
    return table(spark, folder, "documents").select(
        "doc_id",
        F.concat(F.lit("You read "), F.col("lang"), F.lit(" text.")).alias("system_prompt"),
        F.concat(F.lit("Name the source among "), F.col("source")).alias("instruction"),
        F.col("text").alias("reference"),
        F.concat(F.lit("length "), F.col("n_chars")).alias("modified_reasoning"),
        F.when(F.col("lang") != "fr", F.col("source")).alias("formatted_label"),
    )


def qa_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Questions with a worked answer that ends in a marked final answer."""
    answer = F.concat("text", F.lit("\n#### "), F.format_string("%,d", F.col("item_id") * 1000))
    return table(spark, folder, "benchmark").select(
        "item_id", F.col("text").alias("question"), answer.alias("answer")
    )


def rollouts(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn as a completion in one of eight layouts, with the turn number as answer.

    Columns: prompt_id, gen_id, prompt, completion, answer.
    """
    reasoning = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    number = F.col("turn").cast("string")
    block = F.concat(
        F.lit("<think>\n"),
        reasoning,
        F.lit("\n</think>\n<answer>\n"),
        number,
        F.lit("\n</answer>\n"),
    )
    unended = F.concat(
        F.lit("<think>\n"),
        reasoning,
        F.lit("\n</think>\n<answer>\n"),
        number,
        F.lit("\n</answer>"),
    )
    inline = F.concat(
        F.lit("<think>"), reasoning, F.lit("</think>\n<answer>"), number, F.lit("</answer>")
    )
    twice = F.concat(
        F.lit("<answer>"), number, F.lit("</answer> "), "text", F.lit(" <answer>"), number
    )
    layouts: list[Column] = [
        block,
        unended,
        inline,
        F.concat(block, "text"),
        F.col("text"),
        twice,
        F.concat(F.lit("-1,"), F.lit("00"), number, F.lit(".5")),
        F.lit(""),
    ]
    layout = F.pmod(F.col("conv_id") * 7 + F.col("turn"), F.lit(8))
    text = F.when(layout == 0, layouts[0])
    for i, column in enumerate(layouts[1:], start=1):
        text = text.when(layout == i, column)
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("prompt_id"),
        F.col("turn").alias("gen_id"),
        F.array(message("user", F.concat(F.lit("conversation "), "conv_id"))).alias("prompt"),
        F.array(message("assistant", text)).alias("completion"),
        number.alias("answer"),
    )


def conversation_texts(
    turns: DataFrame, template: ChatTemplate = LLAMA3, turns_per_part: int = TURNS_PER_PART
) -> DataFrame:
    """One chat text per conversation of turn-per-row input, whatever its number of turns.

    Each turn is rendered by itself. Parts of consecutive turn numbers are put together, and
    their texts once more, so that no step sorts more than a part or holds more than the text.
    The turns are shuffled once, by conversation, which serves both steps.
    """
    piece = render(F.array(message(F.col("role"), F.col("text"))), replace(template, bos=""))
    part = F.floor(F.col("turn") / turns_per_part)
    dealt = turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
    rendered = dealt.select("conv_id", part.alias("part"), "turn", "role", piece.alias("piece"))

    def in_order(rows: DataFrame, keys: list[str], *place: str) -> DataFrame:
        pieces = F.array_sort(F.collect_list(F.struct(*place, "piece")))
        # array_join would leave a turn without role or text out in silence
        whole = F.bool_and(F.col("piece").isNotNull())
        joined = rows.groupBy(*keys).agg(pieces.alias("pieces"), whole.alias("whole"))
        text = F.when(F.col("whole"), F.array_join("pieces.piece", ""))
        return joined.select(*keys, text.alias("piece"))

    parts = in_order(rendered, ["conv_id", "part"], "turn", "role")
    whole = in_order(parts, ["conv_id"], "part")
    return whole.select("conv_id", F.concat(F.lit(template.bos), "piece").alias("text"))


def list_lines(records: DataFrame) -> DataFrame:
    """JSON objects (``value``) as the lines of one top-level list per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        started = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            objects = batch["value"]
            following = pc.binary_join_element_wise(",", objects, "")
            if not started:
                following = pa.concat_arrays([objects.slice(0, 1), following.slice(1)])
            started = True
            yield pa.RecordBatch.from_pydict({"value": following})
        yield pa.RecordBatch.from_pydict({"value": ["]"]})

    return records.mapInArrow(run, "value string")


def prompt_lines(spark: SparkSession, folder: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON lines of every kind of prompt record, one per turn, from all conversations."""
    lines = {
        "user": F.struct(F.col("text").alias("prompt"), "conv_id", "turn"),
        "system": F.struct(
            F.lit("old").alias("response"), F.col("text").alias("prompt"), "conv_id", "turn"
        ),
    }
    with_messages = F.struct(
        F.array(
            message("system", F.concat(F.lit("turn "), F.col("turn"))),
            message("user", F.col("text")),
        ).alias("messages"),
        F.lit("unused").alias("prompt"),
        "conv_id",
        "turn",
    )
    value = F.coalesce(
        *[F.when(F.col("role") == role, F.to_json(line)) for role, line in lines.items()],
        F.to_json(with_messages),
    )
    return table(spark, folder, "conversations").select(*keep, value.alias("value"))
