"""Column-replacing maps over tables: expressions first, opaque batch callbacks where needed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quillspark.functions.chat import ChatTemplate, LLAMA3, render, rl_prompt, sft_messages
from quillspark.functions.rewards import extract_hash_answer

TENSOR_COLUMNS = ("input_ids", "attention_mask")


def replace_columns(df: DataFrame, columns: Mapping[str, Column], keep: Sequence[str] = ()):
    """Derived columns instead of the inputs; the scan reads only what they use."""
    return df.select(*keep, *[column.alias(name) for name, column in columns.items()])


def merge_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Derived columns added to the inputs; equal names are overwritten, all read the input."""
    return df.withColumns(dict(columns))


def tensor_columns(df: DataFrame, columns: Sequence[str] = TENSOR_COLUMNS) -> DataFrame:
    return df.select(*columns)


def map_batches(
    df: DataFrame,
    fn: Callable[[dict[str, list]], Mapping[str, list]],
    schema: T.StructType,
    remove_columns: Iterable[str] = (),
    arrow: bool = False,
) -> DataFrame:
    """Apply a callback on column lists; kept input columns come first, then ``schema``.

    With ``arrow`` the callback gets and may return Arrow arrays, and no value becomes a Python
    object.

    Returned columns replace inputs of the same name. Input columns are handed over by Arrow
    batch, so select the needed ones first.
    """
    gone = {*remove_columns, *schema.names}
    kept = [f for f in df.schema.fields if f.name not in gone]
    out = T.StructType([*kept, *schema.fields])
    arrow_schema = to_arrow_schema(out)
    kept_names = [f.name for f in kept]
    new_names = list(schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            made = fn(columns if arrow else batch.to_pydict())
            arrays = [batch.column(n).cast(arrow_schema.field(n).type) for n in kept_names]
            arrays += [_array(made[n], arrow_schema.field(n).type) for n in new_names]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return df.mapInArrow(run, out)


def _array(values: object, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def format_sft(
    df: DataFrame,
    template: ChatTemplate = LLAMA3,
    compat: bool = False,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Five-column examples to chat ``text``; rows with a missing required field come second."""
    messages = sft_messages(
        F.col("system_prompt"),
        F.col("instruction"),
        F.col("reference"),
        F.col("modified_reasoning"),
        F.col("formatted_label"),
        compat,
    )
    required = ["instruction", "reference"]
    if not compat:
        required += ["system_prompt", "modified_reasoning", "formatted_label"]
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    text = {"text": render(messages, template)}
    return replace_columns(df.where(complete), text, keep), df.where(~complete)


def format_qa(df: DataFrame) -> DataFrame:
    """Question/answer rows plus ``prompt``; ``answer`` becomes the marked final answer."""
    return merge_columns(
        df,
        {"prompt": rl_prompt(F.col("question")), "answer": extract_hash_answer(F.col("answer"))},
    )
