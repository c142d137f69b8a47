"""Prompt lines to prediction lines: parse, render, generate with a user predictor, serialise."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.chat import LLAMA3, ChatTemplate, render
from quillspark.functions.text import is_blank, strip

#: Called with prompts and parameters, and with the prompts' random generators if rows have keys.
Predictor = Callable[..., list[str]]
PredictorFactory = Callable[[], Predictor]

RECORD = "map<string,variant>"
MESSAGES = "array<struct<role string, content string>>"


@dataclass(frozen=True)
class GenerationParameters:
    """Sampling settings handed to the predictor; the defaults are fixed values."""

    max_new_tokens: int = 1024
    temperature: float = 0.7
    top_p: float = 0.9

    @property
    def do_sample(self) -> bool:
        return self.temperature > 0


def drop_blank_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Stripped lines that are not empty."""
    return lines.where(~is_blank(F.col(value))).withColumn(value, strip(F.col(value)))


def parse_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``record``: the top-level fields of a line holding exactly one JSON object, else null.

    from_json stops after the first value and would accept trailing text. Inside brackets any
    trailing text is an error or a second element, unless it closes the bracket itself; that
    remainder is an error inside braces.
    """
    line = F.col(value)
    elements = F.from_json(F.concat(F.lit("["), line, F.lit("]")), F.lit(f"array<{RECORD}>"))
    keys = F.json_object_keys(F.concat(F.lit('{"r":'), line, F.lit("}")))
    parsed = _compute(lines, _elements=elements)
    single = (F.size("_elements") == 1) & (keys == F.array(F.lit("r")))
    parsed = parsed.withColumn("record", F.when(single, F.get("_elements", F.lit(0))))
    return parsed.withColumn("record", _last_key_wins(F.col("record"))).drop("_elements")


def _compute(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row.

    Filters and projections above a generator cannot be rewritten in terms of its input, so a
    later filter on such a column does not repeat the expression behind it.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def _last_key_wins(record: Column) -> Column:
    """Drop all but the last entry of a repeated key; from_json keeps them all."""
    keys = F.map_keys(record)
    last = F.filter(
        F.map_entries(record),
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]),
    )
    unique = F.size(F.array_distinct(keys)) == F.size(record)
    return F.when(unique, record).otherwise(F.map_from_entries(last))


_REREAD = (
    f"struct<has_messages: boolean, messages: {MESSAGES}, has_prompt: boolean, prompt: string, "
    "rest: string>"
)


class _Number(str):
    """A number as it is written."""


def _fields(line: str) -> list[tuple[str, object, int, int]]:
    """Top-level (key, value, start, end) of a line that is exactly one JSON object.

    NaN, Infinity and numbers of any length are accepted, as Python's reader accepts them.
    """
    decoder = json.JSONDecoder(parse_int=_Number, parse_float=_Number, parse_constant=_Number)
    blank = re.compile(r"[ \t\n\r]*")

    def after(at: int) -> int:
        return blank.match(line, at).end()

    at, found = after(0), []
    if line[at : at + 1] != "{":
        raise ValueError("no object")
    at = after(at + 1)
    while line[at : at + 1] != "}":
        if found:
            if line[at : at + 1] != ",":
                raise ValueError("no comma")
            at = after(at + 1)
        if line[at : at + 1] != '"':
            raise ValueError("no key")
        key, end = json.decoder.scanstring(line, at + 1)
        end = after(end)
        if line[end : end + 1] != ":":
            raise ValueError("no value")
        value, end = decoder.raw_decode(line, after(end + 1))
        found.append((key, value, at, end))
        at = after(end)
    if after(at + 1) != len(line):
        raise ValueError("more than one value")
    return found


def _text_of(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return None if value is None else str(value)
    return json.dumps(value, ensure_ascii=False)


def _messages_of(value: object) -> list[dict] | None:
    if not isinstance(value, list) or not all(v is None or isinstance(v, dict) for v in value):
        return None
    return [v and {k: _text_of(v.get(k)) for k in ("role", "content")} for v in value]


def _reread(line: str | None) -> dict | None:
    """What render_prompts needs of a line, and its text without a response of its own."""
    try:
        fields = _fields(line) if line is not None else None
    except (ValueError, RecursionError):
        return None
    if fields is None:
        return None
    record = {key: value for key, value, *_ in fields}
    kept = [line[start:end] for key, _, start, end in fields if key != "response"]
    prompt = record.get("prompt")
    plain = isinstance(prompt, str) and not isinstance(prompt, _Number)
    return {
        "has_messages": "messages" in record,
        "messages": _messages_of(record.get("messages")),
        "has_prompt": "prompt" in record,
        "prompt": prompt if plain else None,
        "rest": "{" + ",".join(kept) + "}" if len(kept) < len(fields) else line,
    }


def _reread_column(line: Column) -> Column:
    @F.arrow_udf(_REREAD)
    def run(lines: pa.Array) -> pa.Array:
        message = pa.struct([("role", pa.string()), ("content", pa.string())])
        kind = pa.struct(
            [
                ("has_messages", pa.bool_()),
                ("messages", pa.list_(message)),
                ("has_prompt", pa.bool_()),
                ("prompt", pa.string()),
                ("rest", pa.string()),
            ]
        )
        return pa.array([_reread(x) for x in lines.to_pylist()], kind)

    return run(line)


def render_prompts(
    lines: DataFrame, template: ChatTemplate = LLAMA3, value: str = "value"
) -> DataFrame:
    """Add ``text`` (the prompt) or, for an unusable line, ``error``; and ``rest``.

    A ``messages`` key wins over ``prompt`` even if its value is null. ``rest`` is the line
    without a response of its own, all other fields as they are written.

    Ordinary lines are parsed in the JVM. Those that it does not take (NaN and Infinity, very
    long strings, but also broken lines) and those with a response go through Python's reader.
    """
    parsed = parse_records(lines, value)
    record = F.col("record")
    hard = record.isNull() | F.map_contains_key(record, F.lit("response"))
    parsed = parsed.withColumn("_again", _reread_column(F.when(hard, F.col(value))))
    again = F.col("_again")
    known = again.isNotNull()
    has_messages = F.when(known, again["has_messages"]).otherwise(
        F.map_contains_key(record, F.lit("messages"))
    )
    has_prompt = F.when(known, again["has_prompt"]).otherwise(
        F.map_contains_key(record, F.lit("prompt"))
    )
    messages = F.try_variant_get(F.element_at(record, "messages"), "$", MESSAGES)
    messages = F.when(known, again["messages"]).otherwise(messages)
    prompt = F.element_at(record, "prompt")
    plain = F.when(
        F.schema_of_variant(prompt) == "STRING", F.try_variant_get(prompt, "$", "string")
    )
    plain = F.when(known, again["prompt"]).otherwise(plain)
    parsed = parsed.withColumn("_messages", F.when(has_messages, messages))
    text = F.when(has_messages, render(F.col("_messages"), template, True)).when(has_prompt, plain)
    problem = (
        F.when(record.isNull() & ~known, "not a JSON object")
        .when(~has_messages & ~has_prompt, "neither messages nor prompt")
        .when(has_messages, "unusable messages")
        .otherwise("unusable prompt")
    )
    rest = F.coalesce(again["rest"], F.col(value))
    rendered = _compute(parsed, text=text, rest=rest, _problem=problem)
    error = F.when(F.col("text").isNull(), F.col("_problem"))
    return rendered.withColumn("error", error).drop("record", "_messages", "_problem", "_again")


def fail_on_error(rendered: DataFrame, value: str = "value") -> DataFrame:
    """Stop the job at the first unusable line."""
    problem = F.concat(F.lit("prompt line: "), F.col("error"), F.lit(": "), F.col(value))
    checked = F.when(F.col("error").isNull(), F.col("text")).otherwise(F.raise_error(problem))
    return rendered.withColumn("text", checked).drop("error")


def quarantine(rendered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable lines and unusable lines (with ``error``)."""
    usable = rendered.where(F.col("error").isNull()).drop("error")
    return usable, rendered.where(F.col("error").isNotNull()).drop("text", "rest")


def generate(
    prompts: DataFrame,
    factory: PredictorFactory,
    parameters: GenerationParameters = GenerationParameters(),
    text: str = "text",
    batch_size: int = 256,
    key: str | Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Add ``response``: one generated text per prompt.

    The factory runs once per task and the predictor sees at most ``batch_size`` prompts at
    once; it must give one result for each. Only the prompt text goes to Python. Sampling
    predictors are declared non-deterministic, so that the optimizer never evaluates them twice
    for one row.

    With ``key``, columns that tell the rows apart, the predictor gets a third argument: a random
    generator for each prompt that depends on ``seed`` and the key alone. What it draws from them
    is the same in any partitioning and in a task that is run again. Rows of one key draw the same.
    """
    response = _prediction(factory, parameters, text, batch_size, key, seed, pa.string(), "string")
    return prompts.withColumn("response", response)


def generate_tokens(
    prompts: DataFrame,
    factory: Callable[[], Callable],
    parameters: GenerationParameters = GenerationParameters(),
    ids: str = "input_ids",
    batch_size: int = 256,
    key: str | Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Add ``output_ids``: what a model on token ids gives for each prompt, prompt included.

    As generate, with lists of ids instead of texts.
    """
    kind = pa.list_(pa.int32())
    output = _prediction(factory, parameters, ids, batch_size, key, seed, kind, "array<int>")
    return prompts.withColumn("output_ids", output)


def _prediction(factory, parameters, column, batch_size, key, seed, kind, name) -> Column:
    if key is None:

        @F.arrow_udf(name)
        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            predictor = factory()
            for batch in batches:
                yield pa.array(_predicted(predictor, batch, parameters, batch_size), kind)

        if parameters.do_sample:
            predict = predict.asNondeterministic()
        return predict(F.col(column))

    @F.arrow_udf(name)
    def predict_keyed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        predictor = factory()
        for batch, keys in batches:
            streams = [row_stream(seed, k) for k in keys.to_pylist()]
            yield pa.array(_predicted(predictor, batch, parameters, batch_size, streams), kind)

    return predict_keyed(F.col(column), row_key(*([key] if isinstance(key, str) else key)))


def row_key(*columns: str) -> Column:
    """The key columns as one text that tells null from empty and one column from the next."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def row_stream(seed: int, key: str) -> np.random.Generator:
    """The random generator of a row: a counter-based one, keyed by a hash of seed and key."""
    digest = hashlib.blake2b(f"{seed}:{key}".encode(), digest_size=16).digest()
    return np.random.Generator(np.random.Philox(key=int.from_bytes(digest, "little")))


def _predicted(
    predictor: Callable, prompts: pa.Array, parameters, batch_size: int, streams: list | None = None
) -> list:
    rows, out = prompts.to_pylist(), []
    for start in range(0, len(rows), batch_size):
        part = rows[start : start + batch_size]
        drawn = [] if streams is None else [streams[start : start + batch_size]]
        found = list(predictor(part, parameters, *drawn))
        if len(found) != len(part):
            raise ValueError(f"the predictor gave {len(found)} results for {len(part)} prompts")
        out.extend(found)
    return out


def with_response(rest: Column, response: Column) -> Column:
    """A record's text, an object with no response of its own, with ``response`` at its end."""
    quoted = F.to_json(F.struct(response.alias("response")), {"ignoreNullFields": "false"})
    line = strip(rest)
    opened = F.rtrim(F.substring(line, F.lit(1), F.length(line) - 1))
    return F.concat(
        opened,
        F.when(opened == "{", F.lit("")).otherwise(F.lit(",")),
        F.substring(quoted, F.lit(2), F.length(quoted)),
    )


def prediction_lines(
    predicted: DataFrame, rest: str = "rest", response: str = "response", keep: Sequence[str] = ()
) -> DataFrame:
    return predicted.select(*keep, with_response(F.col(rest), F.col(response)).alias("value"))


def predict_lines(
    lines: DataFrame,
    factory: PredictorFactory,
    parameters: GenerationParameters = GenerationParameters(),
    template: ChatTemplate = LLAMA3,
    keep: Sequence[str] = (),
    key: str | Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Prompt lines to prediction lines, failing on unusable ones; narrow from end to end.

    ``keep`` names columns of ``lines`` to carry along, such as the place of the line.
    """
    rendered = fail_on_error(render_prompts(drop_blank_lines(lines), template))
    return prediction_lines(generate(rendered, factory, parameters, key=key, seed=seed), keep=keep)
