"""Restartable inference over a growing folder of prompt files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillspark.functions.chat import LLAMA3, ChatTemplate
from quillspark.operators.predict import (
    GenerationParameters,
    PredictorFactory,
    drop_blank_lines,
    generate,
    predict_lines,
    prediction_lines,
    quarantine,
    render_prompts,
)


def predict_folder(
    spark: SparkSession,
    prompts: str,
    output: str,
    checkpoint: str,
    factory: PredictorFactory,
    parameters: GenerationParameters = GenerationParameters(),
    template: ChatTemplate = LLAMA3,
    files_per_batch: int = 1000,
    rejected: str | None = None,
) -> StreamingQuery:
    """Predict all prompt files present, writing results batch by batch.

    An interrupted run keeps what it has written and goes on with the remaining files, the file
    sink's log making every line appear once. An unusable line stops the run, or goes as JSON
    with its ``error`` to the folder ``rejected`` if one is given; that folder is written first.
    """

    def lines() -> DataFrame:
        return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(prompts)

    def run(rows: DataFrame, kind: str, path: str, state: str) -> StreamingQuery:
        writer = rows.writeStream.format(kind).option("checkpointLocation", state)
        return writer.trigger(availableNow=True).start(path)

    if rejected is None:
        return run(predict_lines(lines(), factory, parameters, template), "text", output, checkpoint)
    usable, unusable = quarantine(render_prompts(drop_blank_lines(lines()), template))
    run(unusable.select("value", "error"), "json", rejected, f"{checkpoint}/rejected").awaitTermination()
    predicted = prediction_lines(generate(usable, factory, parameters))
    return run(predicted, "text", output, f"{checkpoint}/predicted")
