"""Declared schemas of the input records."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CORPUS = _strings("text")
SFT = _strings(
    "system_prompt", "instruction", "reference", "modified_reasoning", "formatted_label"
)
QA = _strings("question", "answer")
MESSAGE = _strings("role", "content")
MESSAGES = T.ArrayType(MESSAGE)
VOCABULARY = T.StructType(
    [T.StructField("token", T.StringType()), T.StructField("id", T.IntegerType())]
)
