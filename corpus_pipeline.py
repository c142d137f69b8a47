"""From documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import exact_dedup, mixing, near_dedup, packing, quality
from quillspark.llm.queries import tokenizer_file
from quillspark.session import ship_package, store

#: Texts that a task hands to its Python worker at once. Executors hold them twice, in the JVM and
#: in Python, for each of their cores; without it Spark allows 64 MB.
BATCH_BYTES = "8m"


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    _prepare(spark)
    return quality.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    _prepare(spark)
    return exact_dedup.drop_duplicates(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five words, similarity 0.8), the document with the smallest id."""
    _prepare(spark)
    return near_dedup.keep_representatives(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    _prepare(spark)
    return mixing.repeat_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 2048 tokens."""
    _prepare(spark)
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), end_id=0)


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_documents),
    ("near dedup", dissimilar_documents),
    ("mixing", mixed_documents),
    ("packing", packed_sequences),
]

#: SQL has neither the label model nor the tilted rates nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
