"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import (
    chat_spans,
    collocations,
    exact_dedup,
    language,
    mixing,
    near_dedup,
    packing,
    quality,
    ranked_search,
    secret_scan,
    token_counts,
    token_files,
    toxicity,
)
from quillspark.plans.inputs import table
from quillspark.session import fresh_path, ship_package, store

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}


#: Labels (two numbers each) that are sent to every executor at most.
BROADCAST_LABELS = 2_000_000


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    LLM_QUERIES[fn.__name__] = run
    return run


def remainder(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo; a null id has none."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))


def tokenizer_file(name: str) -> bytes:
    """Content of a public tokenizer's file, a few megabytes, to be sent to the workers."""
    return Path(public_tokenizers.path(name)).read_bytes()


@query
def op1_token_files(spark, folder):
    path = fresh_path(spark, "token-files")
    documents = table(spark, folder, "documents")
    token_files.write_token_files(documents, path, tokenizer_file("word_bpe_49k.json"), end_id=1)
    crc = token_files.ids_crc32(F.col("ids")).alias("ids_crc32")
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", crc)


@query
def op2_chat_spans(spark, folder):
    rows = "conv_id bigint, turn bigint, role string, text string"
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows)
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    formatted = store(chat_spans.format_turns(turns.unionByName(extra)), "chat")
    return chat_spans.conversation_digests(formatted)


@query
def op3_quality_rules(spark, folder):
    documents = table(spark, folder, "documents")
    measured = documents.select("doc_id", quality.measures(F.col("text")).alias("m"))
    measured = store(measured, "measures")
    judged = quality.judge(measured, "m", quality.fit_rules(measured, "m"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


@query
def op4_mix_sources(spark, folder):
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "rate", "copies")


@query
def op5_exact_dedup(spark, folder):
    return exact_dedup.duplicate_classes(table(spark, folder, "documents"), largest=True)


@query
def op6_language(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    fold = F.coalesce(remainder("doc_id", 4), F.lit(2))
    model = language.learn_languages(documents.where(fold < 2))
    if model is not None:
        language.calibrate(model, documents.where(fold == 3))
    rows = documents.select("doc_id", "text", (fold == 2).alias("held_out"))
    found = language.identify(rows, model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op7_near_dedup(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"), width=2, percent=80)


@query
def op8_best_fit_packing(spark, folder):
    documents = table(spark, folder, "documents")
    return packing.pack_documents(documents, tokenizer_file("word_bpe_49k.json"), end_id=0)


@query
def op10_token_counts(spark, folder):
    documents = table(spark, folder, "documents")
    return token_counts.count_tokens(documents, tokenizer_file("piece_bpe_32k.model"))


@query
def op9_toxicity(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    labels = store(labels.where(~held_out), "labels")
    if labels.count() <= BROADCAST_LABELS:  # else the texts are shuffled to their labels
        labels = F.broadcast(labels)
    training = documents.join(labels, "doc_id")
    lexicon = toxicity.learn_lexicon(training)
    scored = toxicity.score_toxicity(documents, lexicon)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op11_ranked_search(spark, folder):
    documents = table(spark, folder, "documents")
    return ranked_search.ranked_search(documents, table(spark, folder, "benchmark"), k=50)


@query
def op12_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"), least=30, most=2000)


@query
def op13_secret_scan(spark, folder):
    return secret_scan.find_secrets(table(spark, folder, "documents"))
