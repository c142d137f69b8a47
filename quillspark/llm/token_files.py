"""Token files: Parquet with ids as dictionary-coded lists and delta-coded metadata columns."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.tokenize import worker_encoder
from quillspark.llm.words import list_array, slices

FILE_SCHEMA = "doc_id bigint, part int, place bigint, n_tokens bigint, ids array<int>"

#: Row groups and pages small enough that a reader of a few documents skips the rest by the page
#: indexes, which the writer always adds. Ids repeat, so they are dictionary coded; the other
#: columns grow from row to row, so they are delta coded (format version 2, no dictionary).
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(128 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(2 << 20),
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#place": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: bytes,
    end_id: int,
    options: dict[str, str] | None = None,
) -> None:
    """Encode every whole text, append ``end_id`` and write rows in ascending ``doc_id`` order.

    The texts are range partitioned once and encoded where they land, so the files follow each
    other in order, and a lost task only repeats its own file. A row holds its file's number
    (``part``) and the ids before it in that file (``place``); see read_token_files.

    A null or empty text gives the end id alone. Null ids come first; rows that share an id stay
    separate, ordered by text. An empty table gives files without rows. Other columns of
    ``docs``, whatever their names, are not written.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1)
            for start, stop in slices(texts):
                flat, offsets = encoder.encode_with_end(texts.slice(start, stop - start), end_id)
                rows = stop - start
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, rows),
                        pa.array(np.full(rows, part, np.int32)),
                        pa.array(place + offsets[:-1]),
                        pa.array(np.diff(offsets)),
                        list_array(offsets, pa.array(flat.view(np.int32))),
                    ],
                    ["doc_id", "part", "place", "n_tokens", "ids"],
                )
                place += int(offsets[-1])

    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    encoded = ordered.mapInArrow(run, FILE_SCHEMA)
    encoded.write.options(**(FILE_OPTIONS | (options or {}))).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of token files.

    ``start`` counts the ids of all documents before: a running sum over the files' totals, of
    which there is one per file, plus the place within the file. Columns that are not selected
    are not read; a filter on ``doc_id`` reaches the scan.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base")
    )
    # one row per file that one job wrote
    joined = rows.join(F.broadcast(bases), "part")
    return joined.select("doc_id", (F.col("_base") + F.col("place")).alias("start"), "n_tokens", "ids")


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers; null ids give null."""

    @F.arrow_udf("bigint")
    def crc(lists: pa.Array) -> pa.Array:
        values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False).view(np.uint8)
        offsets = lists.offsets.to_numpy().astype(np.int64) * 4
        valid = lists.is_valid().to_numpy(zero_copy_only=False)
        bounds = zip(offsets[:-1], offsets[1:], valid)
        return pa.array([zlib.crc32(values[a:b]) if v else None for a, b, v in bounds], pa.int64())

    return crc(ids)
