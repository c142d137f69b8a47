"""Assigning rows to device batches and padding each batch to its longest row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.tokens import pad_row, truncate
from quillspark.operators.numbering import number_rows, permuted

# Rows per device batch, accumulated batches and devices of the training stages.
CPT_BATCH, CPT_ACCUMULATION, CPT_DEVICES = 2, 8, 8
SFT_BATCH, SFT_ACCUMULATION = 2, 4
RL_BATCH, RL_ACCUMULATION = 1, 1


#: Rows of a shard on average, unless the number of shards is given.
SHARD_ROWS = 1000


def shard_count(df: DataFrame, rows: int = SHARD_ROWS) -> Column:
    """Number of shards for the rows of ``df``, as a scalar subquery."""
    count = df.agg(F.count(F.lit(1))).scalar()
    return F.greatest(F.ceil(count / rows), F.lit(1)).cast("bigint")


def shard_of(key: Sequence[str], shards: int | Column) -> Column:
    """Shard number from a hash of the row key: even for any unique key, sequential or not."""
    text = F.concat_ws("\u001f", *[F.col(k).cast("string") for k in key])
    head = F.substring(F.md5(text), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def assign_batches(
    df: DataFrame,
    key: str | Sequence[str],
    batch_size: int,
    shards: int | None = None,
    accumulation: int = 1,
) -> DataFrame:
    """Add ``shard``, ``batch`` and ``step``.

    Rows are numbered within their shard in key order; every ``batch_size`` rows form a batch
    and every ``accumulation`` batches of a shard one optimiser step, so all batches but the
    last of a shard are full. The key columns together identify a row, as prompt and generation
    number do, so that rows sharing one of them still spread over all shards. A shard is sorted
    in one task, so the number of shards follows the number of rows unless it is given.
    """
    key = [key] if isinstance(key, str) else list(key)
    shards = shard_count(df) if shards is None else shards
    within = Window.partitionBy("shard").orderBy(*key)
    number = F.row_number().over(within) - 1
    return (
        df.withColumn("shard", shard_of(key, shards))
        .withColumn("batch", F.floor(number / batch_size).cast("int"))
        .withColumn("step", F.floor(F.col("batch") / accumulation).cast("int"))
    )


def pad_batches(
    df: DataFrame, pad_id: Column | int, ids: str = "input_ids", labels: str | None = None
) -> DataFrame:
    """Pad ids, mask and labels to the longest row of each (shard, batch); adds ``length``.

    Batches live inside shards, so the rows stay where assign_batches put them.
    """
    batch = Window.partitionBy("shard", "batch")
    padded = df.withColumn("length", F.max(F.size(ids)).over(batch))
    label_column = None if labels is None else F.col(labels)
    return padded.withColumns(pad_row(F.col(ids), pad_id, F.col("length"), label_column))


def pad_fixed(
    df: DataFrame,
    pad_id: Column | int,
    length: int,
    ids: str = "input_ids",
    labels: str | None = None,
) -> DataFrame:
    """Truncate or pad every row to one constant length; narrow, but stores mostly padding."""
    label_column = None if labels is None else F.col(labels)
    return df.withColumns(
        pad_row(truncate(F.col(ids), length), pad_id, length, label_column)
    )


def deal_epoch(
    df: DataFrame,
    key: str | Sequence[str],
    epoch: int,
    seed: int = 0,
    batch_size: int = CPT_BATCH,
    accumulation: int = CPT_ACCUMULATION,
    devices: int = CPT_DEVICES,
) -> DataFrame:
    """Add ``position``, ``device``, ``batch`` and ``step`` of one epoch over all rows.

    Rows are numbered in the order of their key and the numbers permuted by seed and epoch (see
    permuted): every row comes once an epoch, in another order each epoch, the same for the same
    seed. Consecutive positions form device batches, dealt to the devices in turn; ``batch`` counts
    them on a device and ``step`` their groups of ``accumulation``, so that a step takes
    batch_size x accumulation x devices rows. Only the last step may be short. No global sort and
    no stored order: a further epoch over the numbered rows is a projection.
    """
    return deal_numbered(number_epochs(df, key), epoch, seed, batch_size, accumulation, devices)


def number_epochs(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Add ``number``, what deal_numbered starts from; once for all epochs.

    The key columns together identify a row. Rows that share a key share its place in any order.
    """
    key = [key] if isinstance(key, str) else list(key)
    return number_rows(df, *key)


def deal_numbered(
    numbered: DataFrame,
    epoch: int,
    seed: int = 0,
    batch_size: int = CPT_BATCH,
    accumulation: int = CPT_ACCUMULATION,
    devices: int = CPT_DEVICES,
) -> DataFrame:
    n = numbered.count()
    position = permuted(F.col("number"), n, seed, epoch) if n else F.col("number")
    dealt = numbered.withColumn("position", position).drop("number")
    deal = F.floor(F.col("position") / batch_size)
    return dealt.withColumns(
        {
            "device": (deal % devices).cast("int"),
            "batch": F.floor(deal / devices).cast("int"),
            "step": F.floor(deal / (devices * accumulation)).cast("int"),
        }
    )


#: Buckets of lengths.
BUCKETS = 64


def length_bounds(lengths: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Upper lengths of buckets of about equal numbers of rows (column ``length``).

    They come from a quantile sketch; ``buckets`` numbers go to the driver. Null lengths count
    as 0.
    """
    shares = [i / buckets for i in range(1, buckets)]
    row = lengths.agg(F.approx_percentile(F.coalesce("length", F.lit(0)), F.lit(shares), F.lit(20_000)).alias("q")).first()
    return sorted(set(row.q or []))


def assign_length_batches(
    df: DataFrame,
    key: str | Sequence[str],
    batch_size: int,
    ids: str = "input_ids",
    seed: int = 0,
    epoch: int = 0,
    bounds: Sequence[int] | None = None,
) -> DataFrame:
    """Add ``batch`` and ``bucket``: batches of rows of similar length, so that little is padded.

    Rows fall into buckets of lengths (``bounds``, else from length_bounds). Within a bucket they
    follow a hash of seed, epoch and key, so that each epoch makes other batches. What does not
    fill a batch goes up into the first one of the next bucket: all rows are kept and only the
    very last batch may be short. Batches are numbered from short to long; see deal_batches for
    an order to train in.
    """
    key = [key] if isinstance(key, str) else list(key)
    length = F.coalesce(F.size(ids), F.lit(0))
    if bounds is None:
        bounds = length_bounds(df.select(length.alias("length")))
    bucket = F.lit(0)
    if bounds:
        limits = F.array(*[F.lit(int(b)) for b in bounds])
        bucket = F.size(F.filter(limits, lambda b: b < length))
    bucketed = df.withColumn("bucket", bucket.cast("int"))
    text = F.concat_ws("\u001f", F.lit(seed), F.lit(epoch), *[F.col(k).cast("string") for k in key])
    numbered = number_rows(bucketed, "bucket", F.md5(text), *key)
    return numbered.withColumn("batch", F.floor(F.col("number") / batch_size)).drop("number")


def pad_length_batches(
    df: DataFrame, pad_id: Column | int, ids: str = "input_ids", labels: str | None = None
) -> DataFrame:
    """Pad ids, mask and labels to the longest row of each ``batch``; adds ``length``."""
    padded = df.withColumn("length", F.max(F.size(ids)).over(Window.partitionBy("batch")))
    label_column = None if labels is None else F.col(labels)
    return padded.withColumns(pad_row(F.col(ids), pad_id, F.col("length"), label_column))


def deal_batches(df: DataFrame, batches: int, epoch: int, seed: int = 0) -> DataFrame:
    """Replace ``batch`` by its place in a keyed order, so that lengths come mixed."""
    return df.withColumn("batch", permuted(F.col("batch"), batches, seed, epoch))
