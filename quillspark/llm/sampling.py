"""A sample of bounded size, the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 30


def hash_sample(rows: DataFrame, most: int, key: str) -> DataFrame:
    """About ``most`` rows of a larger table, all of a smaller one, with their ``_place``.

    Rows are chosen by a hash of ``key``, such as the id, so that copies of one text are drawn one
    by one. Nothing is shuffled; see first_rows for the exact number.
    """
    count = rows.count()
    placed = rows.withColumn("_place", F.pmod(F.xxhash64(key), F.lit(_RANGE)))
    return placed.where(F.col("_place") <= int(1.2 * most / count * _RANGE)) if count > most else placed


def first_rows(sampled: DataFrame, most: int, *numbers: str) -> DataFrame:
    """At most ``most`` rows of a sample, those with the smallest hashes.

    Ties go by ``numbers``, so that only hashes and numbers are sorted, never texts.
    """
    return sampled.select("_place", *numbers).orderBy("_place", *numbers).limit(most).drop("_place")
