"""Vocabulary tables (token, id): building, extending, pad lookup and size checks."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.chat import LLAMA3, ChatTemplate
from quillspark.functions.tokens import END_OF_TEXT, RIGHT_PAD_TOKEN, words
from quillspark.operators.numbering import number_rows

UNKNOWN = "<unk>"


def template_tokens(template: ChatTemplate = LLAMA3) -> list[str]:
    """Tokens a vocabulary needs so that the template's headers encode without unknowns."""
    return [
        UNKNOWN,
        *template.special_tokens,
        *([] if END_OF_TEXT in template.special_tokens else [END_OF_TEXT]),
        RIGHT_PAD_TOKEN,
        template.header_gap,
        "system",
        "user",
        "assistant",
    ]


def _listed(spark: SparkSession, tokens: Sequence[str]) -> DataFrame:
    """The tokens as rows (pos, token), produced by the JVM without a Python worker."""
    items = F.from_json(F.lit(json.dumps(list(tokens))), "array<string>")
    return spark.range(1).select(F.posexplode(items).alias("pos", "token"))


def token_counts(df: DataFrame, text: str = "text", pattern: str | None = None) -> DataFrame:
    tokens = df.select(F.explode(words(F.col(text), pattern)).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocabulary(
    df: DataFrame,
    size: int | None,
    text: str = "text",
    reserved: Sequence[str] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Reserved tokens first, then the ``size`` most frequent corpus tokens (ties by token), or
    all of them if ``size`` is None; then they are numbered part by part, not in one task.

    Ranking every distinct token for a top-k would send up to k rows per task to one task. The
    count of the k-th token comes from the histogram of counts instead (N tokens have fewer than
    sqrt(2N) distinct counts), and only tokens at or above it are sorted. The histogram and the
    final selection share one token shuffle.
    """
    reserved = template_tokens() if reserved is None else list(reserved)
    listed = _listed(df.sparkSession, reserved)
    counts = token_counts(df, text, pattern).where(~F.col("token").isin(reserved))
    if size is None:
        ranked = _number_all(counts, len(reserved))
        return listed.select("token", F.col("pos").alias("id")).unionByName(ranked)
    downwards = Window.orderBy(F.desc("n"))
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("tokens"))
    above = F.coalesce(
        F.sum("tokens").over(downwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    cutoff = histogram.withColumn("above", above).where(F.col("above") < size).agg(F.min("n"))
    top = (
        counts.where(F.col("n") >= cutoff.scalar()).orderBy(F.desc("n"), "token").limit(size)
    )
    # at most `size` rows are left, so ranking them in one task is bounded by the parameter
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    ranked = top.select("token", (rank + (len(reserved) - 1)).cast("int").alias("id"))
    return listed.select("token", F.col("pos").alias("id")).unionByName(ranked)


def _number_all(counts: DataFrame, first: int) -> DataFrame:
    """(token, id) of all tokens by falling count, then token, from ``first`` on."""
    numbered = number_rows(counts, -F.col("n"), F.col("token"))
    return numbered.select("token", (F.col("number") + first).cast("int").alias("id"))


def add_tokens(vocab: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Append tokens that are not there yet with ids after the largest; others keep their id.

    All of them are marked in a column ``special``: encoding finds a marked token wherever it
    stands in a text, also inside what would else be a word, and never splits it.
    """
    if any(not t for t in tokens):
        raise ValueError("an empty token cannot be found in a text")
    listed = _listed(vocab.sparkSession, list(dict.fromkeys(tokens))) if tokens else None
    vocab = vocab.withColumn("special", _marked(vocab))
    if listed is None:
        return vocab
    given = listed.select("token", F.lit(True).alias("_given"))
    known = vocab.join(F.broadcast(given), "token", "left")
    marked = known.select("token", "id", (F.col("special") | F.col("_given").isNotNull()).alias("special"))
    missing = listed.join(vocab.select("token"), "token", "left_anti")
    next_id = F.coalesce(vocab.agg(F.max("id")).scalar(), F.lit(-1))
    place = F.row_number().over(Window.orderBy("pos"))
    new = missing.select("token", place.alias("place")).select(
        "token", (next_id + F.col("place")).cast("int").alias("id"), F.lit(True).alias("special")
    )
    return marked.unionByName(new)


def _marked(vocab: DataFrame) -> Column:
    return F.coalesce("special", F.lit(False)) if "special" in vocab.columns else F.lit(False)


def registered_tokens(vocab: DataFrame) -> list[str]:
    """The marked tokens; they were once given as a list on the driver and come back as one."""
    if "special" not in vocab.columns:
        return []
    return sorted(r.token for r in vocab.where("special").select("token").collect())


def byte_tokens() -> list[str]:
    """The names of the 256 bytes, in order."""
    return [f"<0x{b:02X}>" for b in range(256)]


def add_byte_tokens(vocab: DataFrame) -> DataFrame:
    """Append a token for each byte that has none, unmarked: texts never hold them as words.

    With all of them there encoding turns a word outside the vocabulary into its UTF-8 bytes, and
    decoding turns runs of bytes back into text, so that nothing is lost at any vocabulary size.
    """
    vocab = vocab.withColumn("special", _marked(vocab))
    listed = _listed(vocab.sparkSession, byte_tokens())
    missing = listed.join(vocab.select("token"), "token", "left_anti")
    next_id = F.coalesce(vocab.agg(F.max("id")).scalar(), F.lit(-1))
    place = F.row_number().over(Window.orderBy("pos"))
    new = missing.select("token", place.alias("place")).select(
        "token", (next_id + F.col("place")).cast("int").alias("id"), F.lit(False).alias("special")
    )
    return vocab.select("token", "id", "special").unionByName(new)


def byte_ids(vocab: DataFrame) -> list[int] | None:
    """Ids of the 256 byte tokens in order; None unless all are there."""
    names = byte_tokens()
    found = {r.token: r.id for r in vocab.where(F.col("token").isin(names)).collect()}
    return [found[n] for n in names] if len(found) == 256 else None


def resolve_pad(
    vocab: DataFrame,
    pad_token: str | None = None,
    fallback: str | None = RIGHT_PAD_TOKEN,
    end_token: str = END_OF_TEXT,
) -> DataFrame:
    """One row ``pad_id``: the pad token, else the fallback if in the vocabulary, else the end.

    Pre-training and inference pass ``fallback=None``.
    """

    def id_of(token: str | None) -> Column:
        return F.max(F.when(F.col("token") == F.lit(token), F.col("id")))

    return vocab.agg(
        F.coalesce(id_of(pad_token), id_of(fallback), id_of(end_token)).alias("pad_id")
    )


def token_ids(vocab: DataFrame, tokens: Sequence[str], unknown: str = UNKNOWN) -> list[int]:
    """Ids of a short fixed token list, such as the response marker."""
    wanted = set(tokens) | {unknown}
    found = {r.token: r.id for r in vocab.where(F.col("token").isin(sorted(wanted))).collect()}
    missing = [t for t in tokens if t not in found]
    if missing and unknown not in found:
        raise ValueError(f"not in the vocabulary and no {unknown}: {missing}")
    return [found.get(t, found.get(unknown)) for t in tokens]


@dataclass(frozen=True)
class LookupLimit:
    """Largest vocabulary that is shipped whole to every executor."""

    rows: int = 1_000_000
    chars: int = 64_000_000

    def admits(self, vocab: DataFrame) -> bool:
        size = vocab.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.octet_length("token")), F.lit(0)).alias("chars"),
        ).first()
        return size.rows <= self.rows and size.chars <= self.chars
