"""Ranked lexical search: term at a time, with a limit on accumulators, over shards of documents.

Documents are reduced once to a forward index in the shared folder. Each task then inverts shards
of it in memory and answers all items of a block over them: the terms of an item from rarest to
most frequent, each posting adding to its document's accumulator. When the terms that remain
cannot lift a new document to the k-th partial score, no accumulator is made any more and the
existing ones are updated to their exact scores. Only each task's best documents are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.words import SLICE_BYTES, byte_kinds, cut_words, list_array, slices
from quillspark.session import store

#: Terms are made of ASCII letters, digits and all characters beyond ASCII.
TERM_KINDS = byte_kinds(bytes(c for c in range(128) if not chr(c).isalnum()))

#: Distinct terms of all items that are sent to the tasks that index documents. With more of them
#: the index holds all terms, which costs space; results are the same.
WANTED_TERMS = 1_000_000
#: (item, term) pairs of the items that one pass over the index answers, on average.
BLOCK_PAIRS = 200_000
#: Postings that a task inverts at once.
SHARD_POSTINGS = 2_000_000
#: Groups that the tasks' best documents of an item are merged in before they meet.
MERGE_GROUPS = 64

INDEX = "key bigint, n bigint, terms array<string>, tfs array<int>"


def term_index(rows: DataFrame, key: str, text: str, wanted: pa.Array | None = None) -> DataFrame:
    """Rows (key, n, terms, tfs): a text's number of terms, its distinct terms and their counts.

    With ``wanted`` only those terms are listed; ``n`` counts all. A null text has none.
    """
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            for start, stop in slices(texts, SLICE_BYTES):
                part = texts.slice(start, stop - start)
                counted = _counted(part, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(start, stop - start), *counted], ["key", "n", "terms", "tfs"]
                )

    return rows.select(F.col(key).cast("bigint"), text).mapInArrow(run, INDEX)


def _counted(texts: pa.Array, wanted: pa.Array | None) -> list[pa.Array]:
    words, firsts, _ = cut_words(texts, TERM_KINDS)
    sizes = np.diff(firsts)
    owners = np.repeat(np.arange(len(texts)), sizes)
    if wanted is None:
        coded = words.dictionary_encode()
        known, places = coded.dictionary, coded.indices.to_numpy()
    else:
        found = pc.index_in(words, value_set=wanted)
        hit = found.is_valid().to_numpy(zero_copy_only=False)
        known, places, owners = wanted, found.drop_null().to_numpy(), owners[hit]
    span = max(1, len(known))
    pairs, counts = np.unique(owners * span + places.astype(np.int64), return_counts=True)
    bounds = np.searchsorted(pairs, np.arange(len(texts) + 1) * span)
    terms = known.take(pa.array(pairs % span))
    return [
        pa.array(sizes.astype(np.int64)),
        list_array(bounds, terms),
        list_array(bounds, pa.array(counts.astype(np.int32))),
    ]


class Block:
    """Items that are searched together: their terms, weights and frequencies."""

    def __init__(self, pairs: pa.Table, scale: tuple[int, int]):
        self.documents, self.length = scale  # N and L
        coded = pairs["term"].combine_chunks().dictionary_encode()
        self.terms, index = coded.dictionary, coded.indices.to_numpy()
        self.weights = np.zeros(len(self.terms), np.int64)
        self.weights[index] = pairs["w"].to_numpy()
        frequency = pairs["df"].to_numpy()
        items = pairs["item"].to_numpy()
        order = np.lexsort((index, frequency, items))  # rarest first
        self.items, starts = np.unique(items[order], return_index=True)
        self.plans = np.split(index[order], starts[1:]) if len(order) else []


class Best:
    """The k best (score, document) of an item so far; ties go to the smaller id, null first."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.known = (np.empty(0, t) for t in (np.int64, np.int64, bool))

    @property
    def floor(self) -> int:
        """A score below it cannot enter any more."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, known = np.concatenate([self.ids, ids]), np.concatenate([self.known, known])
        order = np.lexsort((ids, known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]


def kth_largest(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


class Shard:
    """Postings of some documents: for each term its documents and what it adds to their scores."""

    def __init__(self, block: Block, terms, documents, added, ids: np.ndarray, known: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.documents, self.added = documents[order], added[order]
        self.bounds = np.searchsorted(terms[order], np.arange(len(block.terms) + 1))
        self.ids, self.known = ids, known
        self.most = np.zeros(len(block.terms), np.int64)  # that a term adds to any document
        held = np.flatnonzero(np.diff(self.bounds))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.added, self.bounds[held])
        self.scores = np.zeros(len(ids), np.int64)
        self.opened = np.zeros(len(ids), bool)

    def search(self, plan: np.ndarray, best: Best) -> int:
        """Add the best documents of a plan (terms, rarest first); how many accumulators it took."""
        remaining = np.cumsum(self.most[plan][::-1])[::-1]
        opening, accumulators = True, np.empty(0, np.int64)
        for term, bound in zip(plan, remaining):
            a, b = self.bounds[term], self.bounds[term + 1]
            if a == b:
                continue
            if opening:
                partial = kth_largest(self.scores[accumulators], best.k)
                # a new document that only ties may still win by its id
                opening = bound >= max(partial, best.floor)
            documents, added = self.documents[a:b], self.added[a:b]
            if opening:
                fresh = documents[~self.opened[documents]]
                self.opened[fresh] = True
                accumulators = np.concatenate([accumulators, fresh])
            else:
                survivors = self.opened[documents]
                documents, added = documents[survivors], added[survivors]
            self.scores[documents] += added
        found = self.scores[accumulators]
        enough = max(1, best.floor, kth_largest(found, best.k))
        top = accumulators[found >= enough]
        best.add(self.scores[top], self.ids[top], self.known[top])
        self.scores[accumulators] = 0
        self.opened[accumulators] = False
        return len(accumulators)


def _shards(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[Shard]:
    """Shards of a task's part of the index, of about SHARD_POSTINGS postings."""
    held, documents, postings = [], 0, 0

    def shard() -> Shard:
        columns = [np.concatenate(c) for c in zip(*held)]
        return Shard(block, *columns)

    for batch in batches:
        keys, sizes, terms, tfs = batch.columns
        found = pc.index_in(terms.flatten(), value_set=block.terms)
        hit = found.is_valid().to_numpy(zero_copy_only=False)
        owners = np.repeat(np.arange(len(batch)), pc.list_value_length(terms).to_numpy())[hit]
        index = found.drop_null().to_numpy().astype(np.int64)
        tf = tfs.flatten().to_numpy().astype(np.int64)[hit]
        n = sizes.to_numpy()
        m = 100 - 50 + (50 * n * block.documents) // max(1, block.length)
        added = block.weights[index] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[owners]))
        known = keys.is_valid().to_numpy(zero_copy_only=False)
        ids = pc.fill_null(keys, 0).to_numpy()
        held.append((index, owners + documents, added, ids, known))
        documents, postings = documents + len(batch), postings + len(index)
        if postings > SHARD_POSTINGS:
            yield shard()
            held, documents, postings = [], 0, 0
    if held:
        yield shard()


def _search(index: DataFrame, block: Block, k: int) -> DataFrame:
    """The k best documents of each item and task: rows (item, doc_id, score)."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        bests = [Best(k) for _ in block.plans]
        for shard in _shards(batches, block):
            for plan, best in zip(block.plans, bests):
                shard.search(plan, best)
        for item, best in zip(block.items, bests):
            if len(best.ids):
                ids = pa.array(best.ids, mask=~best.known)
                items = pa.array(np.full(len(ids), item, np.int64))
                columns = [items, ids, pa.array(best.scores)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def weight(documents: Column, frequency: Column) -> Column:
    """floor(1000 ln((2N + 2) / (2 df + 1))), in doubles."""
    share = (2 * documents + 2).cast("double") / (2 * frequency + 1).cast("double")
    return F.floor(1000 * F.log(share)).cast("bigint")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: rows (item_id, rank, doc_id, score).

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read. Scores
    are above 0, ranks run from 1 without gaps, equal scores go by ascending doc_id, null first.
    Every row of ``items`` is an item of its own, also where item_ids repeat or are null, and
    every row of ``docs`` a document. Null and empty texts have no terms: such documents are never
    found and such items find nothing. Whole texts of any length are read; empty tables give no
    rows.

    Items are searched in blocks of BLOCK_PAIRS terms; a block is all that goes to the driver and
    to the tasks. No document list is shuffled but each task's k best.
    """
    spark = docs.sparkSession
    number = F.monotonically_increasing_id().alias("item")
    numbered = store(items.select(number, F.col("item_id").alias("item_id"), "text"), "items")
    pairs = store(
        term_index(numbered, "item", "text").select(F.col("key").alias("item"), F.explode("terms").alias("term")),
        "item-terms",
    )
    wanted = pairs.select("term").distinct()
    few = wanted.limit(WANTED_TERMS + 1).count() <= WANTED_TERMS
    listed = wanted.toArrow()["term"].combine_chunks() if few else None
    index = store(term_index(docs, "doc_id", "text", listed).where("n > 0"), "term-index")
    totals = index.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    frequency = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighed = pairs.join(frequency, "term").withColumn("w", weight(F.lit(totals.n), F.col("df")))
    weighed = store(weighed, "item-weights")
    blocks = -(-weighed.count() // BLOCK_PAIRS)
    index = index.where(F.size("terms") > 0)
    found = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    for b in range(blocks):
        own = weighed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "term", "df", "w")
        block = Block(own.toArrow(), (totals.n, totals.l))
        found = found.unionByName(store(_search(index, block, k), "found"))
    ranked = _ranked(found, k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Ranks within items, merged in MERGE_GROUPS groups first so that no task gets them all."""
    order = [F.desc("score"), F.asc("doc_id")]
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    first = F.row_number().over(Window.partitionBy("item", "_part").orderBy(*order))
    few = found.withColumn("_part", part).withColumn("_rank", first).where(F.col("_rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return few.withColumn("rank", rank).where(F.col("rank") <= k)
