"""Collocations by stripes: every prefix keys a counter of the words that follow it.

Level m has the prefixes of m - 1 words. Tasks count their own stripes, which are merged element by
element; a merged stripe gives the counts of all extensions, the total of its prefix and the most
frequent extension, which is what subsumption asks for. A phrase of m words can only be frequent if
both phrases of m - 1 words in it are, so each level counts extensions of frequent prefixes by
frequent suffixes alone and keeps all others in one slot of the stripe, where the total needs them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.words import byte_kinds, cut_words, mix, slices, word_hashes
from quillspark.session import store

#: Words are cut at blanks and tabs, pieces at marks and line ends.
PIECES = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
LONGEST = 4

#: Text that a task counts at once.
COUNT_BYTES = 8 << 20
#: A prefix with more than this share of all words is hot; there are fewer than HOT_SHARE of them.
HOT_SHARE = 1024
#: Parts of a hot prefix's stripe, by the next word.
HOT_PARTS = 64
#: Bits per frequent phrase in the filter that tasks get, and its size at most (16 MB). Where it is
#: too small, phrases pass that need not; they cost counting, and results stay the same.
BITS_PER_PHRASE, MOST_BITS = 16, 1 << 27

#: On their way to be merged, stripes are written small: the key is the prefix, a tab and the
#: language, the next words stand in one text with blanks between them.
STRIPES = "key string, part int, nexts string, counts array<int>"
MERGED = (
    "lang string, prefix string, part int, nexts array<string>, counts array<bigint>, "
    "total bigint, best bigint"
)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FRESH = np.uint64(0x243F6A8885A308D3)


@dataclass
class Frequent:
    """Hashes of the frequent phrases of one length as a bit table, and of the hot ones."""

    bits: np.ndarray
    hot: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slots = hashes & np.uint64(64 * len(self.bits) - 1)
        return (self.bits[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def _extended(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all its words but the last and that of the last."""
    return mix(hashes * _STEP + words)


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(lang) for lang in langs], np.uint64) ^ _FRESH


@F.arrow_udf(T.LongType())
def phrase_hash(langs: pa.Array, phrases: pa.Array) -> pa.Array:
    """The hash that counting tasks give a phrase (words with one blank between) of a language."""
    coded = langs.dictionary_encode()
    found = _lang_hashes(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    words = pc.split_pattern(phrases, " ")
    sizes = pc.list_value_length(words).to_numpy()
    hashes, firsts = word_hashes(words.flatten()), np.cumsum(sizes) - sizes
    for place in range(LONGEST):
        rows = np.flatnonzero(sizes > place)
        found[rows] = _extended(found[rows], hashes[firsts[rows] + place])
    return pa.array(found.view(np.int64))


def _words(batch: pa.RecordBatch, start: int, stop: int):
    """Words of a slice, the language of each, the codes' languages, and who continues a piece."""
    langs = pc.fill_null(batch.column(0).slice(start, stop - start), "und").dictionary_encode()
    words, firsts, continues = cut_words(batch.column(1).slice(start, stop - start), PIECES)
    codes = np.repeat(langs.indices.to_numpy().astype(np.int64), np.diff(firsts))
    return words, codes, langs.dictionary, continues


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f): occurrences of every word, the stripe of the empty prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1), COUNT_BYTES):
                words, codes, langs, _ = _words(batch, start, stop)
                coded = words.dictionary_encode()
                span = max(1, len(coded.dictionary))
                pairs, counts = np.unique(codes * span + coded.indices.to_numpy(), return_counts=True)
                columns = [
                    langs.take(pa.array(pairs // span)),
                    coded.dictionary.take(pa.array(pairs % span)),
                    pa.array(counts),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])

    counted = docs.mapInArrow(run, "lang string, phrase string, f bigint")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(phrases: DataFrame, total: int) -> Frequent:
    """The filter of frequent phrases (lang, phrase, f).

    To the driver come the bits, MOST_BITS at most, and the hot ones, fewer than HOT_SHARE.
    """
    hashed = store(phrases.select("f", phrase_hash("lang", "phrase").alias("hash")), "phrase-hashes")
    size = 1 << 12
    while size < min(MOST_BITS, BITS_PER_PHRASE * hashed.count()):
        size *= 2
    slot = F.col("hash").bitwiseAND(F.lit(size - 1))
    bit = F.expr("shiftleft(1L, int(slot % 64))")
    cells = hashed.select(slot.alias("slot")).groupBy((F.col("slot") / 64).cast("bigint").alias("cell"))
    found = cells.agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    hot = hashed.where(F.col("f") > max(1, total // HOT_SHARE)).select("hash").toArrow()["hash"]
    return Frequent(bits, np.sort(hot.to_numpy().view(np.uint64)))


def _stripes(batch: pa.RecordBatch, start: int, stop: int, size: int, frequent: Frequent):
    """Stripes of the prefixes of ``size`` words in a slice, as a batch."""
    words, codes, langs, continues = _words(batch, start, stop)
    coded = words.dictionary_encode()
    known, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    span = max(1, len(known))
    digests = word_hashes(known)
    starts = np.arange(len(words))
    hashes = _lang_hashes(langs.to_pylist())[codes] if len(words) else np.empty(0, np.uint64)
    ids = codes
    for place in range(size):
        if place:
            inside = starts + place < len(words)
            inside[inside] = continues[starts[inside] + place]
            starts, hashes, ids = starts[inside], hashes[inside], ids[inside]
        at = index[starts + place]
        hashes, ids = _extended(hashes, digests[at]), ids * span + at
        if place and place + 1 < size:  # keeps ids small
            ids = np.unique(ids, return_inverse=True)[1]
    passes = np.zeros(len(words) + 1, bool)
    passes[starts] = frequent.holds(hashes)
    kept = passes[starts]
    starts, hashes, ids = starts[kept], hashes[kept], ids[kept]
    last = starts + size
    follows = last < len(words)
    follows[follows] = continues[last[follows]] & passes[starts[follows] + 1]
    nexts = np.full(len(starts), -1)
    nexts[follows] = index[last[follows]]

    _, first, prefix = np.unique(ids, return_index=True, return_inverse=True)
    parts = np.zeros(len(starts), np.int64)
    split = np.isin(hashes, frequent.hot) & follows
    parts[split] = (digests[nexts[split]] % np.uint64(HOT_PARTS)).astype(np.int64)
    keys, counts = np.unique((prefix * HOT_PARTS + parts) * (span + 1) + nexts + 1, return_counts=True)
    groups, nexts = keys // (span + 1), keys % (span + 1) - 1
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else groups
    example = starts[first[groups[heads] // HOT_PARTS]]
    places = [known.take(pa.array(index[example + place])) for place in range(size)]
    key = pc.binary_join_element_wise(
        pc.binary_join_element_wise(*places, " "), langs.take(pa.array(codes[example])), "\t"
    )
    offsets = pa.array(np.append(heads, len(groups)).astype(np.int32))
    slots = pc.fill_null(known.take(pa.array(nexts, mask=nexts < 0)), "")
    columns = [
        key,
        pa.array((groups[heads] % HOT_PARTS).astype(np.int32)),
        pc.binary_join(pa.ListArray.from_arrays(offsets, slots), " "),
        pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["key", "part", "nexts", "counts"])


def count_stripes(docs: DataFrame, size: int, frequent: Frequent) -> DataFrame:
    """Stripes of the frequent prefixes of ``size`` words, one per slice of text.

    An entry counts the occurrences of the prefix before one next word; the word "" stands for the
    end of a piece and for all words that make no frequent phrase.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1), COUNT_BYTES):
                yield _stripes(batch, start, stop, size, shared.value)

    return docs.mapInArrow(run, STRIPES)


def _opened(batch: pa.RecordBatch) -> pa.Table:
    """Stripes with their next words as lists and counts of 64 bits."""
    counts = batch.column("counts")
    offsets = pa.array((counts.offsets.to_numpy() - counts.offsets[0].as_py()).astype(np.int32))
    wide = pa.ListArray.from_arrays(offsets, counts.flatten().cast(pa.int64()))
    nexts = pc.split_pattern(batch.column("nexts"), " ")
    return pa.table([batch.column("key"), batch.column("part"), nexts, wide], ["key", "part", "nexts", "counts"])


def _merge(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Rows that follow each other with one key added element by element; the entries' rows."""
    keys = [rows[c].combine_chunks() for c in ("key", "part")]
    changes = np.ones(len(rows), bool)
    if len(rows) > 1:
        changes[1:] = False
        for key in keys:
            changes[1:] |= pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
    heads = pa.array(np.flatnonzero(changes))
    lists, counts = rows["nexts"].combine_chunks(), rows["counts"].combine_chunks()
    group = np.repeat(np.cumsum(changes) - 1, pc.list_value_length(lists).to_numpy())
    coded = lists.flatten().dictionary_encode()
    span = max(1, len(coded.dictionary))
    entries, places = np.unique(group * span + coded.indices.to_numpy(), return_inverse=True)
    sums = np.zeros(len(entries), np.int64)
    np.add.at(sums, places, counts.flatten().to_numpy())
    owners = entries // span
    offsets = pa.array(np.searchsorted(owners, np.arange(len(heads) + 1)).astype(np.int32))
    nexts = pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(entries % span)))
    columns = [*[key.take(heads) for key in keys], nexts, pa.ListArray.from_arrays(offsets, pa.array(sums))]
    return pa.table(columns, ["key", "part", "nexts", "counts"]), owners


def _summed(merged: pa.Table, owners: np.ndarray, least: int) -> pa.Table:
    """Merged stripes with their total and most frequent extension; rare extensions go."""
    nexts = merged["nexts"].combine_chunks().flatten()
    counts = merged["counts"].combine_chunks().flatten().to_numpy()
    total = np.zeros(len(merged), np.int64)
    np.add.at(total, owners, counts)
    words = pc.not_equal(nexts, "").to_numpy(zero_copy_only=False)
    best = np.zeros(len(merged), np.int64)
    np.maximum.at(best, owners[words], counts[words])
    kept = words & (counts >= least)
    offsets = pa.array(np.searchsorted(owners[kept], np.arange(len(merged) + 1)).astype(np.int32))
    key = pc.split_pattern(merged["key"].combine_chunks(), "\t", max_splits=1)
    return pa.table(
        [
            pc.list_element(key, 1),
            pc.list_element(key, 0),
            merged["part"],
            pa.ListArray.from_arrays(offsets, nexts.filter(pa.array(kept))),
            pa.ListArray.from_arrays(offsets, pa.array(counts[kept])),
            pa.array(total),
            pa.array(best),
        ],
        ["lang", "prefix", "part", "nexts", "counts", "total", "best"],
    )


def merge_stripes(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes merged element by element, sorted partition by partition and read as a stream.

    A task holds one batch and the stripe it is at. A prefix's stripe is one row, a hot one's
    HOT_PARTS rows with different words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = _opened(batch)
            merged, owners = _merge(rows if held is None else pa.concat_tables([held, rows]))
            held = merged.slice(len(merged) - 1)
            done = owners < len(merged) - 1
            if len(merged) > 1:
                yield from _summed(merged.slice(0, len(merged) - 1), owners[done], least).to_batches()
        if held is not None:
            yield from _summed(*_merge(held), least).to_batches()

    key = ["key", "part"]
    return stripes.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, MERGED)


def extensions(stripes: DataFrame) -> DataFrame:
    """(lang, phrase, f): a prefix and each of its frequent next words."""
    entries = stripes.select("lang", "prefix", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
    return entries.select("lang", F.concat_ws(" ", "prefix", "e.nexts").alias("phrase"), F.col("e.counts").alias("f"))


def exact_score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(2000000 a / (l + r)) in 38 digits."""
    wide = [c.cast("decimal(20,0)") for c in (a, l, r)]
    return F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * wide[0], wide[1] + wide[2])


def collocations(docs: DataFrame, least: int = 30, most: int = 2000) -> DataFrame:
    """The ``most`` best phrases of two to four words of each language (a null one is ``und``).

    Rows (lang, rank, phrase, a, l, r, n, score). ``a`` counts a phrase, ``least`` times or more,
    and ``n`` the words of the language. The score of a cut into a beginning found l times and
    the rest found r times is floor(2000000 a / (l + r)); the lowest one counts, of equal ones the
    shortest beginning. Phrases that stand in a longer one with 80 % of their count or more are
    left out. Order: score and a falling, phrase rising by its UTF-8 bytes.

    Null and empty texts have no words, repeated rows count again, texts of any length are read
    whole. An empty table gives no rows; other columns than text and lang are not read.
    """
    docs = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    words = store(word_counts(docs), "words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n")).first().n
    levels, phrases = [], words.where(F.col("f") >= least)
    for size in range(1, LONGEST):
        frequent = frequent_phrases(phrases, total)
        merged = merge_stripes(count_stripes(docs, size, frequent), least)
        levels.append(store(merged, f"stripes-{size}"))
        phrases = extensions(levels[-1])
    return _best(levels, sizes, least, most)


def _best(levels: list[DataFrame], sizes: DataFrame, least: int, most: int) -> DataFrame:
    stripes = levels[0]
    for level in levels[1:]:
        stripes = stripes.unionByName(level)
    candidates = store(_scored(extensions(stripes), stripes), "candidates")
    whole = _subsumed(candidates, stripes, least)
    standing = candidates.join(whole, ["lang", "phrase"], "left")
    standing = standing.where(F.coalesce(100 * F.col("longer") < 80 * F.col("a"), F.lit(True)))
    standing = store(standing.drop("longer"), "standing")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    groups = max(1, int((standing.count() / most) ** 0.5))  # meet in two steps of equal size
    group = F.pmod(F.xxhash64("phrase"), F.lit(groups))
    first = F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order))
    few = standing.withColumn("_group", group).withColumn("_first", first).where(F.col("_first") <= most)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = few.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= most)
    return ranked.join(F.broadcast(sizes), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _scored(candidates: DataFrame, stripes: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of candidates by their lowest-scoring cut."""
    totals = stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("total"))
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    begin = F.array_join(F.slice("w", F.lit(1), F.col("k")), " ")
    rest = F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ")
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", begin.alias("begin"), rest.alias("rest"))
    for part, name in (("begin", "l"), ("rest", "r")):
        own = totals.select("lang", F.col("prefix").alias(part), F.col("total").alias(name))
        cuts = cuts.join(own, ["lang", part])
    score = exact_score(F.col("a"), F.col("l"), F.col("r"))
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    found = cuts.groupBy("lang", "phrase", "a").agg(lowest)
    return found.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _subsumed(candidates: DataFrame, stripes: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, longer): the count of the most frequent phrase that is one word longer.

    Longer ones still are no more frequent than one of those, so they need not be looked at.
    """
    after = stripes.where(F.col("best") >= least).select(
        "lang", F.col("prefix").alias("phrase"), F.col("best").alias("longer")
    )
    long = candidates.where(F.size(F.split("phrase", " ")) > 2)
    rest = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    before = long.select("lang", rest.alias("phrase"), F.col("a").alias("longer"))
    return after.unionByName(before).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
