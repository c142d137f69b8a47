"""Near duplicates: HyperMinHash registers, banding, exact confirmation and components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.components import connected_components
from quillspark.llm.words import (
    SMALL_SLICE,
    giving_back,
    mix,
    plain_texts,
    slices,
    split_words,
    word_hashes,
)
from quillspark.session import store

#: Registers of a set, and chance that a pair at the threshold shares no band of them (see band_rows).
REGISTERS, LOST = 128, 1e-7
#: A register: leading zeros of the least hash in 6 bits, and the MANTISSA bits after its first one.
MANTISSA = 10
#: Rounds of fresh partners before the rest is compared in full, and rows of one such comparison.
ROUNDS, BLOCK_ROWS = 2, 2000
#: Standard deviations of the estimate that a pair may lie below the threshold before it is left
#: unconfirmed. Of sets smaller than REGISTERS the estimate deviates up to 1.3 times as much.
MARGIN = 8

_SEED = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.iinfo(np.uint64).max
#: For each bucket, all buckets in an order of its own.
_ORDER = mix(np.arange(1, REGISTERS**2 + 1, dtype=np.uint64) * _SEED).reshape(REGISTERS, -1).argsort(axis=1)


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the ``width``-word shingles of each lower-cased text, and n + 1 offsets.

    A text of fewer words has one shingle, the whole sequence; one without words has none.
    """
    words, places = split_words(pc.ascii_lower(plain_texts(texts)))
    hashes = word_hashes(words)
    counts = np.diff(places)
    rolled = mix(hashes + np.uint64(width))
    full = max(len(hashes) - width + 1, 0)
    folded = rolled[:full].copy()
    for i in range(1, width):
        folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + rolled[i : i + full])
    kept = np.maximum(counts - width + 1, 0)
    short = (counts > 0) & (counts < width)
    sizes = kept + short
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.empty(offsets[-1], np.uint64)
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + np.repeat(places[:-1], sizes)
    long = np.repeat(~short, sizes)
    out[long] = folded[at[long]]
    for row in np.flatnonzero(short):
        value = np.uint64(counts[row])
        with np.errstate(over="ignore"):
            for h in hashes[places[row] : places[row + 1]]:
                value = mix(np.array([value * np.uint64(0x9E3779B97F4A7C15) + h], np.uint64))[0]
        out[offsets[row]] = value
    return out, offsets


def distinct_sets(hashes: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    return [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]


def registers(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of non-empty sets, REGISTERS numbers of 16 bits for each.

    The low bits of an item's one hash choose its bucket. The bucket keeps the least hash, shortened
    to its number of leading zeros and the mantissa bits that follow its first one. A bucket that no
    item falls into takes the register of the first filled one in an order of its own, so that
    those of small sets agree as often as the sets do.
    """
    rows = len(offsets) - 1
    keyed = mix(hashes ^ _SEED)
    slots = np.repeat(np.arange(rows) * REGISTERS, np.diff(offsets))
    slots += (keyed % np.uint64(REGISTERS)).astype(np.int64)
    least = np.full(rows * REGISTERS, _EMPTY)
    np.minimum.at(least, slots, keyed)
    filled = np.zeros(rows * REGISTERS, bool)
    filled[slots] = True
    least, filled = least.reshape(rows, REGISTERS), filled.reshape(rows, REGISTERS)
    out = compress(least)
    own = out.copy()
    row, bucket = np.nonzero(~filled)
    for step in range(REGISTERS):
        if not len(row):
            break
        other = _ORDER[bucket, step]
        hit = filled[row, other]
        out[row[hit], bucket[hit]] = own[row[hit], other[hit]]
        row, bucket = row[~hit], bucket[~hit]
    return out


def compress(least: np.ndarray) -> np.ndarray:
    """Leading zeros << MANTISSA | mantissa of 64-bit values."""
    # bit lengths; a value just under a power of two may round up to it
    exponent = np.minimum(np.frexp(least.astype(np.float64))[1], 64)
    over = (exponent > 0) & ((least >> np.maximum(exponent - 1, 0).astype(np.uint64)) == 0)
    exponent = exponent - over
    zeros = np.minimum(64 - exponent, 63).astype(np.uint64)
    shifted = least << np.minimum(zeros + np.uint64(1), np.uint64(63))
    mantissa = shifted >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


@lru_cache(maxsize=10_000)
def collision_rate(left: int, right: int) -> float:
    """Chance that registers of two unrelated sets of 2 ** left and 2 ** right members agree."""
    zeros = np.arange(40)[:, None]
    steps = np.arange(1 << MANTISSA)[None, :]
    width = 2.0 ** -(zeros + 1.0)
    low, high = width * (1 + steps / (1 << MANTISSA)), width * (1 + (steps + 1) / (1 << MANTISSA))

    def share(n: float) -> np.ndarray:
        return np.exp(n * np.log1p(-np.minimum(low, 1 - 1e-12))) - np.exp(
            n * np.log1p(-np.minimum(high, 1 - 1e-12))
        )

    return float((share(2.0**left) * share(2.0**right)).sum())


def estimate(same: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of sets of ``left`` and ``right`` items from the number of equal registers.

    It is corrected for chance agreement of buckets with as many items.
    """
    logs = np.log2(np.maximum(np.stack([left, right]) / REGISTERS, 1)).round().astype(int)
    chance = np.array([collision_rate(a, b) for a, b in logs.T.tolist()])
    return np.clip((same / REGISTERS - chance) / (1 - chance), 0, 1)


_SIGNED = (
    "doc_id bigint, n_shingles bigint, set_low bigint, set_high bigint, registers binary"
)


def sign(docs: DataFrame, width: int) -> DataFrame:
    """Per row: size of its shingle set, 128 bits that stand for the set, and its registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in giving_back(batches):
            for start, stop in slices(batch.column(1), SMALL_SLICE):
                texts = batch.column(1).slice(start, stop - start)
                sets = distinct_sets(*shingle_hashes(texts, width))
                sizes = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                filled = np.flatnonzero(sizes)
                low, high = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
                signed = np.empty((0, REGISTERS), np.uint16)
                if len(filled):
                    heads = offsets[filled]
                    low[filled] = np.add.reduceat(flat, heads)
                    high[filled] = np.add.reduceat(mix(flat ^ _SEED), heads)
                    signed = registers(flat, np.append(heads, offsets[-1]))
                packed: list[bytes | None] = [None] * len(sizes)
                for row, place in enumerate(filled.tolist()):
                    packed[place] = signed[row].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(sizes),
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        pa.array(packed, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_low", "set_high", "registers"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _SIGNED)


def band_rows(percent: int) -> int:
    """Registers of a band: the most that let fewer than LOST of the pairs at the threshold share none."""
    share = percent / 100
    sizes = [r for r in (16, 8, 4, 2) if (1 - share**r) ** (REGISTERS // r) < LOST]
    return sizes[0] if sizes else 1


def bands(signed: DataFrame, rows: int) -> DataFrame:
    """Rows (band, id) for sets (id, registers); ``band`` hashes the band's number and content."""
    parts = F.array(
        *[
            F.xxhash64(F.lit(b), F.substring("registers", 1 + 2 * rows * b, 2 * rows))
            for b in range(REGISTERS // rows)
        ]
    )
    return signed.select(F.explode(parts).alias("band"), "id")


def set_rows(docs: DataFrame, width: int) -> DataFrame:
    """Rows (id, items): sorted distinct shingle hashes of documents that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in giving_back(batches):
            for start, stop in slices(batch.column(1), SMALL_SLICE):
                texts = batch.column(1).slice(start, stop - start)
                sets = distinct_sets(*shingle_hashes(texts, width))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate(sets).view(np.int64)
                items = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), items], ["id", "items"]
                )

    return docs.mapInArrow(run, "id bigint, items array<bigint>")


def plausible(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimated similarity lies at most MARGIN deviations under the threshold."""
    limit = percent / 100
    limit -= MARGIN * math.sqrt(limit * (1 - limit) / REGISTERS)

    @F.arrow_udf("double")
    def estimated(left: pa.Array, right: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.float64())
        tables = [
            np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, REGISTERS)
            for x in (left, right)
        ]
        same = (tables[0] == tables[1]).sum(axis=1)
        return pa.array(estimate(same, n.to_numpy(), m.to_numpy()))

    left = signed.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    right = signed.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    joined = pairs.join(right, "b").join(left, "a")
    return joined.where(estimated("r_a", "r_b", "n_a", "n_b") >= limit).select("a", "b")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("right"))
    joined = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("left", "right"))
    rows = joined.select("a", "b", common.alias("c"), (F.size("left") + F.size("right")).alias("n"))
    return rows.where(F.col("c") * 100 >= (F.col("n") - F.col("c")) * percent).select("a", "b")


class SetIndex:
    """Sets under their members, to count what each has in common with another set."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        items = np.concatenate(sets)
        order = np.argsort(items, kind="stable")
        self.items = items[order]
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def similar(self, items: np.ndarray, percent: int) -> np.ndarray:
        """Places of the sets that are similar enough to ``items``."""
        first = np.searchsorted(self.items, items, "left")
        counts = np.searchsorted(self.items, items, "right") - first
        ends = np.cumsum(counts)
        at = np.repeat(first - (ends - counts), counts) + np.arange(ends[-1])
        common = np.bincount(self.owners[at], minlength=len(self.sizes))
        return np.flatnonzero(common * 100 >= (self.sizes + len(items) - common) * percent)


def _links_of_block(percent: int):
    """One link for each outsider of a block that is similar to one of its members, or, in a
    block of outsiders alone, the links that join what is similar."""

    def links(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
        ids, sets = rows["id"].to_numpy(), list(rows["items"])
        outside = rows["outside"].to_numpy()
        among = bool(outside.all())
        inside = np.arange(len(ids)) if among else np.flatnonzero(~outside)
        index = SetIndex([sets[i] for i in inside])
        for y in np.flatnonzero(outside):
            found = inside[index.similar(sets[y], percent)]
            found = found[found < y] if among else found[:1]
            yield from ((ids[y], ids[x]) for x in found)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_spanning(links(rows)), columns=["a", "b"], dtype="int64")

    return run


def _spanning(links: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links that join as much as all of them, no more than one per id."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for a, b in links:
        x, y = find(int(a)), find(int(b))
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((min(int(a), int(b)), max(int(a), int(b))))
    return kept


def _parts(count: str) -> Column:
    return F.ceil(F.col(count) / BLOCK_ROWS).cast("bigint")


def _deal(key: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(key), parts)


def _all(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))


def late_links(rows: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links over the borders of components, from full sets.

    ``rows``: (band, id, component, main, rest) of buckets that hold several components;
    ``members``: (id, component) of all documents in buckets. Outsiders of a bucket's main
    component meet all its members, in blocks of at most about BLOCK_ROWS of either; outsiders
    of one bucket meet each other likewise. Tasks give at most a link per document.
    """
    attached = rows.where("rest").select("id", F.col("main").alias("component")).distinct()
    outside = attached.groupBy("component").agg(F.count(F.lit(1)).alias("outsiders"))
    inside = members.join(outside, "component")
    sizes = inside.groupBy("component").agg(
        F.count(F.lit(1)).alias("insiders"), F.first("outsiders").alias("outsiders")
    )
    sizes = store(sizes, "open-components")
    blocks, chunks = _parts("insiders"), _parts("outsiders")
    shape = ["component", "block", "chunk", "id", "outside"]
    within = members.join(sizes, "component").withColumns(
        {"block": _deal("id", blocks), "outside": F.lit(False)}
    )
    within = within.withColumn("chunk", _all(chunks)).select(shape)
    without = attached.join(sizes, "component").withColumns(
        {"chunk": _deal("id", chunks), "outside": F.lit(True)}
    )
    without = without.withColumn("block", _all(blocks)).select(shape)
    dealt = within.unionByName(without).join(sets, "id")
    schema, run = "a bigint, b bigint", _links_of_block(percent)
    to_main = dealt.groupBy("component", "block", "chunk").applyInPandas(run, schema)

    rest = rows.where("rest").select("band", "id", "component")
    several = rest.groupBy("band").agg(
        F.count(F.lit(1)).alias("outsiders"),
        F.min("component").alias("least"),
        F.max("component").alias("most"),
    )
    crowded = rest.join(several.where("least <> most"), "band").withColumn("own", _deal("id", chunks))
    crowded = crowded.withColumn("other", _all(chunks))
    crowded = crowded.select(
        "band",
        F.least("own", "other").alias("block"),
        F.greatest("own", "other").alias("chunk"),
        "id",
        F.lit(True).alias("outside"),
    )
    among = crowded.join(sets, "id").groupBy("band", "block", "chunk").applyInPandas(run, schema)
    return to_main.unionByName(among).distinct()


def near_duplicate_links(signed: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) that connect every class of ``signed``: (id, n, registers).

    A bucket holds the sets that share a band. First every member is paired with the bucket's
    smallest id. While a bucket still holds several components, members outside its most common
    one are paired with members inside it, chosen anew by hash. These pairs are confirmed if
    their registers make them plausible. What is still apart after that is compared in full (see
    late_links). So no pair that shares a band is left out, but pairs within a component are
    never formed.
    """
    everything = bands(signed, band_rows(percent))
    buckets = everything.groupBy("band").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size"))
    shared = store(everything.join(buckets.where("size > 1"), "band"), "buckets")
    wanted = store(shared.select("id").distinct(), "bucket-ids")
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(wanted, "id", "left_semi")
    # the sets of documents that share a band with another one only
    sets = store(set_rows(texts, width), "sets")
    few = store(signed.join(wanted, "id", "left_semi"), "bucket-registers")
    pairs = shared.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links = store(confirm(plausible(pairs, few, percent), sets, percent), "links")

    def labelled() -> tuple[DataFrame, DataFrame]:
        """Members of buckets of three or more that hold several components; and all members."""
        parts = connected_components(links)
        members = wanted.join(parts, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
        members = store(members, "members")
        crowd = shared.where("size > 2").select("band", "id").join(members, "id")
        mixed = crowd.groupBy("band").agg(
            F.min("component").alias("least"), F.max("component").alias("most")
        )
        mixed = mixed.where("least <> most").select("band")
        open_rows = store(crowd.join(mixed, "band", "left_semi"), "open-buckets")
        votes = open_rows.groupBy("band", "component").agg(F.count(F.lit(1)).alias("members"))
        main = votes.groupBy("band").agg(F.max_by("component", F.struct("members", "component")).alias("main"))
        rows = open_rows.join(main, "band").withColumn("rest", F.col("component") != F.col("main"))
        return store(rows, "labelled"), members

    for turn in range(ROUNDS):
        rows, _ = labelled()
        inside = rows.where(~F.col("rest")).groupBy("band").agg(
            F.min_by("id", F.xxhash64("id", "band", F.lit(turn))).alias("a")
        )
        fresh = rows.where("rest").join(inside, "band")
        pairs = fresh.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()
        pairs = store(pairs, "pairs")
        if pairs.isEmpty():
            return links
        found = confirm(plausible(pairs, few, percent), sets, percent)
        links = store(links.unionByName(found), "links")

    rows, members = labelled()
    if rows.isEmpty():
        return links
    return store(links.unionByName(late_links(rows, members, sets, percent)), "links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents whose sets of distinct ``width``-word shingles (A-Z lower-cased, whole texts) have
    at least ``percent`` % in common are linked; ``component_id`` is the smallest id reachable,
    the document itself included, and ``kept`` marks that document.

    A text of fewer words has its whole sequence as its one shingle. Null and empty texts have
    none and stand alone, as do null ids, which are their own null component and always kept.
    Equal sets are joined before any comparison, so copies cost no pairs. Repeated rows share
    their component. An empty table gives no rows. Other columns are not read.
    """
    signed = store(sign(docs, width), "signed")
    known = signed.where("n_shingles > 0 and doc_id is not null")
    group = ["set_low", "set_high", "n_shingles"]
    classes = store(
        known.groupBy(*group).agg(
            F.min("doc_id").alias("id"), F.any_value("registers").alias("registers")
        ),
        "classes",
    )
    unique = classes.select("id", F.col("n_shingles").alias("n"), "registers")
    own = unique.groupBy("id").agg(F.min_by("n", "n").alias("n"), F.min_by("registers", "n").alias("registers"))
    links = near_duplicate_links(own, docs, width, percent)
    parts = connected_components(links)
    named = classes.select(*group, "id").join(parts, "id", "left")
    named = named.select(*group, F.coalesce("component", "id").alias("component_id"))
    rows = signed.select("doc_id", *group).join(named, group, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_representatives(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of every class of near duplicates, columns unchanged."""
    found = near_duplicates(docs, width, percent)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
