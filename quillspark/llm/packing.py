"""Packing documents into sequences by a grouping genetic algorithm with best-fit repair.

Pieces are dealt to shards; within a shard several islands evolve whole bins: crossover injects
well-filled bins of one parent into another, removes the bins that hold injected pieces twice
and best-fits the displaced pieces. After each epoch every island sends its elite, the best
packing, to the next island. All state between epochs is rows of stored tables.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, combinations
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.tokenize import worker_encoder
from quillspark.llm.words import giving_back, list_array, slices
from quillspark.session import store

CAPACITY = 2048
#: Pieces of a shard on average. A shard wastes at most about one sequence in its thousands.
SHARD_PIECES = 4000
#: Generations are only run where best fit misses the least number of sequences.
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2, 2, 12, 4
#: Bins injected or dissolved at once, at most; displaced items that pairs are made of; items of a
#: bin that are offered for a swap. They bound the work of a generation, not the result.
INJECTED, PAIRED, MEMBERS = 8, 40, 12

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_STATE = "shard bigint, island int, item int, length int, bin int"


def cut_pieces(
    docs: DataFrame, tokenizer: bytes, end_id: int, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pieces of every whole text: its ids and ``end_id``, cut every ``capacity`` ids.

    Columns: doc_id, piece, start (ids of the document before it), length, ids_crc32 (unsigned,
    of little-endian unsigned 32-bit ids) and, if wanted, ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        for batch in giving_back(batches, each=True):
            texts, owners = batch.column(1), batch.column(0)
            for first, stop in slices(texts):
                flat, offsets = encoder.encode_with_end(texts.slice(first, stop - first), end_id)
                sizes = np.diff(offsets)
                pieces = (sizes + capacity - 1) // capacity
                owner = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(sizes[owner] - start, capacity)
                at = offsets[owner] + start
                data = flat.astype("<u4", copy=False).view(np.uint8)
                crcs = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(at, length)]
                columns = [
                    owners.slice(first, stop - first).take(pa.array(owner)),
                    pa.array(number.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crcs, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(list_array(np.append(at, at[-1] + length[-1]), pa.array(flat.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, PIECE + (", ids array<int>" if with_ids else ""))


class Bins:
    """An open packing: bins as lists of items, found by the room they have left."""

    def __init__(self, lengths: Sequence[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set if some bin has room r

    def add_bin(self, items: list[int], room: int) -> None:
        self.by_room[room].append(len(self.bins))
        self.rooms |= 1 << room
        self.bins.append(items)

    def best_fit(self, item: int) -> None:
        """Into the fullest bin that has room, else into a new one."""
        length = self.lengths[item]
        fitting = self.rooms >> length
        if not fitting:
            self.add_bin([item], self.capacity - length)
            return
        room = length + (fitting & -fitting).bit_length() - 1
        place = self.by_room[room].pop()
        if not self.by_room[room]:
            self.rooms &= ~(1 << room)
        self.bins[place].append(item)
        left = room - length
        self.by_room[left].append(place)
        self.rooms |= 1 << left


Packing = list[list[int]]


def best_fit_all(items: Sequence[int], lengths: Sequence[int], capacity: int) -> Packing:
    open_bins = Bins(lengths, capacity)
    for item in items:
        open_bins.best_fit(item)
    return open_bins.bins


def fitness(packing: Packing, lengths: Sequence[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins that are either well filled or nearly empty."""
    fills = [sum([lengths[i] for i in b]) / capacity for b in packing]
    return -len(packing), sum(f * f for f in fills)


def _fill(members: list[int], lengths: Sequence[int]) -> int:
    return sum([lengths[i] for i in members])


class Displaced:
    """Items without a bin, by length, and the lengths that one or two of them have together."""

    def __init__(self, items: Iterable[int], lengths: Sequence[int]):
        self.items = sorted(items, key=lambda i: (lengths[i], i))
        self.lengths = lengths
        self._measure()

    def _measure(self) -> None:
        self.singles = [self.lengths[i] for i in self.items]
        # pairs of the items spread over all lengths: enough of them to fill most rooms
        step = max(1, len(self.items) // PAIRED)
        some = range(0, len(self.items), step)
        sums = [(self.singles[a] + self.singles[b], a, b) for a in some for b in some if a < b]
        self.pairs = sorted(sums)

    def best_within(self, limit: int) -> tuple[int, tuple[int, ...]]:
        """The largest length up to ``limit`` of one or two items, and their places."""
        at = bisect_right(self.singles, limit)
        best = (self.singles[at - 1], (at - 1,)) if at else (0, ())
        two = bisect_right(self.pairs, (limit, len(self.items), 0))
        if two and self.pairs[two - 1][0] > best[0]:
            best = self.pairs[two - 1][0], self.pairs[two - 1][1:]
        return best

    def swap(self, places: tuple[int, ...], back: list[int]) -> list[int]:
        taken = [self.items[p] for p in places]
        rest = [i for p, i in enumerate(self.items) if p not in places]
        self.items = sorted(rest + back, key=lambda i: (self.lengths[i], i))
        self._measure()
        return taken


def replace(bins: Packing, displaced: list[int], lengths: Sequence[int], capacity: int) -> list[int]:
    """Swap one or two items of a bin for one or two displaced ones that fill it better, bin by
    bin, the emptiest last. The bins change; what is displaced now is returned."""
    pool = Displaced(displaced, lengths)
    rooms = [(capacity - _fill(b, lengths), place) for place, b in enumerate(bins)]
    for room, place in sorted(rooms):
        if not pool.items:
            break
        members = bins[place]
        while room:
            best = (0, (), ())
            for out in chain([()], combinations(members[:MEMBERS], 1), combinations(members[:MEMBERS], 2)):
                gone = _fill(out, lengths)
                length, places = pool.best_within(gone + room)
                if length - gone > best[0]:
                    best = (length - gone, out, places)
                    if best[0] == room:
                        break
            gain, out, places = best
            if not gain:
                break
            room -= gain
            members[:] = [i for i in members if i not in out] + pool.swap(places, list(out))
    return pool.items


def _refilled(kept: Packing, displaced: list[int], lengths: Sequence[int], capacity: int) -> Packing:
    """A packing of bins and displaced items: replacement first, then best fit, longest first."""
    left = replace(kept, displaced, lengths, capacity)
    child = Bins(lengths, capacity)
    for b in kept:
        child.add_bin(b, capacity - _fill(b, lengths))
    for item in sorted(left, key=lambda i: (-lengths[i], i)):
        child.best_fit(item)
    return child.bins


def crossover(
    host: Packing, donor: Packing, lengths: Sequence[int], capacity: int, rng: np.random.Generator
) -> Packing:
    """Inject well-filled bins of the donor, drop the host's bins that hold any of their items,
    and place what was displaced."""
    known = {frozenset(b) for b in host}
    full = [b for b in donor if _fill(b, lengths) >= 0.98 * capacity and frozenset(b) not in known]
    if not full:
        return [list(b) for b in host]
    few = min(len(full), int(rng.integers(1, INJECTED + 1)))
    injected = [full[i] for i in rng.permutation(len(full))[:few]]
    inside = {i for b in injected for i in b}
    kept, displaced = [list(b) for b in injected], []
    for b in host:
        if inside.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced.extend(i for i in b if i not in inside)
    return _refilled(kept, displaced, lengths, capacity)


def mutate(
    packing: Packing, lengths: Sequence[int], capacity: int, rng: np.random.Generator
) -> Packing:
    """Dissolve the emptiest bins and some others, and place their items anew."""
    order = sorted(packing, key=lambda b: _fill(b, lengths))
    few = 1 + int(rng.integers(0, 3))
    others = rng.permutation(len(order) - few)[: int(rng.integers(0, INJECTED))] + few if len(order) > few else []
    gone = {*range(few), *map(int, others)}
    displaced = [i for place in gone if place < len(order) for i in order[place]]
    kept = [list(b) for place, b in enumerate(order) if place not in gone]
    return _refilled(kept, displaced, lengths, capacity)


def evolve(
    lengths: Sequence[int], seeds: list[Packing], capacity: int, seed: int
) -> Packing:
    """One epoch of one island; the best packing it has seen.

    It stops when no packing can have fewer bins than the best.
    """
    rng = np.random.default_rng(seed)
    least = -(-sum(lengths) // capacity)
    items = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))

    def rank(p: Packing) -> tuple[int, float]:
        return fitness(p, lengths, capacity)

    people = [(rank(p), p) for p in [*seeds, best_fit_all(items, lengths, capacity)]]
    best = max(people, key=itemgetter(0))
    if len(best[1]) <= least:
        return best[1]
    while len(people) < POPULATION:  # longest first, with chance neighbours swapped
        noise = np.array(lengths) * rng.uniform(0.9, 1.0, len(lengths))
        found = best_fit_all(np.argsort(-noise, kind="stable").tolist(), lengths, capacity)
        people.append((rank(found), found))
    for _ in range(GENERATIONS):
        people.sort(key=itemgetter(0), reverse=True)
        host, donor = people[0][1], people[1 + int(rng.integers(0, len(people) - 1))][1]
        children = [
            mutate(host, lengths, capacity, rng),
            mutate(crossover(host, donor, lengths, capacity, rng), lengths, capacity, rng),
        ]
        people = people[: POPULATION - 2] + [(rank(c), c) for c in children]
        best = max([best, *people], key=itemgetter(0))
        if len(best[1]) <= least:
            break
    return best[1]


def _epoch(capacity: int, seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """``bin`` is the packing that came to this island, -1 in the first epoch."""
        group = group.sort_values("item", kind="stable")
        shard, island = int(group["shard"].iat[0]), int(group["island"].iat[0])
        lengths, bins = group["length"].tolist(), group["bin"].tolist()
        seeds: list[Packing] = []
        if bins[0] >= 0:
            packing: Packing = [[] for _ in range(max(bins) + 1)]
            for item, b in enumerate(bins):
                packing[b].append(item)
            seeds.append(packing)
        best = evolve(lengths, seeds, capacity, hash((seed, shard, island)) & 0xFFFFFFFF)
        place = np.empty(len(lengths), np.int32)
        for b, members in enumerate(best):
            place[members] = b
        return group.assign(bin=place)

    return run


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, start, length, ids_crc32).

    Each sequence holds at most ``capacity`` ids without gaps. A piece that fills a sequence is
    one by itself and leaves the game at once. The number of shards follows the number of
    pieces, and a hash of the pieces deals them out evenly, whatever their lengths or documents.
    Repeated rows are packed each. No pieces give no rows.
    """
    stored = store(pieces, "pieces")
    count = stored.count()
    shards = max(1, round(count / shard_pieces))
    deal = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards))

    def number(group: pd.DataFrame) -> pd.DataFrame:
        """Items numbered by a stable order, so that a repeated task agrees."""
        group = group.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", na_position="first")
        return group.assign(item=np.arange(len(group), dtype=np.int32))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema.fields)
    numbered = store(
        stored.withColumn("shard", deal)
        .groupBy("shard")
        .applyInPandas(number, fields + ", shard bigint, item int"),
        "piece-items",
    )
    open_items = numbered.where(F.col("length") < capacity).select("shard", "item", "length")
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    state = open_items.select(
        "shard",
        islands.alias("island"),
        "item",
        F.col("length").cast("int"),
        F.lit(-1).alias("bin"),
    )
    for epoch in range(EPOCHS):
        evolved = state.groupBy("shard", "island").applyInPandas(_epoch(capacity, epoch), _STATE)
        state = store(evolved, "pack-epoch")
        # each elite moves on to the next island
        following = F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int")
        elites, state = state, state.withColumn("island", following)
    used = elites.groupBy("shard", "island").agg(F.max("bin").alias("bins"))
    best = used.groupBy("shard").agg(F.min(F.struct("bins", "island")).alias("best"))
    winners = best.select("shard", F.col("best.island").alias("island"))
    chosen = elites.join(winners, ["shard", "island"]).select("shard", "item", "bin")
    placed = numbered.join(chosen, ["shard", "item"], "left")

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        """Numbers for the full pieces after the shard's bins, and offsets in order of items."""
        group = group.sort_values("item", kind="stable")
        full = group["bin"].isna()
        first = int(group["bin"].max()) + 1 if not full.all() else 0
        bins = group["bin"].fillna(0).astype("int64")
        bins[full] = first + np.arange(int(full.sum()))
        ends = group["length"].groupby(bins).cumsum()
        return group.assign(
            sequence_id=group["shard"] * (1 << 32) + bins, offset=ends - group["length"]
        ).drop(columns=["shard", "item", "bin"])

    return placed.groupBy("shard").applyInPandas(
        settle, fields + ", sequence_id bigint, offset bigint"
    ).select(*pieces.columns, "sequence_id", "offset")


def pack_documents(
    docs: DataFrame, tokenizer: bytes, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """Where every piece of every whole text goes: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A null or empty text is one piece, its end id. Only longer documents than ``capacity`` are
    cut. Rows that share an id are documents of their own. Other columns are not read.
    """
    return pack_pieces(cut_pieces(docs, tokenizer, end_id, capacity), capacity)
