"""Top-level JSON lists of any size, read in ranges of their files.

The text source splits a file at any separator. With the closing brace as separator a list falls
into pieces, in as many ranges as its size asks for, however its lines are laid out. What a range
means depends on whether it starts inside a string and how deep. A first pass therefore sums every
range up under both start states; a running sum over the ranges of a file tells the true one, and a
second pass cuts the records: a piece that ends at depth 1, outside strings, ends a record.
Records torn by a border are put together again from their parts, at most two per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.text import strip
from quillspark.session import ship_package, store

CLOSING = "}"
#: Ranges of one read at most; a row for each is sent to the tasks. At the usual split size of
#: 128 MB that many ranges hold 250 TB.
MOST_RANGES = 2_000_000

SUMMARY = "file string, start bigint, size bigint, chars bigint, flips int, down0 bigint, down1 bigint, low0 bigint, low1 bigint"
CUT = "file string, owner bigint, place bigint, first boolean, last boolean, value string"
_QUOTE, _ESCAPE = ord('"'), ord("\\")
_WEIGHT = np.zeros(256, np.int64)
_WEIGHT[[ord("["), ord("{")]] = 1
_WEIGHT[ord("]")] = -1
_NEVER = 1 << 60  # depth of a range without any piece that ends outside strings


def pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, size, value): the texts between closing braces and where their range starts."""
    rows = spark.read.option("lineSep", CLOSING).text(path)
    place = ("file_path", "file_block_start", "file_size")
    names = ("file", "start", "size")
    return rows.select(*[F.col(f"_metadata.{c}").alias(n) for c, n in zip(place, names)], "value")


def _measures(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every piece with its brace: whether it flips the string state, and what it adds to the
    depth if it starts outside and inside a string."""
    held = values.buffers()[2]
    offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset).astype(np.int64)
    data = np.empty(0, np.uint8) if held is None else np.frombuffer(held, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    quotes = _unescaped(data, np.flatnonzero(data == _QUOTE), offsets)
    before = np.searchsorted(quotes, offsets)
    flips = np.diff(before) & 1
    brackets = np.flatnonzero(_WEIGHT[data])
    piece = np.searchsorted(offsets, brackets, side="right") - 1
    inside = (np.searchsorted(quotes, brackets) - before[piece]) & 1
    weights = _WEIGHT[data[brackets]]
    outer = np.zeros(len(values), np.int64)
    inner = np.zeros(len(values), np.int64)
    np.add.at(outer, piece[inside == 0], weights[inside == 0])
    np.add.at(inner, piece[inside == 1], weights[inside == 1])
    return flips, outer - (flips == 0), inner - (flips == 1)


def _unescaped(data: np.ndarray, quotes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions of quotes that do not follow an odd run of backslashes.

    No run reaches over the start of a piece, for a brace stands before it.
    """
    escapes = np.flatnonzero(data == _ESCAPE)
    if not len(escapes):
        return quotes
    new = np.ones(len(escapes), bool)
    new[1:] = (np.diff(escapes) != 1) | np.isin(escapes[1:], offsets)
    first = np.maximum.accumulate(np.where(new, np.arange(len(escapes)), 0))
    at = np.searchsorted(escapes, quotes - 1)
    follows = (at < len(escapes)) & ~np.isin(quotes, offsets)
    follows[follows] = escapes[at[follows]] == quotes[follows] - 1
    odd = np.zeros(len(quotes), bool)
    odd[follows] = (at[follows] - first[at[follows]]) % 2 == 0
    return quotes[~odd]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Rows (from, to) of one range each."""
    starts, files = batch.column("start"), batch.column("file")
    changes = [0]
    if len(batch) > 1:
        other = pc.or_(
            pc.not_equal(starts.slice(1), starts.slice(0, len(batch) - 1)),
            pc.not_equal(files.slice(1), files.slice(0, len(batch) - 1)),
        )
        changes += (np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist()
    return zip(changes, [*changes[1:], len(batch)])


def _follow(inside: int, depth: int, flips, outer, inner) -> tuple[np.ndarray, np.ndarray]:
    """State and depth after each piece, from those before the first."""
    after = (inside + np.cumsum(flips)) & 1
    before = after ^ flips
    return after, depth + np.cumsum(np.where(before == 0, outer, inner))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: see SUMMARY."""
    names = ["file", "start", "size", "chars", "flips", "down0", "down1", "low0", "low1"]
    types = [pa.string(), *[pa.int64()] * 3, pa.int32(), *[pa.int64()] * 4]
    now: dict | None = None

    def row(of: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([of[n]], t) for n, t in zip(names, types)], names)

    for batch in batches:
        if not len(batch):
            continue
        flips, outer, inner = _measures(batch.column("value"))
        sizes = pc.binary_length(batch.column("value")).to_numpy()
        for a, b in _runs(batch):
            key = [batch.column(n)[a].as_py() for n in names[:3]]
            if now is None or [now[n] for n in names[:3]] != key:
                if now is not None:
                    yield row(now)
                now = dict(zip(names, [*key, 0, 0, 0, 0, _NEVER, _NEVER]))
            down = []
            for state in (0, 1):
                inside = state ^ now["flips"]
                after, depth = _follow(inside, now[f"down{state}"], flips[a:b], outer[a:b], inner[a:b])
                low = depth[after == 0].min(initial=_NEVER)
                now[f"low{state}"] = min(now[f"low{state}"], int(low))
                down.append(int(depth[-1]))
            now["down0"], now["down1"] = down
            now["flips"] ^= int(flips[a:b].sum()) & 1
            now["chars"] += int(sizes[a:b].sum()) + b - a
    if now is not None:
        yield row(now)


def _states(summaries: DataFrame) -> DataFrame:
    """The true state at the start of every range, and the range where its first record started.

    ``owner`` is null if no record reaches into the range. One row per range; those of a file meet
    in one task.
    """
    order = Window.partitionBy("file").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = summaries.withColumn("inside", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    within = F.col("inside") == 1
    rows = rows.withColumn("down", F.when(within, F.col("down1")).otherwise(F.col("down0")))
    rows = rows.withColumn("low", F.when(within, F.col("low1")).otherwise(F.col("low0")))
    rows = rows.withColumn("depth", F.coalesce(F.sum("down").over(earlier), F.lit(0)))
    rows = rows.withColumn("first", F.row_number().over(order) == 1)
    rows = rows.withColumn("last", F.lead("start").over(order).isNull())
    clean = F.col("first") | ((F.col("inside") == 0) & (F.col("depth") == 1))
    ends_inside = (F.col("inside") + F.col("flips")) % 2 == 1
    ends_deep = ends_inside | (F.col("depth") + F.col("down") != 1)
    starts_one = clean | (F.col("depth") + F.col("low") <= 1)
    open_here = F.when(starts_one & ends_deep, F.col("start"))
    owner = F.when(~clean, F.last(open_here, ignorenulls=True).over(earlier))
    # a list that is not closed, or that a brace follows to the end of the file; a byte order mark
    # is not among the characters
    rest = F.col("size") - F.sum("chars").over(Window.partitionBy("file"))
    ends_in_brace = rest.isin(0, 3)
    # each piece counts a brace, also the last one, which has none
    broken = F.col("last") & (ends_inside | ends_in_brace | (F.col("depth") + F.col("down") != -1))
    state = ["file", "start", "inside", "depth", "first", "last"]
    return rows.select(*state, owner.alias("owner"), broken.alias("broken"))


class _Cutter:
    """Cuts the pieces of one range after another."""

    def __init__(self, state: dict):
        self.state = state
        self.inside, self.depth = state["inside"], state["depth"]
        self.head = state["owner"] is not None or not (state["first"] or self._clean())
        self.first = state["first"]
        self.held: list[pa.Array] = []  # pieces of the record that is open

    def _clean(self) -> bool:
        return self.inside == 0 and self.depth == 1

    def add(self, values: pa.Array, flips, outer, inner) -> Iterator[pa.RecordBatch]:
        after, depth = _follow(self.inside, self.depth, flips, outer, inner)
        self.inside, self.depth = int(after[-1]), int(depth[-1])
        ends = np.flatnonzero((after == 0) & (depth == 1)) + 1
        closed = pc.binary_join_element_wise(values, "", CLOSING)
        if len(ends):
            begin = 0
            if self.held:
                text = b"".join(_bytes(p) for p in [*self.held, closed.slice(0, ends[0])])
                yield self._rows(pa.array([text], pa.binary()))
                self.held, begin = [], 1
            rows = _merged(closed, ends)
            yield from (self._rows(r) for r in self._heads(rows.slice(begin)))
            closed = closed.slice(ends[-1])
        if len(closed):
            self.held.append(closed)

    def _heads(self, rows: pa.Array) -> list[pa.Array]:
        """The first of a range's records by itself, since it may differ from the others."""
        if not len(rows):
            return []
        return [rows.slice(0, 1), rows.slice(1)] if self.head or self.first else [rows]

    def _rows(self, values: pa.Array, last: bool = False, part: bool = False) -> pa.RecordBatch:
        owner = self.state["owner"] if self.head else self.state["start"] if part else None
        n = len(values)
        columns = [
            pa.array([self.state["file"]] * n, pa.string()),
            pa.array([owner] * n, pa.int64()),
            pa.array([self.state["start"]] * n, pa.int64()),
            pa.array([self.first] * n, pa.bool_()),
            pa.array([last] * n, pa.bool_()),
            values.cast(pa.string()),
        ]
        if n:
            self.head = self.first = False
        return pa.RecordBatch.from_arrays(columns, ["file", "owner", "place", "first", "last", "value"])

    def end(self) -> Iterator[pa.RecordBatch]:
        """What is open at the end of the range; at the end of the file no brace follows it."""
        if not self.held:
            return
        text = b"".join(map(_bytes, self.held))
        last = self.state["last"]
        text = text[:-1] if last else text
        yield self._rows(pa.array([text], pa.binary()), last, part=not last)


def _bytes(values: pa.Array) -> bytes:
    merged = _merged(values, np.array([len(values)]))
    return merged.cast(pa.binary())[0].as_py()


def _merged(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """Strings that follow each other as one, up to each of ``ends``."""
    offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset)
    bounds = offsets[np.concatenate([[0], ends])]
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.ascontiguousarray(bounds)), values.buffers()[2])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and parts of records: see CUT."""
    names = ["file", "start", "inside", "depth", "owner", "first", "last"]
    cutter = None
    for batch in batches:
        if not len(batch):
            continue
        flips, outer, inner = _measures(batch.column("value"))
        for a, b in _runs(batch):
            state = {n: batch.column(n)[a].as_py() for n in names}
            if cutter is None or (cutter.state["file"], cutter.state["start"]) != (state["file"], state["start"]):
                if cutter is not None:
                    yield from cutter.end()
                cutter = _Cutter(state)
            yield from cutter.add(batch.column("value").slice(a, b - a), flips[a:b], outer[a:b], inner[a:b])
    if cutter is not None:
        yield from cutter.end()


def read_lists(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Records of files that each hold one top-level list of objects, in as many tasks as the size
    of the files asks for.

    A record must fit into one value, a file need not. Anything that is not a list of objects
    stops the job, at once or when the rows are read.
    """
    ship_package(spark)
    rows = pieces(spark, path)
    states = store(_states(rows.mapInArrow(_summaries, SUMMARY)), "list-ranges")
    facts = states.agg(
        F.count(F.lit(1)).alias("ranges"),
        F.count("owner").alias("torn"),
        F.min(F.when(F.col("broken"), F.col("file"))).alias("broken"),
    ).first()
    if facts.broken is not None:
        raise ValueError(f"not a JSON record: the list of {facts.broken} does not end where the file ends")
    if facts.ranges > MOST_RANGES:
        raise ValueError(f"{facts.ranges} ranges: raise spark.sql.files.maxPartitionBytes")
    # the left join keeps a range without a state, which would mean that the splits have changed
    ranged = rows.drop("size").join(F.broadcast(states.drop("broken")), ["file", "start"], "left")
    changed = F.raise_error(F.lit("the splits of the files changed between two reads")).cast("bigint")
    ranged = ranged.withColumn("depth", F.coalesce("depth", changed))
    cut = ranged.mapInArrow(_cut, CUT)
    texts = cut.where("owner IS NULL").select("first", "last", "value")
    if facts.torn:
        texts = texts.unionByName(_mended(store(cut.where("owner IS NOT NULL"), "list-parts")))
    return texts.select(F.inline(_record(schema)))


def _mended(parts: DataFrame) -> DataFrame:
    """Records from their parts."""
    places = F.array_sort(F.collect_list(F.struct("place", "value")))
    flags = [F.bool_or(c).alias(c) for c in ("first", "last")]
    records = parts.groupBy("file", "owner").agg(places.alias("parts"), *flags)
    return records.select("first", "last", F.array_join("parts.value", "").alias("value"))


def _record(schema: T.StructType) -> Column:
    """The record of a text, in an array: what stands before its first brace must be the opening
    bracket or a comma. After the last record only the closing bracket may follow."""
    array = f"array<{schema.simpleString()}>"
    at = F.instr("value", "{")
    lead = strip(F.substring(F.col("value"), F.lit(1), at - 1))
    opening = F.when(F.col("first"), F.lit("[")).otherwise(F.lit(","))
    body = F.substring(F.col("value"), at, F.length("value"))
    strict = {"mode": "FAILFAST", "maxStringLen": str(2**31 - 1)}
    record = F.from_json(F.concat(F.lit("["), body, F.lit("]")), F.lit(array), strict)
    rest = strip(F.col("value"))
    empty = F.regexp_replace(rest, r"^\[\s*", "")
    ended = F.when(F.col("first"), F.startswith(rest, F.lit("[")) & (empty == "]")).otherwise(rest == "]")
    shown = F.concat(F.lit("not a JSON record: "), F.substring("value", 1, 1000))
    error = F.raise_error(shown).cast(array)
    return (
        F.when(F.col("last"), F.when(ended, F.array().cast(array)).otherwise(error))
        .when((at > 0) & (lead == opening), record)
        .otherwise(error)
    )
