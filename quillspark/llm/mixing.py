"""Mixing sources to target weights by entropy balancing.

Of all document rates that give every source its target of tokens, entropy balancing takes those
closest to 1 (least relative entropy). Its convex dual has one multiplier per source, and the
rates are exponentially tilted: exp(multiplier * size), capped at ``cap``. Newton steps run as
distributed sums over (source, size) cells, into which the documents are counted once.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.words import WORD
from quillspark.session import store

#: Documents of one source and one size beyond which a cell is dealt out in parts.
CELL_ROWS = 50_000
#: Times that what is left of a source's words is settled at most.
SETTLING = 8
#: Share of a source's words that may be left besides less than its shortest document.
LEFT = 1e-3
#: Sizes of which two are changed at once, where there are few and one more and one less won't do.
PAIRED = 256


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets_of(sizes: Sequence[int], weights: Sequence[float], cap: float) -> list[float]:
    """Shares of all tokens by weight, none above ``cap`` times its source's size; what a capped
    source leaves goes to the others by weight, until none is above."""
    targets, left = [0.0] * len(sizes), float(sum(sizes))
    free = list(range(len(sizes)))
    while free:
        whole = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / whole > cap * sizes[i]]
        if not over:
            for i in free:
                targets[i] = left * weights[i] / whole
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
            left -= targets[i]
        free = [i for i in free if i not in set(over)]
    return targets


@dataclass
class _Dual:
    """Bracketed Newton iteration for one source's multiplier (of size / mean size)."""

    target: float
    full: float  # tokens at the cap
    tolerance: float
    at: float = 0.0
    low: float = -1.0
    high: float = 1.0
    low_known: bool = False
    high_known: bool = False
    done: bool = False

    def step(self, tokens: float, slope: float) -> None:
        gap = tokens - self.target
        if abs(gap) <= self.tolerance:
            self.done = True
            return
        if gap > 0:
            self.high, self.high_known = self.at, True
        else:
            self.low, self.low_known = self.at, True
        newton = self.at - gap / slope if slope > 0 else None
        if self.low_known and self.high_known:
            inside = newton is not None and self.low < newton < self.high
            following = newton if inside else (self.low + self.high) / 2
        else:  # no bound yet on the other side: at most double the way
            reach = 2 * abs(self.at) + 1
            limit = self.at + reach if gap < 0 else self.at - reach
            inside = newton is not None and min(self.at, limit) <= newton <= max(self.at, limit)
            following = newton if inside else limit
        self.done = following == self.at
        self.at = following


def _rate(multiplier: Column, size: Column, mean: Column, cap: float) -> Column:
    power = F.least(multiplier * size / mean, F.lit(50.0))
    return F.least(F.exp(power), F.lit(float(cap)))


class Source(NamedTuple):
    number: int
    name: str | None
    source_size: int
    mean: float
    target: float


_FACTS = (
    "number int, _source string, source_size bigint, mean double, target double, multiplier double"
)


def tilted_rates(
    cells: DataFrame,
    sources: Sequence[Source],
    cap: float,
    tolerance: float = 1e-6,
    rounds: int = 100,
) -> dict[int, float]:
    """Multiplier by source number. ``cells``: (number, size, n).

    One aggregation a round for all sources together. Sums are decimal, so they don't depend on
    the order of rows and reruns agree. A source whose target is its cap has all rates there.
    """
    spark = cells.sparkSession
    duals = {
        s.number: _Dual(s.target, cap * s.source_size, tolerance * max(s.target, 1.0))
        for s in sources
    }
    for dual in duals.values():
        if dual.target >= dual.full * (1 - 1e-12):
            dual.at, dual.done = float("inf"), True
    means = {s.number: s.mean for s in sources}
    for _ in range(rounds):
        active = {k: d for k, d in duals.items() if not d.done}
        if not active:
            break
        at = [(k, means[k], d.at) for k, d in active.items()]
        now = spark.createDataFrame(at, "number int, mean double, multiplier double")
        rows = cells.join(F.broadcast(now), "number")
        rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
        tokens = F.col("n") * F.col("size") * rate
        slope = F.when(rate < cap, tokens * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = rows.groupBy("number").agg(
            F.sum(tokens.cast("decimal(28,6)")).cast("double").alias("tokens"),
            F.sum(slope.cast("decimal(28,6)")).cast("double").alias("slope"),
        )
        for row in sums.collect():  # one row per source
            duals[row["number"]].step(row["tokens"], row["slope"])
    return {k: d.at for k, d in duals.items()}


def plan_mix(
    sized: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    cycle: Sequence[float] = (1.0, 2.0, 3.0),
    cap: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """Sources (number, source, source_size, target, multiplier) and cells (number, size, n,
    rate, whole, extra) of a mix of ``sized``, rows with ``source`` and ``size``.

    Sources are ordered by code point, null last; their weights come from ``weights`` or, by
    place, from ``cycle``. Their list, a row per source, is all that comes to the driver.
    """
    spark = sized.sparkSession
    counted = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    cells = store(counted, "mix-cells")
    totals = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs")
    )
    listed = sorted(totals.collect(), key=lambda r: (r.source is None, (r.source or "").encode()))
    share = [
        float((weights or {}).get(r.source, cycle[i % len(cycle)])) for i, r in enumerate(listed)
    ]
    targets = targets_of([int(r.source_size) for r in listed], share, cap)
    sources = [
        Source(i, r.source, int(r.source_size), max(r.source_size / r.docs, 1e-9), t)
        for i, (r, t) in enumerate(zip(listed, targets))
    ]

    def facts(multipliers: Mapping[int, float]) -> DataFrame:
        rows = [(*s, multipliers.get(s.number)) for s in sources]
        return F.broadcast(spark.createDataFrame(rows, _FACTS))  # one row per source

    same = F.col("source").eqNullSafe(F.col("_source"))
    numbered = cells.join(facts({}), same).select("number", "size", "n")
    rated = numbered.join(facts(tilted_rates(numbered, sources, cap)), "number").withColumn(
        "rate",
        F.when(F.col("multiplier") == float("inf"), F.lit(float(cap))).otherwise(
            _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
        ),
    )
    rated = rated.select("number", "size", "n", "rate", F.floor("rate").alias("whole"))
    quotas = rated.groupBy("number").applyInPandas(
        _rounded, "number int, size bigint, n bigint, rate double, whole bigint, extra bigint"
    )
    return facts({}).withColumnRenamed("_source", "source"), quotas


def _rounded(cells: pd.DataFrame) -> pd.DataFrame:
    """Whole numbers of further copies (``extra``) for the cells of one source.

    From long documents to short ones: each cell takes as many copies as bring the words taken so
    far nearest to the words that the rates ask for, so that shorter documents make up for what
    longer ones leave. What is left at the end is made up for by one copy more of one size, one
    copy less of another, or both, a few times over. Where more than the shortest document and a
    thousandth of the words are still left, two sizes change against one. A source has a cell for
    each size.
    """
    cells = cells.sort_values("size", ascending=False, kind="stable")
    sizes, counts = cells["size"].to_numpy(), cells["n"].to_numpy()
    parts = (cells["rate"] - cells["whole"]).to_numpy()
    owed, extras = 0.0, np.zeros(len(cells), np.int64)
    for i, (size, n, part) in enumerate(zip(sizes.tolist(), counts.tolist(), parts.tolist())):
        owed += part * size * n
        if part > 1e-9:
            extras[i] = min(n, max(0, math.floor(owed / size + 0.5))) if size else round(part * n)
        owed -= float(extras[i]) * size
    most = np.where(parts > 1e-9, counts, 0)
    for _ in range(SETTLING):
        owed, before = _settle(sizes, most, extras, owed), owed
        if owed == before:
            break
    shortest = sizes[(parts > 1e-9) & (sizes > 0)].min(initial=np.iinfo(np.int64).max)
    allowed = max(shortest, LEFT * float((cells["rate"] * sizes * counts).sum()))
    if abs(owed) > allowed and len(sizes) <= PAIRED:
        _settle_pairs(sizes, most, extras, owed)
    return cells.assign(extra=extras)


def _settle(sizes: np.ndarray, most: np.ndarray, extras: np.ndarray, owed: float) -> float:
    """Change ``extras``, within 0 and ``most``, by one copy more and one less so that the words
    owed, which are returned, become as few as can be. Place -1 stands for no change."""
    more = np.append(np.flatnonzero((extras < most) & (sizes > 0)), -1)
    less = np.append(np.flatnonzero((extras > 0) & (sizes > 0)), -1)
    of = np.append(sizes, 0)  # the last one is what place -1 takes
    less = less[np.argsort(of[less], kind="stable")]
    wanted = of[more] - owed
    at = np.searchsorted(of[less], wanted)
    best = (abs(owed), -1, -1)
    for near in (at - 1, at):
        near = near.clip(0, len(less) - 1)
        left = np.abs(of[more] - of[less[near]] - owed)
        i = int(left.argmin())
        if left[i] < best[0] - 1e-9:
            best = (float(left[i]), int(more[i]), int(less[near[i]]))
    for place, step in ((best[1], 1), (best[2], -1)):
        if place >= 0:
            extras[place] += step
            owed -= step * float(sizes[place])
    return owed


def _settle_pairs(sizes: np.ndarray, most: np.ndarray, extras: np.ndarray, owed: float) -> None:
    """As _settle, by two copies (of one size or two) one way and at most one the other way."""
    best, change = abs(owed), []
    for step in (1, -1):
        room = np.where(sizes > 0, most - extras if step > 0 else extras, 0)
        back = np.where(sizes > 0, extras if step > 0 else most - extras, 0)
        left, right = np.triu_indices(len(sizes))
        fits = (room[left] > 0) & (room[right] > 0) & ((left != right) | (room[left] > 1))
        left, right = left[fits], right[fits]
        if not len(left):
            continue
        single = np.append(np.flatnonzero(back), -1)  # place -1 stands for no change
        of = np.append(sizes, 0)
        single = single[np.argsort(of[single], kind="stable")]
        pairs = sizes[left] + sizes[right]
        at = np.searchsorted(of[single], pairs - step * owed)
        for near in (at - 1, at):
            near = near.clip(0, len(single) - 1)
            miss = np.abs(pairs - of[single[near]] - step * owed)
            i = int(miss.argmin())
            if miss[i] < best - 1e-9:
                best, change = float(miss[i]), [(left[i], step), (right[i], step), (single[near[i]], -step)]
    for place, step in change:
        if place >= 0:
            extras[place] += step


def _part_quotas(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """Quotas (number, size, _part, n, rate, whole, quota) of all parts of all cells.

    The parts of a large cell get its quota by their sizes, each what the parts up to it should
    have together less what those before it got, so that they sum to the quota of the cell.
    """
    names = ["number", "size", "rate", "whole"]
    small = quotas.where(F.col("n") <= CELL_ROWS)
    small = small.select(*names, F.lit(0).cast("bigint").alias("_part"), F.col("extra").alias("quota"))
    large = quotas.where(F.col("n") > CELL_ROWS)
    if large.isEmpty():
        return small
    counts = rows.where(F.col("_parts").isNotNull()).groupBy("number", "size", "_part").agg(F.count(F.lit(1)).alias("here"))
    upto = F.sum("here").over(Window.partitionBy("number", "size").orderBy("_part"))
    counts = counts.withColumns({"upto": upto}).join(F.broadcast(large), ["number", "size"])

    def share(rows: Column) -> Column:
        return F.call_function("div", (F.col("extra") * rows).cast("decimal(38,0)"), F.col("n").cast("decimal(38,0)"))

    quota = share(F.col("upto")) - share(F.col("upto") - F.col("here"))
    return small.unionByName(counts.select(*names, "_part", quota.alias("quota")))


def take_copies(sized: DataFrame, sources: DataFrame, quotas: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target``, ``rate`` and ``copies`` to rows (doc_id, source, size, tie).

    A cell's documents with the smallest hashes of their ids get one copy more; equal ids go by
    ``tie``. A cell of more than CELL_ROWS documents is dealt out in parts, which changes which
    documents are taken but not how many; there are at most one in CELL_ROWS such cells, whose
    list is broadcast.
    """
    names = sources.select(F.col("source").alias("_source"), "number", "source_size", "target")
    rows = sized.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("_source")))
    large = quotas.where(F.col("n") > CELL_ROWS)
    parts = F.ceil(F.col("n") / CELL_ROWS).cast("int")
    rows = rows.join(F.broadcast(large.select("number", "size", parts.alias("_parts"))), ["number", "size"], "left")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.coalesce("_parts", F.lit(1)).cast("bigint"))
    rows = rows.withColumns({"_part": part, "_chance": F.xxhash64("doc_id", F.lit("copies"))})
    rows = rows.join(_part_quotas(rows, quotas), ["number", "size", "_part"])
    cell = Window.partitionBy("number", "size", "_part")
    place = F.row_number().over(cell.orderBy("_chance", "doc_id", "tie"))
    copies = F.col("whole") + F.when(place <= F.col("quota"), 1).otherwise(0)
    added = [F.col("source_size"), F.col("target"), F.col("rate"), copies.cast("bigint").alias("copies")]
    kept = [sized[c] if c != "size" else rows[c] for c in sized.columns if c != "tie"]
    return rows.select(*kept, *added)


def _tie(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"]).alias("tie")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """One row (doc_id, source, size, source_size, target, rate, copies) per row of ``docs``.

    Sizes are counted once and stored. Rates are rounded to whole copies from the longest
    documents of a source to the shortest, carrying the words that are owed, so that a source
    misses its target by less than a short document (see _rounded).

    Documents without words have size 0 and never change a source's tokens; null sources are one
    source, the last. Repeated rows are documents of their own. An empty table gives no rows.
    Other columns of ``docs`` are not read. See plan_mix for the options.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _tie(docs))
    sized = store(sized, "mix-sizes")
    sources, quotas = plan_mix(sized, **options)
    return take_copies(sized, sources, store(quotas, "mix-quotas"))


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is copied, columns unchanged."""
    columns = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _tie(docs), columns)
    sources, quotas = plan_mix(sized.select("source", "size"), **options)
    taken = take_copies(sized, sources, store(quotas, "mix-quotas")).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select("_row", copies.alias("_copy")).select("_row.*")
