"""Row numbers over a whole table, and keyed permutations of them."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import store

#: Prime modulus of the round function; products of two residues fit into 64 bits.
PRIME = 2**31 - 1
ROUNDS = 8
#: Times that a number is mapped again until it falls into range. A miss has probability below
#: 1/sqrt(n), so for large n that many in a row do not occur; for n up to 1000 they cannot.
WALKS = 32


def number_rows(df: DataFrame, *order: str | Column, name: str = "number") -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the given order, which should tell all rows apart.

    The rows are range partitioned and sorted once and stored with their place in their part; the
    sizes of the parts, one row each, give the first number of each.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [f"_order{i}" for i in range(len(order))]
    keyed = df.withColumns(dict(zip(keys, order)))
    sort = [F.asc_nulls_first(k) for k in keys]
    ordered = keyed.repartitionByRange(*sort).sortWithinPartitions(*sort).drop(*keys)
    # the id holds the part in its upper 31 bits and the place in it in its lower 33
    placed = store(ordered.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_id", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    placed = placed.select("*", part)
    place = F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    numbered = placed.join(F.broadcast(bases), "_part").withColumn(name, F.col("_base") + place)
    return numbered.select(*df.columns, name)


def round_keys(seed: int, epoch: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Two numbers below 2^28 for each round, from the md5 of ``seed:epoch:round``."""
    digests = [hashlib.md5(f"{seed}:{epoch}:{r}".encode()).hexdigest() for r in range(rounds)]
    return [(int(d[:7], 16), int(d[7:14], 16)) for d in digests]


def grid(n: int) -> tuple[int, int]:
    """Sides of a grid that holds n numbers in at most one row more than they need."""
    wide = max(1, math.isqrt(n - 1) + 1) if n > 1 else 1
    return wide, max(1, -(-n // wide))


def permuted(number: Column, n: int, seed: int, epoch: int) -> Column:
    """A permutation of 0 .. n - 1 chosen by seed and epoch, worked out from each number alone.

    A Feistel network over a grid of about sqrt(n) by sqrt(n) cells: each round adds a function of
    one coordinate to the other. Cells beyond n are mapped again until they fall into range.
    """
    if not 0 < n < 2**60:
        raise ValueError("a permutation needs 1 to 2^60 numbers")
    wide, high = grid(n)
    keys = F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"), F.lit(r % 2 == 0).alias("even")) for r, (a, b) in enumerate(round_keys(seed, epoch))])

    def mixed(x: Column, key: Column) -> Column:
        base = (x + key["a"]) % PRIME
        square = (base * base + key["b"]) % PRIME
        return (square * base) % PRIME

    def turn(cell: Column, key: Column) -> Column:
        x, y = cell["x"], cell["y"]
        return F.when(key["even"], F.struct(((x + mixed(y, key)) % wide).alias("x"), y.alias("y"))).otherwise(
            F.struct(x.alias("x"), ((y + mixed(x, key)) % high).alias("y"))
        )

    def once(value: Column) -> Column:
        cell = F.struct((value % wide).alias("x"), F.floor(value / wide).cast("bigint").alias("y"))
        if n >= 2**52:  # a quotient of doubles is not exact there
            cell = F.struct((value % wide).alias("x"), F.call_function("div", value, F.lit(wide)).alias("y"))
        return F.aggregate(keys, cell, turn, lambda cell: cell["y"] * wide + cell["x"])

    walks = F.sequence(F.lit(1), F.lit(WALKS))
    found = F.aggregate(walks, once(number.cast("bigint")), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    missed = F.raise_error(F.lit("a number did not fall into range")).cast("bigint")
    return F.when(found < n, found).otherwise(missed)
