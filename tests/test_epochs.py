from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillspark.functions.tokens import IGNORED_LABEL, assistant_labels, causal_labels, response_labels
from quillspark.operators.batching import (
    assign_batches,
    assign_length_batches,
    deal_batches,
    deal_epoch,
    deal_numbered,
    length_bounds,
    number_epochs,
    pad_batches,
    pad_length_batches,
)
from quillspark.session import store
from quillspark.operators.numbering import PRIME, grid, number_rows, permuted, round_keys


def feistel(value, n, seed, epoch):
    """The permutation in plain numbers."""
    wide, high = grid(n)
    while True:
        x, y = value % wide, value // wide
        for r, (a, b) in enumerate(round_keys(seed, epoch)):
            base = ((x if r % 2 else y) + a) % PRIME
            f = ((base * base + b) % PRIME) * base % PRIME
            x, y = (x, (y + f) % high) if r % 2 else ((x + f) % wide, y)
        value = y * wide + x
        if value < n:
            return value


def positions(spark, n, seed, epoch):
    rows = spark.range(n).select("id", permuted(F.col("id"), n, seed, epoch).alias("p")).collect()
    return [r.p for r in sorted(rows)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 101, 5000])
def test_permutations(spark, n):
    got = positions(spark, n, 7, 1)
    assert sorted(got) == list(range(n))
    assert got == [feistel(i, n, 7, 1) for i in range(n)]


def test_orders_differ_by_epoch_and_seed_and_look_random(spark):
    n = 5000
    one, two, other = positions(spark, n, 1, 0), positions(spark, n, 1, 1), positions(spark, n, 2, 0)
    assert one == positions(spark, n, 1, 0)
    for a, b in ((one, two), (one, other), (one, list(range(n)))):
        assert sum(x == y for x, y in zip(a, b)) < 20
    pairs = sum(abs(a - b) == 1 for a, b in zip(one, one[1:]))
    assert pairs < 20 and 0.45 < sum(a < b for a, b in zip(one, one[1:])) / n < 0.55
    halves = sum((i < n // 2) == (p < n // 2) for i, p in enumerate(one))
    assert 0.45 < halves / n < 0.55


def test_large_tables_need_no_order(spark):
    n = 10**15 + 7
    ids = [0, 1, n // 2, n - 2, n - 1]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = df.select("id", permuted(F.col("id"), n, 3, 9).alias("p")).orderBy("id").collect()
    assert [r.p for r in got] == [feistel(i, n, 3, 9) for i in ids]


def test_row_numbers(spark):
    rows = [(i * 37 % 1000, f"x{i}") for i in range(1000)] + [(None, "null")]
    df = spark.createDataFrame(rows, "k int, v string").repartition(7)
    got = number_rows(df, "k").orderBy("number").collect()
    assert [r.number for r in got] == list(range(1001)) and got[0].v == "null"
    assert [r.k for r in got[1:]] == list(range(1000))
    assert number_rows(df.limit(0), "k").count() == 0
    assert [r.k for r in number_rows(df, -F.col("k")).orderBy("number").collect()][1] == 999


@pytest.mark.parametrize("n", [0, 1, 127, 128, 1000])
def test_epochs_are_dealt_to_devices(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k").repartition(3)
    rows = deal_epoch(df, "k", epoch=1, seed=3).collect()
    assert sorted(r.k for r in rows) == list(range(n))
    assert sorted(r.position for r in rows) == list(range(n))
    steps = Counter(r.step for r in rows)
    assert all(steps[s] == 128 for s in range(n // 128)) and sum(steps.values()) == n
    batches = Counter((r.device, r.batch) for r in rows)
    assert all(c <= 2 for c in batches.values()) and {d for d, _ in batches} <= set(range(8))
    for r in rows:
        assert r.step == r.batch // 8
    if n >= 128:
        assert Counter(r.device for r in rows if r.step == 0) == {d: 16 for d in range(8)}


def test_partitioning_does_not_change_an_epoch(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    one = {(r.k, r.position) for r in deal_epoch(df.repartition(1), "k", 4, 5).collect()}
    assert one == {(r.k, r.position) for r in deal_epoch(df.repartition(9), "k", 4, 5).collect()}
    numbered = store(number_epochs(df, "k"), "numbered")
    assert one == {(r.k, r.position) for r in deal_numbered(numbered, 4, 5).collect()}
    assert "Exchange" not in deal_numbered(numbered, 5)._jdf.queryExecution().optimizedPlan().toString()


def test_composite_keys(spark):
    rows = [(i // 4, i % 4) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = deal_epoch(df, ["a", "b"], 0, batch_size=1, accumulation=1, devices=2)
    assert len({r.position for r in got.collect()}) == 100


# batches of similar lengths


@pytest.fixture(scope="module")
def lengths(spark):
    rows = [(i, list(range((i * 7919) % 997 + 1 if i % 3 else 500))) for i in range(1003)] + [(2000, [])]
    return spark.createDataFrame(rows, "id bigint, input_ids array<int>").cache()


def padding(padded, *batch):
    row = padded.agg(F.sum(F.size("input_ids")).alias("all"), F.sum(F.expr("aggregate(attention_mask, 0, (a, x) -> a + x)")).alias("real")).first()
    return 1 - row.real / row.all


def test_length_batches_keep_all_rows_and_pad_little(spark, lengths):
    batched = assign_length_batches(lengths, "id", 16).cache()
    rows = batched.collect()
    assert sorted(r.id for r in rows) == sorted(r.id for r in lengths.collect())
    sizes = Counter(r.batch for r in rows)
    assert sorted(sizes) == list(range(63)) and all(sizes[b] == 16 for b in range(62)) and sizes[62] == 1004 - 62 * 16
    padded = pad_length_batches(batched, 0)
    plain = pad_batches(assign_batches(lengths, "id", 16), 0)
    assert padding(padded) < 0.1 < 0.2 < padding(plain)
    by_batch = {}
    for r in padded.collect():
        assert len(r.input_ids) == r.length
        by_batch.setdefault(r.batch, set()).add(r.length)
    assert all(len(x) == 1 for x in by_batch.values())


def test_partial_batches_go_up(spark, lengths):
    rows = assign_length_batches(lengths, "id", 16, bounds=[100, 400]).collect()
    buckets = {}
    for r in rows:
        assert r.bucket == sum(b < len(r.input_ids) for b in (100, 400))
        buckets.setdefault(r.batch, set()).add(r.bucket)
    mixed = [b for b, found in buckets.items() if len(found) > 1]
    assert len(mixed) == 2 and max(buckets[b] == {0} for b in buckets)


def test_epochs_make_other_batches_of_the_same_lengths(spark, lengths):
    one, two = (
        {r.id: r.batch for r in assign_length_batches(lengths, "id", 16, epoch=e, bounds=[100, 400]).collect()}
        for e in (0, 1)
    )
    assert sum(one[k] == two[k] for k in one) < len(one) / 2
    again = assign_length_batches(lengths.repartition(5), "id", 16, epoch=1, bounds=[100, 400])
    again = {r.id: r.batch for r in again.collect()}
    assert two == again


def test_bounds_follow_quantiles(spark, lengths):
    bounds = length_bounds(lengths.select(F.size("input_ids").alias("length")), 4)
    exact = sorted(len(r.input_ids) for r in lengths.collect())
    for bound in bounds:
        place = sum(x <= bound for x in exact) / len(exact)
        assert min(abs(place - share) for share in (0.25, 0.5, 0.75)) < 0.35
    assert length_bounds(lengths.limit(0).select(F.lit(1).alias("length"))) == []
    assert assign_length_batches(lengths.limit(0), "id", 4).count() == 0


def test_batches_in_a_mixed_order(spark, lengths):
    batched = assign_length_batches(lengths, "id", 16)
    dealt = {r.id: r.batch for r in deal_batches(batched, 63, epoch=1, seed=2).collect()}
    before = {r.id: r.batch for r in batched.collect()}
    places = {(before[k], dealt[k]) for k in before}
    assert len(places) == 63 and sorted(p for _, p in places) == list(range(63))


# labels of all assistant turns

MARK, END = [9, 8], 7


@pytest.mark.parametrize(
    "ids,labels",
    [
        ([1, 9, 8, 2, 3, 7, 1, 9, 8, 4, 7, 5], [0, 0, 0, 2, 3, 7, 0, 0, 0, 4, 7, 0]),
        ([9, 8, 2], [0, 0, 2]),
        ([1, 9, 8], [0, 0, 0]),
        ([9, 8, 7], [0, 0, 7]),
        ([9], [0]),
        ([], []),
        ([7, 7, 1], [0, 0, 0]),
        ([9, 8, 1, 9, 8, 2, 7, 3], [0, 0, 1, 9, 8, 2, 7, 0]),
        (None, None),
    ],
)
def test_assistant_labels(spark, ids, labels):
    # the rows around it must not be mixed up with the row
    df = spark.createDataFrame([(0, [5, 9]), (1, ids), (2, [8, 6, 7])], "i int, ids array<int>").coalesce(1)
    rows = df.select("i", assistant_labels(F.col("ids"), MARK, END).alias("l")).orderBy("i").collect()
    want = None if labels is None else [x or IGNORED_LABEL for x in labels]
    assert [r.l for r in rows] == [[IGNORED_LABEL] * 2, want, [IGNORED_LABEL] * 3]


def test_assistant_labels_of_many_rows(spark):
    import random

    draw = random.Random(1)
    rows = [(i, [draw.choice([1, 2, 7, 8, 9]) for _ in range(draw.randint(0, 30))]) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, ids array<int>")
    got = df.select("i", assistant_labels(F.col("ids"), MARK, END).alias("l")).orderBy("i").collect()
    for (_, ids), r in zip(rows, got):
        on, want = False, []
        for at, x in enumerate(ids):
            on = on or ids[max(0, at - 2) : at] == MARK
            want.append(x if on else IGNORED_LABEL)
            on = on and x != END
        assert r.l == want, ids


def test_the_last_turn_alone_is_part_of_all_turns(spark):
    df = spark.createDataFrame([([1, 9, 8, 2, 7, 9, 8, 3, 7],)], "ids array<int>")
    row = df.select(response_labels(F.col("ids"), MARK).alias("a"), assistant_labels(F.col("ids"), MARK, END).alias("b"), causal_labels(F.col("ids")).alias("c")).first()
    assert all(x in (IGNORED_LABEL, y) for x, y in zip(row.a, row.b)) and len(row.c) == 9
    with pytest.raises(ValueError):
        assistant_labels(F.col("ids"), [], END)
