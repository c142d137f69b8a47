import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.llm import near_dedup
from quillspark.llm.components import connected_components
from quillspark.llm.near_dedup import (
    REGISTERS,
    band_rows,
    collision_rate,
    compress,
    estimate,
    keep_representatives,
    near_duplicates,
    registers,
)


def shingles(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and common * 100 >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def family(rng, size, words, change):
    """Copies of a text of random words, each with some words replaced."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    return [
        " ".join(f"x{rng.randrange(10**6)}" if rng.random() < change else w for w in base)
        for _ in range(size)
    ]


@pytest.mark.parametrize("width", [2, 5])
def test_classes_equal_brute_force(documents, width):
    rng = random.Random(width)
    texts = family(rng, 40, 120, 0.03) + family(rng, 20, 60, 0.05) + family(rng, 10, 8, 0.1)
    texts += ["", None, " \n", "one", "ONE", "one two", "One\ttwo", "a b c", "word " * 3000, "WORD " * 9]
    rows = list(enumerate(texts))
    docs = documents(*rows).withColumn("band", F.lit("clash")).repartition(3)
    got = near_duplicates(docs, width).collect()
    assert sorted(map(tuple, got)) == brute(rows, width)


@pytest.mark.parametrize("rounds", [0, 1])
def test_scattered_families_keep_every_link(documents, monkeypatch, rounds):
    """Members that miss both the first and the chance partners are found in full comparison."""
    monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 7)
    rng = random.Random(9)
    rows = list(enumerate(family(rng, 60, 100, 0.06)))
    assert sorted(map(tuple, near_duplicates(documents(*rows), 2).collect())) == brute(rows, 2)


def test_nulls_repeats_and_no_documents(documents):
    docs = documents((None, "a b c"), (1, "a b c"), (1, "a b c"), (None, None), (2, None))
    got = near_duplicates(docs, 2).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(None, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (None, 0, None, True), (2, 0, 2, True)],
        key=repr,
    )
    assert near_duplicates(documents(), 2).count() == 0


def test_representatives(documents):
    text = " ".join(f"w{i}" for i in range(100))
    docs = documents((5, text), (3, text + " end"), (9, "else"), (None, text), (7, None))
    kept = keep_representatives(docs)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [3, 7, 9, None]


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.95):
        for size in (50, 5000):
            common = rng.integers(0, 2**63, int(size * share), dtype=np.uint64)
            rest = [rng.integers(0, 2**63, size - len(common), dtype=np.uint64) for _ in "ab"]
            sets = [np.unique(np.concatenate([common, r])) for r in rest]
            table = registers(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]))
            same = np.array([(table[0] == table[1]).sum()])
            true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
            got = estimate(same, np.array([size]), np.array([size]))[0]
            errors.append(abs(got - true))
    assert max(errors) < 0.16 and np.mean(errors) < 0.05


def test_registers_by_brute_force():
    """One hash an item, one bucket a hash; small sets borrow."""
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 3, 90, 2000, 1)]
    table = registers(np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets]))
    for items, got in zip(sets, table):
        kept = {}
        for h in near_dedup.mix(items ^ near_dedup._SEED).tolist():
            kept[h % REGISTERS] = min(h, kept.get(h % REGISTERS, h))
        for bucket in range(REGISTERS):
            owner = next(o for o in [bucket, *near_dedup._ORDER[bucket].tolist()] if o in kept)
            assert got[bucket] == compress(np.array([kept[owner]], np.uint64))[0]
    assert registers(np.empty(0, np.uint64), np.zeros(1, np.int64)).shape == (0, REGISTERS)


@pytest.mark.parametrize("percent, size", [(100, 16), (95, 8), (80, 4), (50, 2), (30, 1), (10, 1)])
def test_bands_follow_the_threshold(percent, size):
    assert band_rows(percent) == size


@pytest.mark.parametrize("percent", [30, 50, 80])
@pytest.mark.parametrize("size", [5, 40, 600])
def test_pairs_at_the_threshold_share_a_band_and_are_plausible(spark, percent, size):
    """300 pairs at or just above the threshold: none is lost."""
    rng = np.random.default_rng(size + percent)
    shared = -(-size * percent // 100)
    pairs = [rng.integers(0, 2**63, size, dtype=np.uint64) for _ in range(300)]
    sets = [x for items in pairs for x in (items, items[:shared])]
    table = registers(np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets]))
    rows = band_rows(percent)
    same = (table[0::2] == table[1::2]).reshape(300, REGISTERS // rows, rows).all(2).any(1)
    assert same.all()
    data = {"id": range(600), "n": [len(x) for x in sets], "registers": [x.tobytes() for x in table]}
    signed = spark.createDataFrame(pa.table(data))
    links = spark.range(300).selectExpr("2 * id as a", "2 * id + 1 as b")
    assert near_dedup.plausible(links, signed, percent).count() == 300


@pytest.mark.parametrize("percent", [30, 50, 95])
def test_other_thresholds_equal_brute_force(documents, percent):
    rng = random.Random(percent)
    texts = family(rng, 20, 80, (100 - percent) / 400) + family(rng, 10, 12, 0.05)
    rows = list(enumerate(texts))
    got = near_duplicates(documents(*rows), 2, percent).collect()
    assert sorted(map(tuple, got)) == brute(rows, 2, percent)


def test_register_layout():
    values = np.array([2**64 - 1, 2**63, 2**62 + 2**61, 1, 0, 2**53 + 1, 2**54 - 1], np.uint64)
    zeros, rest = compress(values) >> 10, compress(values) & 1023
    assert zeros.tolist() == [0, 0, 1, 63, 63, 10, 10]
    assert rest.tolist()[:3] == [1023, 0, 512]
    assert 0 < collision_rate(8, 8) < 2**-9


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 200), (200, 300)]
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)} | {200: 200, 300: 200}
    assert {r.id: r.component for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
