import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.llm import packing
from quillspark.llm.packing import (
    best_fit_all,
    crossover,
    cut_pieces,
    evolve,
    fitness,
    mutate,
    pack_documents,
    pack_pieces,
    replace,
)
from quillspark.llm.queries import tokenizer_file
from quillspark.llm.tokenize import TextEncoder
from quillspark.llm.words import slices


def valid(packing_, lengths, capacity):
    assert sorted(i for b in packing_ for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= capacity for b in packing_)


def test_operators_keep_every_item_once():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 100) for _ in range(300)]
    generator = np.random.default_rng(1)
    host = best_fit_all(range(300), lengths, 100)
    donor = best_fit_all(sorted(range(300), key=lambda i: -lengths[i]), lengths, 100)
    for _ in range(20):
        child = crossover(host, donor, lengths, 100, generator)
        valid(child, lengths, 100)
        child = mutate(child, lengths, 100, generator)
        valid(child, lengths, 100)
        host = child
    assert fitness(donor, lengths, 100)[0] <= 0


def test_evolution_beats_best_fit_where_it_can():
    """Triples that fill their bins exactly: best fit alone needs more bins."""
    rng = random.Random(8)
    lengths = []
    for _ in range(60):
        a, b = rng.randrange(260, 490), rng.randrange(260, 490)
        lengths += [a, b, 1000 - a - b] if 250 < 1000 - a - b < 500 else [500, 250, 250]
    rng.shuffle(lengths)
    best = best_fit_all(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 1000)
    found = evolve(lengths, [], 1000, 3)
    valid(found, lengths, 1000)
    assert len(best) == 64 and len(found) <= 62  # 60 bins hold all
    assert evolve(lengths, [], 1000, 3) == found


def test_evolution_beats_best_fit_on_documents():
    """A shard of documents that best fit needs a sequence too many for."""
    encoder = TextEncoder(tokenizer_file("word_bpe_49k.json"))
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].combine_chunks()
    pieces = []
    for a, b in slices(texts):
        for n in np.diff(encoder.encode_with_end(texts.slice(a, b - a), 0)[1]).tolist():
            pieces += [n % 2048] if n % 2048 else []
    random.Random(1).shuffle(pieces)
    lengths = pieces[0::3]
    least = -(-sum(lengths) // 2048)
    best = best_fit_all(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 2048)
    found = min((evolve(lengths, [], 2048, s) for s in range(4)), key=len)
    valid(found, lengths, 2048)
    assert len(best) == least + 1 and len(found) == least


def test_replacement_fills_bins_better():
    lengths = [500, 300, 400, 450, 120]
    bins = [[0, 1], [2]]  # rooms 200 and 600
    left = replace(bins, [3, 4], lengths, 1000)
    assert sorted(i for b in bins for i in b) + sorted(left) and sorted([*bins[0], *bins[1], *left]) == [0, 1, 2, 3, 4]
    assert sum(lengths[i] for i in bins[0]) == 950 and all(sum(lengths[i] for i in b) <= 1000 for b in bins)


def test_documents_are_packed_whole(documents, spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "beta,", "ß", "12"], k=rng.randrange(60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 1000), (None, "x y"), (5, "again"), (5, "again")]
    docs = documents(*rows).withColumn("piece", F.lit("clash"))
    got = pack_documents(docs, tokenizer_file("word_bpe_49k.json"), 0, capacity=64).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 64):
            part = np.array(ids[k : k + 64], "<u4")
            want.append((i, k // 64, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    least = -(-sum(r.length for r in got) // 64)
    assert len(sequences) <= least + 2


def test_shards_follow_the_number_of_pieces_and_never_lose_to_best_fit(spark):
    rows = [(i, 0, 0, 1 + i * 37 % 2048, i) for i in range(3000)]
    pieces = spark.createDataFrame(rows, packing.PIECE)
    shards = {}
    for r in pack_pieces(pieces, shard_pieces=500).collect():
        shards.setdefault(r.sequence_id >> 32, {}).setdefault(r.sequence_id, []).append(r.length)
    assert len(shards) == 6
    for sequences in shards.values():
        lengths = sorted((n for s in sequences.values() for n in s), reverse=True)
        assert max(map(sum, sequences.values())) <= 2048
        assert len(sequences) <= len(best_fit_all(range(len(lengths)), lengths, 2048))


def test_no_documents(documents):
    assert pack_documents(documents(), tokenizer_file("word_bpe_49k.json"), 0).count() == 0


@pytest.mark.parametrize("with_ids", [True])
def test_pieces_bring_their_ids(documents, with_ids):
    docs = documents((1, "a b c d e f g"))
    got = cut_pieces(docs, tokenizer_file("word_bpe_49k.json"), 0, 3, with_ids).orderBy("piece").collect()
    assert [len(r.ids) for r in got] == [3, 3, 2] and got[-1].ids[-1] == 0
