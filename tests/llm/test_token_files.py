import random
import zlib

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.llm.queries import tokenizer_file
from quillspark.llm.token_counts import MergeCounter, count_tokens
from quillspark.llm.token_files import ids_crc32, read_token_files, write_token_files
from quillspark.llm.tokenize import TextEncoder
from quillspark.session import fresh_path

ODD = [
    "",
    " \t\n",
    "it's <|endoftext|> don't 12a ÉÀ éx  a　b   x\x1cy Σς İx ﬁ",
    "\t\n a!b c--d <a> |x| (the) [b]",
    "naïve,word... don't''s 漢字kanji ßá ét Ǆ ŉ 👍🏽",
    "word " * 3000,
    "x" * 5000,
    " ▁ a",
    "<s> <0x0A> </s> <unk>",
    "  " * 40 + "x",
    "\x00é漢\U0001f600",
    " \n \n  x\ty",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_ids_of_whole_texts(library, spark):
    rng = random.Random(3)
    alphabet = "abcDEF éß'.,!<|>123 \n\t漢"
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(400)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    encoder = TextEncoder(tokenizer_file("word_bpe_49k.json"))
    for _ in range(3):  # words move through both memories
        flat, offsets = encoder.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [
            ids_of(library, t) for t in texts
        ]


def test_other_tokenizers_get_whole_texts():
    data = tokenizer_file("byte_bpe_50k.json")
    encoder, library = TextEncoder(data), Tokenizer.from_buffer(data)
    assert not encoder.by_word
    flat, offsets = encoder.encode_with_end(pa.array(["a b c", None, " x  y"]), 7)
    want = [[*ids_of(library, t), 7] for t in ("a b c", "", " x  y")]
    assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_token_files_round_trip(spark, documents, library):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(None, "null id"), (4, None), (4, "again"), (4, "again")]
    docs = documents(*rows).withColumn("part", F.lit("clash")).repartition(5)
    path = fresh_path(spark, "test-token-files")
    write_token_files(docs, path, tokenizer_file("word_bpe_49k.json"), end_id=1)
    read = read_token_files(spark, path)
    got = read.withColumn("crc", ids_crc32(F.col("ids"))).orderBy("start").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in want]
    place = 0
    for r, (_, text) in zip(got, want):
        ids = [*ids_of(library, text), 1]
        assert (r.start, r.n_tokens, list(r.ids)) == (place, len(ids), ids)
        assert r.crc == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        place += len(ids)


def test_token_files_are_coded_and_indexed(spark, documents):
    path = fresh_path(spark, "test-token-files")
    docs = documents(*[(i, "some words " * 20) for i in range(500)]).coalesce(1)
    write_token_files(docs, path, tokenizer_file("word_bpe_49k.json"), end_id=1)
    files = spark.read.parquet(path).inputFiles()
    meta = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata for f in files]
    columns = {g.column(i).path_in_schema: g.column(i) for m in meta for k in range(m.num_row_groups) for g in [m.row_group(k)] for i in range(g.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for n, c in columns.items() if n != "ids.list.element")


def test_token_files_of_no_documents(spark, documents):
    path = fresh_path(spark, "test-token-files")
    write_token_files(documents(), path, tokenizer_file("word_bpe_49k.json"), end_id=1)
    assert read_token_files(spark, path).count() == 0


def test_counts_equal_the_library(spark, documents):
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choices("aàbc  \n▁<s>0漢é", k=rng.randrange(60))) for _ in range(300)]
    rows = [*enumerate(texts), (None, "x"), (9000, None), (9000, None)]
    docs = documents(*rows).withColumn("n_tokens", F.lit("clash"))
    got = count_tokens(docs, tokenizer_file("piece_bpe_32k.model"), limit=40).collect()
    want = [
        (i, len((t or "").encode()), n := len(library.encode(t or "")), n > 40) for i, t in rows
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_merges_take_the_best_pair_first():
    counter = MergeCounter(tokenizer_file("piece_bpe_32k.model"))
    assert counter.count("") == 0
    assert counter.count_word("▁the") == 1
    assert counter.count_word("漢") in (1, 3)
    assert count_long(counter) > 0


def count_long(counter):
    return counter.count("a" * 200_000)
