"""Files to padded, labelled batches, as the README shows it."""

import json

from pyspark.sql import functions as F

from quillspark.functions.tokens import ADDED_TOKENS, SFT_MAX_TOKENS, response_labels
from quillspark.operators.batching import assign_batches, pad_batches
from quillspark.operators.encode import decode, encode
from quillspark.operators.mapping import format_sft
from quillspark.operators.vocabulary import add_tokens, build_vocabulary, resolve_pad, token_ids
from quillspark.session import store
from quillspark.sources.corpus import read_corpus, read_sft


def test_supervised_examples_end_to_end(spark, tmp_path):
    corpus = [{"text": f"study {i} found no effect in arm {i % 3}"} for i in range(50)]
    (tmp_path / "data.json").write_text(json.dumps(corpus, indent=1))
    examples = [
        {
            "system_prompt": "You judge studies.",
            "instruction": "Judge.",
            "reference": "study " * (i % 5 + 1),
            "modified_reasoning": f"reason {i}",
            "formatted_label": f"label {i}" if i % 4 else None,
        }
        for i in range(40)
    ]
    (tmp_path / "sft.json").write_text("\n".join(map(json.dumps, examples)))

    vocab = store(build_vocabulary(read_corpus(spark, str(tmp_path / "data.json")), 1000), "vocabulary")
    vocab = store(add_tokens(vocab, ADDED_TOKENS), "vocabulary")
    formatted, rejected = format_sft(read_sft(spark, str(tmp_path / "sft.json")))
    assert rejected.count() == 10
    rows = encode(formatted, vocab, SFT_MAX_TOKENS).drop("text")
    rows = store(rows.withColumn("id", F.monotonically_increasing_id()), "tokens")
    marker = token_ids(vocab, ["<|start_header_id|>", "assistant", "<|end_header_id|>", "\n\n"])
    assert len(set(marker)) == 4
    rows = rows.withColumn("labels", response_labels(F.col("input_ids"), marker))
    batches = assign_batches(rows, "id", batch_size=2, shards=4, accumulation=4)
    padded = pad_batches(batches, resolve_pad(vocab).scalar(), labels="labels")

    supervised = F.filter("labels", lambda x: x != -100)
    checked = padded.select("*", supervised.alias("kept"))
    texts = decode(checked.select("id", F.col("kept").alias("input_ids")), vocab).collect()
    assert len(texts) == 30
    for row in texts:
        assert row.text.startswith("<think>") and row.text.endswith("</answer><|eot_id|>")
    for row in padded.collect():
        assert len(row.input_ids) == len(row.attention_mask) == len(row.labels) == row.length
        real = sum(row.attention_mask)
        assert row.labels[real:] == [-100] * (row.length - real)
