"""The registered queries: each reads a table folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import rewards as R
from quillspark.functions import tokens as K
from quillspark.functions.chat import DRAFT, LLAMA3, ChatTemplate, reasoning_target, render
from quillspark.operators import batching, mapping, predict, rollouts
from quillspark.operators.encode import (
    decode,
    decode_by_join,
    encode,
    encode_by_join,
    numbers_text,
)
from quillspark.operators.vocabulary import (
    add_byte_tokens,
    add_tokens,
    build_vocabulary,
    resolve_pad,
    token_ids,
)
from quillspark.plans import inputs
from quillspark.session import fresh_path, ship_package, store
from quillspark.sources.corpus import read_corpus, read_qa, read_sft
from quillspark.sources.prompts import (
    PLACE,
    read_ordered_lines,
    read_prompt_lines,
    write_ordered_lines,
    write_prediction_lines,
    write_tokens,
)
from quillspark.streaming.advantage import stream_advantage
from quillspark.streaming.prompts import predict_folder

VOCABULARY_SIZE = 128_000
DOCUMENT_TOKENS = K.CPT_MAX_TOKENS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def joined(values: Column | str) -> Column:
    """Array of numbers as text, for comparison by value."""
    values = F.col(values) if isinstance(values, str) else values
    return F.array_join(values.cast("array<string>"), " ")


def rounded(value: Column | str) -> Column:
    return F.round(value, 6)


# conversations and prompts


@query
def chat_render(spark, folder, template: ChatTemplate = LLAMA3):
    return inputs.conversation_texts(inputs.table(spark, folder, "conversations"), template)


@query
def chat_render_draft(spark, folder):
    return inputs.conversation_texts(inputs.table(spark, folder, "conversations"), DRAFT)


@query
def chat_render_generation(spark, folder):
    prompts = mapping.format_qa(inputs.qa_rows(spark, folder))
    text = render(F.col("prompt"), LLAMA3, add_generation_prompt=True)
    return mapping.replace_columns(prompts, {"text": text}, keep=["item_id"])


@query
def sft_text(spark, folder):
    formatted, _ = mapping.format_sft(inputs.sft_examples(spark, folder), keep=["doc_id"])
    return formatted


@query
def sft_text_compat(spark, folder):
    examples = inputs.sft_examples(spark, folder)
    formatted, _ = mapping.format_sft(examples, DRAFT, compat=True, keep=["doc_id"])
    return formatted


@query
def sft_rejected(spark, folder):
    _, rejected = mapping.format_sft(inputs.sft_examples(spark, folder))
    return rejected.select("doc_id", "system_prompt", "modified_reasoning", "formatted_label")


@query
def target_block(spark, folder):
    examples = inputs.sft_examples(spark, folder)
    target = reasoning_target(F.col("reference"), F.col("modified_reasoning"), layout="block")
    return mapping.replace_columns(examples, {"target": target}, keep=["doc_id"])


@query
def rl_prompt(spark, folder):
    prompts = mapping.format_qa(inputs.qa_rows(spark, folder))
    return prompts.select(
        "item_id",
        "question",
        "answer",
        F.get("prompt", F.lit(0))["role"].alias("first_role"),
        F.get("prompt", F.lit(0))["content"].alias("first_content"),
        F.get("prompt", F.lit(1))["role"].alias("second_role"),
        F.get("prompt", F.lit(1))["content"].alias("second_content"),
    )


# answers and rewards


def _scored(spark, folder, **columns: Column) -> DataFrame:
    return inputs.rollouts(spark, folder).select(
        "prompt_id", "gen_id", *[c.alias(n) for n, c in columns.items()]
    )



@query
def extract_answer(spark, folder):
    text = R.completion_text(F.col("completion"))
    return _scored(spark, folder, extracted=R.extract_xml_answer(text))


@query
def hash_answer(spark, folder):
    documents = inputs.table(spark, folder, "documents")
    ending = F.concat(F.lit(" #### "), "source", F.lit("\n"))
    marked = F.when(F.col("lang") != "fr", F.concat("text", ending))
    text = F.coalesce(marked, F.col("text"))
    return documents.select("doc_id", R.extract_hash_answer(text).alias("answer"))


@query
def reward_numeric(spark, folder):
    return _scored(spark, folder, numeric=R.numeric_reward(F.col("completion")))


@query
def reward_digits(spark, folder):
    return _scored(spark, folder, digits=R.digits_reward(F.col("completion")))


@query
def reward_xmlcount(spark, folder):
    return _scored(spark, folder, xmlcount=rounded(R.xmlcount_reward(F.col("completion"))))


@query
def reward_soft(spark, folder):
    return _scored(spark, folder, soft_format=R.soft_format_reward(F.col("completion")))


@query
def reward_strict(spark, folder):
    return _scored(spark, folder, strict_format=R.strict_format_reward(F.col("completion")))


@query
def reward_correct(spark, folder):
    reward = R.correctness_reward(F.col("completion"), F.col("answer"))
    return _scored(spark, folder, correctness=reward)


@query
def reward_total(spark, folder):
    scored = rollouts.score(inputs.rollouts(spark, folder))
    values = [rounded(n).alias(n) for n in [*R.REWARDS, "reward"]]
    return scored.select("prompt_id", "gen_id", *values)


@query
def reward_custom(spark, folder):
    """Two plug-in scorers beside a built-in one: a column expression and a Python function."""

    def brevity(completions: list, answer: list, **columns) -> list[float]:
        texts = [c[0]["content"] for c in completions]
        return [1.0 / (1 + len(t) + len(a)) for t, a in zip(texts, answer)]

    def mentions_answer(completions: Column, answer: Column) -> Column:
        found = F.contains(R.completion_text(completions), answer)
        return F.when(found, 1.0).otherwise(0.0)

    chosen = {
        "brevity": rollouts.python_reward(brevity),
        "mentions": mentions_answer,
        "numeric": R.numeric_reward,
    }
    scored = rollouts.score(inputs.rollouts(spark, folder), chosen, weights={"brevity": 10.0})
    values = [rounded(n).alias(n) for n in [*chosen, "reward"]]
    return scored.select("prompt_id", "gen_id", *values)


@query
def rollout_fanout(spark, folder):
    prompts = mapping.format_qa(inputs.qa_rows(spark, folder))
    return rollouts.fan_out(prompts).select("item_id", "gen_id", "answer")


@query
def group_advantage(spark, folder):
    scored = rollouts.score(inputs.rollouts(spark, folder))
    scored = scored.select("prompt_id", "gen_id", "reward")
    advantage = rollouts.group_advantage(scored)
    values = [rounded(n).alias(n) for n in ("reward", "advantage")]
    return advantage.select("prompt_id", "gen_id", *values)


@query
def inspect_rollouts(spark, folder):
    return rollouts.inspect_batches(inputs.rollouts(spark, folder))


# vocabulary and tokens


_VOCABULARIES: dict[tuple[str, str, int | None], DataFrame] = {}


def _vocabulary(
    spark: SparkSession, folder: str, size: int | None = VOCABULARY_SIZE
) -> DataFrame:
    """Corpus vocabulary with the added tokens (all tokens for size None), stored once for each
    application and folder."""
    key = (spark.sparkContext.applicationId, folder, size)
    if key not in _VOCABULARIES:
        base = store(build_vocabulary(inputs.documents(spark, folder), size), "vocabulary")
        _VOCABULARIES[key] = store(add_tokens(base, K.ADDED_TOKENS), "vocabulary")
    return _VOCABULARIES[key]


def whole_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """All tokens of the documents, stored for the queries that read it."""
    return _vocabulary(spark, folder, None).select("token", "id")


def _encoded(
    spark: SparkSession,
    folder: str,
    max_tokens: int | None = DOCUMENT_TOKENS,
    size: int | None = VOCABULARY_SIZE,
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    vocab = _vocabulary(spark, folder, size)
    documents = inputs.documents(spark, folder).select("doc_id", "text")
    return encode(documents, vocab, max_tokens, keep=keep), vocab


def _sft_encoded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    vocab = _vocabulary(spark, folder)
    formatted, _ = mapping.format_sft(inputs.sft_examples(spark, folder), keep=["doc_id"])
    return encode(formatted, vocab, K.SFT_MAX_TOKENS), vocab


def _response_marker(vocab: DataFrame) -> list[int]:
    return token_ids(vocab, ["<|start_header_id|>", "assistant", "<|end_header_id|>", "\n\n"])


def _pad_id(vocab: DataFrame) -> Column:
    return resolve_pad(vocab).scalar()


def _tokens(encoded: DataFrame) -> DataFrame:
    texts = numbers_text("ids", "mask")("input_ids", "attention_mask")
    return encoded.select("doc_id", texts.alias("_texts")).select("doc_id", "_texts.ids", "_texts.mask")


@query
def vocabulary(spark, folder):
    return _vocabulary(spark, folder).select("token", "id")


@query
def pad_token(spark, folder):
    vocab = _vocabulary(spark, folder)
    choices = {
        "explicit": resolve_pad(vocab, pad_token=" "),
        "right_pad": resolve_pad(vocab),
        "end_of_text": resolve_pad(vocab, fallback=None),
    }
    rows = [c.select(F.lit(n).alias("rule"), "pad_id") for n, c in choices.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def encode_truncate(spark, folder):
    encoded, _ = _encoded(spark, folder)
    return _tokens(encoded)


@query
def encode_with_bos(spark, folder):
    documents = inputs.documents(spark, folder).select("doc_id", "text")
    vocab = _vocabulary(spark, folder)
    return _tokens(encode(documents, vocab, DOCUMENT_TOKENS, bos=LLAMA3.bos))


#: Tokens that stand inside and across the words of the documents.
REGISTERED = ["the", "tion", "on the", "ing th", "e", "und d", "ñ"]

#: What a task hands to its Python worker at once. The JVM holds it three times, in buffers that
#: double, for each of its cores and Python steps; without it Spark allows 64 MB.
BATCH_BYTES = "4m"


@query
def encode_registered(spark, folder):
    """Tokens registered in the vocabulary, wherever they stand."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    documents = inputs.documents(spark, folder).select("doc_id", "text")
    vocab = store(add_tokens(_vocabulary(spark, folder), REGISTERED), "vocabulary")
    return _tokens(encode(documents, vocab, DOCUMENT_TOKENS))


#: Few enough that most words of the documents are outside.
SMALL_VOCABULARY = 500


def _byte_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return store(add_byte_tokens(_vocabulary(spark, folder, SMALL_VOCABULARY)), "vocabulary")


@query
def encode_bytes(spark, folder):
    """Words outside a small vocabulary as their bytes."""
    documents = inputs.documents(spark, folder).select("doc_id", "text")
    return _tokens(encode(documents, _byte_vocabulary(spark, folder), DOCUMENT_TOKENS))


@query
def decode_bytes(spark, folder):
    """Whole texts through a small vocabulary and back."""
    documents = inputs.documents(spark, folder).select("doc_id", "text")
    vocab = _byte_vocabulary(spark, folder)
    return decode(encode(documents, vocab).select("doc_id", "input_ids"), vocab).select("doc_id", "text")


@query
def encode_joined(spark, folder):
    """The path for vocabularies too large to ship."""
    documents = inputs.documents(spark, folder).select("doc_id", "text")
    vocab = _vocabulary(spark, folder)
    return _tokens(encode_by_join(documents, vocab, DOCUMENT_TOKENS, keep=["doc_id"]))


@query
def decode_text(spark, folder):
    encoded, vocab = _encoded(spark, folder, None, None, ["doc_id"])
    return decode(encoded.select("doc_id", "input_ids"), vocab).select("doc_id", "text")


@query
def decode_joined(spark, folder):
    encoded, vocab = _encoded(spark, folder, None, None, ["doc_id"])
    rows = encoded.select("doc_id", "input_ids")
    return decode_by_join(rows, vocab).select("doc_id", "text")


@query
def completion_slice(spark, folder):
    """Generated ids after a prompt: here the prompt is a document's first line."""
    encoded, _ = _encoded(spark, folder, None)
    first_line = K.words(F.substring_index("text", "\n", 1))
    prompt = F.slice(F.col("input_ids"), F.lit(1), F.size(first_line))
    return encoded.select("doc_id", joined(K.after_prompt(F.col("input_ids"), prompt)).alias("ids"))


@query
def tensor_columns(spark, folder):
    encoded, _ = _encoded(spark, folder, None)
    tensors = mapping.tensor_columns(encoded)
    return tensors.select(joined("input_ids").alias("ids"), joined("attention_mask").alias("mask"))


# labels, padding, batches


@query
def labels_causal(spark, folder):
    encoded, vocab = _encoded(spark, folder)
    (newline,) = token_ids(vocab, ["\n"])
    return encoded.select(
        "doc_id",
        joined(K.causal_labels(F.col("input_ids"))).alias("labels"),
        joined(K.causal_labels(F.col("input_ids"), newline)).alias("labels_by_id"),
    )


@query
def labels_response(spark, folder):
    encoded, vocab = _sft_encoded(spark, folder)
    labels = K.response_labels(F.col("input_ids"), _response_marker(vocab))
    return encoded.select("doc_id", labels.alias("_labels")).select(
        "doc_id",
        joined("_labels").alias("labels"),
        K.supervised_tokens(F.col("_labels")).alias("supervised"),
    )


def _chat_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of whole conversations, their labels by the last header and by all assistant turns."""
    vocab = _vocabulary(spark, folder)
    texts = inputs.conversation_texts(inputs.table(spark, folder, "conversations"))
    encoded = encode(texts, vocab)
    marker = _response_marker(vocab)
    (end_id,) = token_ids(vocab, [LLAMA3.end_of_turn])
    ids = F.col("input_ids")
    return encoded.select(
        "conv_id",
        K.response_labels(ids, marker).alias("last"),
        K.assistant_labels(ids, marker, end_id).alias("turns"),
    )


@query
def labels_all_turns(spark, folder):
    """Every assistant turn of a conversation supervised."""
    return _chat_labels(spark, folder).select(
        "conv_id", joined("turns").alias("labels"), K.supervised_tokens(F.col("turns")).alias("supervised")
    )


@query
def supervision(spark, folder):
    """Rows, rows without any supervised token and supervised tokens under both rules."""
    labels = _chat_labels(spark, folder)
    rules = [F.struct(F.lit(r).alias("rule"), K.supervised_tokens(F.col(r)).alias("n")) for r in ("last", "turns")]
    counted = labels.select(F.inline(F.array(*rules)))
    return counted.groupBy("rule").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("n") == 0).alias("unsupervised"),
        F.sum("n").alias("tokens"),
    )


EPOCH, EPOCH_SEED = 2, 11


@query
def epoch_deal(spark, folder):
    """Third epoch of the documents, dealt to eight devices."""
    documents = inputs.table(spark, folder, "documents").select("doc_id")
    return batching.deal_epoch(documents, "doc_id", EPOCH, EPOCH_SEED)


@query
def length_batches(spark, folder):
    """Batches of similar lengths, and what they are padded to."""
    encoded, _ = _encoded(spark, folder)
    rows = encoded.select("doc_id", "input_ids")
    batched = batching.assign_length_batches(rows, "doc_id", 16, seed=EPOCH_SEED)
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch"))
    return batched.select("doc_id", "bucket", "batch", F.size("input_ids").alias("tokens"), longest.alias("length"))


@query
def batch_assign(spark, folder):
    documents = inputs.table(spark, folder, "documents").select("doc_id")
    return batching.assign_batches(
        documents, "doc_id", batching.CPT_BATCH, accumulation=batching.CPT_ACCUMULATION
    )


@query
def batch_pad(spark, folder):
    encoded, vocab = _encoded(spark, folder)
    rows = encoded.select("doc_id", "input_ids")
    batched = batching.assign_batches(rows, "doc_id", batching.CPT_BATCH)
    batched = batched.withColumn("labels", K.causal_labels(F.col("input_ids")))
    padded = batching.pad_batches(batched, _pad_id(vocab), labels="labels")
    return padded.select(
        "doc_id",
        "shard",
        "batch",
        "length",
        joined("input_ids").alias("ids"),
        joined("attention_mask").alias("mask"),
        joined("labels").alias("labels"),
    )


@query
def fixed_pad(spark, folder):
    encoded, vocab = _encoded(spark, folder)
    rows = encoded.select("doc_id", "input_ids")
    return _tokens(batching.pad_fixed(rows, _pad_id(vocab), DOCUMENT_TOKENS))


@query
def length_budget(spark, folder):
    """Documents as prompts (last tokens kept) and as completions (first tokens kept)."""
    encoded, _ = _encoded(spark, folder, None)
    ids = F.col("input_ids")
    return encoded.select(
        "doc_id",
        joined(K.prompt_budget(ids)).alias("prompt"),
        joined(K.completion_budget(ids)).alias("completion"),
    )


@query
def sft_batches(spark, folder):
    """Supervised files to padded batches under response-only labels."""
    path = fresh_path(spark, "sft")
    inputs.sft_examples(spark, folder).drop("doc_id").write.json(path)
    vocab = _vocabulary(spark, folder)
    formatted, _ = mapping.format_sft(read_sft(spark, path))
    encoded = encode(formatted, vocab, K.SFT_MAX_TOKENS)
    labels = K.response_labels(F.col("input_ids"), _response_marker(vocab))
    rows = encoded.withColumn("labels", labels).drop("attention_mask")
    batched = batching.assign_batches(
        rows, "text", batching.SFT_BATCH, accumulation=batching.SFT_ACCUMULATION
    )
    padded = batching.pad_batches(batched, _pad_id(vocab), labels="labels")
    return padded.select(
        "text",
        "shard",
        "batch",
        "step",
        "length",
        joined("input_ids").alias("ids"),
        joined("attention_mask").alias("mask"),
        joined("labels").alias("labels"),
    )


# callbacks and inference


@query
def map_callback(spark, folder):
    def measure(columns: dict[str, list]) -> dict[str, list]:
        texts = columns["text"]
        return {
            "n_words": [len(t.split(" ")) for t in texts],
            "shouted": [t.replace("e", "E") for t in texts],
        }

    schema = T.StructType(
        [T.StructField("n_words", T.LongType()), T.StructField("shouted", T.StringType())]
    )
    documents = inputs.table(spark, folder, "documents").select("doc_id", "text")
    return mapping.map_batches(documents, measure, schema, remove_columns=["text"])


@query
def prompts_filter(spark, folder):
    """Blank lines dropped: every French document is blanked to exotic whitespace here."""
    text = F.when(F.col("lang") == "fr", F.lit("\u2003\u00a0\u001c ")).otherwise(
        F.concat(F.lit("\u3000"), F.col("text"), F.lit("\u0085"))
    )
    lines = inputs.table(spark, folder, "documents").select("doc_id", text.alias("value"))
    return predict.drop_blank_lines(lines)


@query
def prompts_render(spark, folder):
    rendered = predict.render_prompts(inputs.prompt_lines(spark, folder))
    return rendered.select("text", "error")


def _echo() -> predict.Predictor:
    """Deterministic stand-in for a model."""
    return lambda texts, parameters: [f"{t}|{parameters.max_new_tokens}" for t in texts]


GREEDY = predict.GenerationParameters(temperature=0.0)


def _fields(lines: DataFrame) -> DataFrame:
    fields = ["conv_id", "turn", "prompt", "response"]
    values = [F.get_json_object("value", f"$.{f}").alias(f) for f in fields]
    keys = F.array_join(F.array_sort(F.json_object_keys("value")), ",")
    return lines.select(*values, keys.alias("keys"))


@query
def prompts_quarantine(spark, folder):
    """Unusable lines set aside: plain text, records without a prompt, unusable messages."""
    value = (
        F.when(F.col("role") == "system", F.concat(F.lit('{"prompt": '), "text"))
        .when(F.col("turn") == 0, F.concat(F.lit('{"turn": '), "turn", F.lit("}")))
        .when(F.col("role") == "user", F.to_json(F.struct(F.col("text").alias("prompt"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("messages"))))
    )
    turns = inputs.table(spark, folder, "conversations")
    lines = turns.select("conv_id", "turn", value.alias("value"))
    _, unusable = predict.quarantine(predict.render_prompts(lines))
    return unusable.select("conv_id", "turn", "error")


@query
def prompts_predict(spark, folder):
    lines = inputs.prompt_lines(spark, folder)
    return _fields(predict.predict_lines(lines, _echo, GREEDY))


@query
def prompts_sampled(spark, folder):
    """Predictions that draw from a random stream of their own row."""

    def open_model():
        def shuffle_words(texts, parameters, streams):
            words = [t.split(" ") for t in texts]
            return [" ".join(w[i] for i in s.permutation(len(w))[:8]) for w, s in zip(words, streams)]

        return shuffle_words

    turns = inputs.table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return predict.generate(turns, open_model, key=["conv_id", "turn"], seed=5).drop("text")


@query
def prompts_ordered(spark, folder):
    """Predictions in the order of the input lines over all files."""
    prompts, predictions = fresh_path(spark, "prompts"), fresh_path(spark, "predictions")
    lines = inputs.prompt_lines(spark, folder, ["conv_id", "turn"])
    lines.orderBy("conv_id", "turn").select("value").write.text(prompts)
    lines = read_prompt_lines(spark, prompts, places=True)
    write_ordered_lines(predict.predict_lines(lines, _echo, GREEDY, keep=PLACE), predictions)
    ordered = read_ordered_lines(spark, predictions)
    fields = [F.get_json_object("value", f"$.{f}").alias(f) for f in ("conv_id", "turn", "response")]
    return ordered.select("number", *fields)


@query
def advantage_stream(spark, folder):
    """Advantages of a stream of scored rollouts, each group when all of it is in."""
    source, target, state = (fresh_path(spark, name) for name in ("scored", "advantages", "state"))
    scored = rollouts.score(inputs.rollouts(spark, folder)).select("prompt_id", "gen_id", "reward")
    sizes = scored.groupBy("prompt_id").agg(F.count(F.lit(1)).alias("n"))
    time = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("gen_id")).alias("time")
    arriving = scored.join(sizes, "prompt_id").select("prompt_id", "gen_id", "reward", "n", time)
    arriving.repartition(4, "gen_id").write.parquet(source)
    stream = spark.readStream.schema("prompt_id bigint, gen_id bigint, reward double, n bigint, time timestamp")
    stream = stream.option("maxFilesPerTrigger", 2).parquet(source)
    advantages = stream_advantage(stream, "time", generations="n")
    writer = advantages.writeStream.format("parquet").option("checkpointLocation", state)
    writer.trigger(availableNow=True).start(target).awaitTermination()
    values = [rounded(n).alias(n) for n in ("reward", "advantage")]
    return spark.read.parquet(target).select("prompt_id", "gen_id", *values, "complete")


@query
def tokens_predict(spark, folder):
    """Inference on ids: encode, predict, drop the prompt, decode."""

    def open_model():
        def continue_backwards(prompts: list[list[int]], parameters) -> list[list[int]]:
            return [ids + ids[::-1][:16] for ids in prompts]

        return continue_backwards

    encoded, vocab = _encoded(spark, folder, None, None, ["doc_id"])
    prompts = encoded.select("doc_id", K.prompt_budget(F.col("input_ids")).alias("prompt"))
    predicted = predict.generate_tokens(prompts, open_model, GREEDY, "prompt")
    completion = K.after_prompt(F.col("output_ids"), F.col("prompt"))
    rows = predicted.select("doc_id", completion.alias("input_ids"))
    return decode(rows, vocab).select("doc_id", F.col("text").alias("response"))


# files


@query
def prompt_files(spark, folder):
    """Prompt lines written out, read back, predicted and written again as JSONL."""
    prompts, predictions = fresh_path(spark, "prompts"), fresh_path(spark, "predictions")
    inputs.prompt_lines(spark, folder).write.text(prompts)
    lines = predict.predict_lines(read_prompt_lines(spark, prompts), _echo, GREEDY)
    write_prediction_lines(lines, predictions)
    return _fields(spark.read.text(predictions))


@query
def prompt_folder(spark, folder):
    """The same through the restartable streaming run."""
    prompts, predictions, state = (
        fresh_path(spark, name) for name in ("prompts", "predictions", "state")
    )
    inputs.prompt_lines(spark, folder).write.text(prompts)
    predict_folder(spark, prompts, predictions, state, _echo, GREEDY).awaitTermination()
    return _fields(spark.read.text(predictions))


@query
def corpus_list_files(spark, folder):
    """Files that each hold one list over many lines."""
    path = fresh_path(spark, "corpus")
    records = inputs.documents(spark, folder).select(F.to_json(F.struct("*")).alias("value"))
    inputs.list_lines(records).write.text(path)
    return read_corpus(spark, path)


@query
def corpus_line_lists(spark, folder):
    """Files that each hold one list on one line."""
    path = fresh_path(spark, "corpus")
    records = inputs.documents(spark, folder).select(F.to_json(F.struct("*")).alias("value"))
    inputs.list_lines(records).write.option("lineSep", " ").text(path)
    return read_corpus(spark, path)


@query
def corpus_mixed_files(spark, folder):
    """A folder of line files and list files."""
    path = fresh_path(spark, "corpus")
    documents = inputs.documents(spark, folder)
    is_list = F.col("doc_id") % 2 == 0
    records = documents.where(is_list).select(F.to_json(F.struct("*")).alias("value"))
    inputs.list_lines(records).write.text(path)
    documents.where(~is_list).write.mode("append").json(path)
    return read_corpus(spark, path)


@query
def prompts_with_responses(spark, folder):
    """Records that bring a response and numbers of every form; those stay as written."""
    numbers = '"n": [1.50, 1e400, -0, NaN, -Infinity, 123456789012345678901234567890123456789012345]'
    turns = inputs.table(spark, folder, "conversations").where("text is not null")
    prompt = F.to_json(F.struct(F.col("text").alias("prompt")))
    rest = F.substring(prompt, F.lit(2), F.length(prompt))
    line = F.concat(F.lit('{"response": "old", ' + numbers + ","), rest)
    predicted = predict.predict_lines(turns.select(line.alias("value")), _echo, GREEDY)
    head = F.substring_index("value", ',"prompt"', 1)
    # the array is no strict JSON, so the two texts are read from what follows it
    tail = F.concat(F.lit("{"), F.substring("value", F.length(head) + 2, F.length("value")))
    texts = [F.get_json_object(tail, f"$.{f}").alias(f) for f in ("prompt", "response")]
    return predicted.select(head.alias("head"), *texts)


@query
def corpus_files(spark, folder):
    path = fresh_path(spark, "corpus")
    inputs.table(spark, folder, "documents").write.json(path)
    return read_corpus(spark, path)


@query
def sft_files(spark, folder):
    path = fresh_path(spark, "sft")
    inputs.sft_examples(spark, folder).write.json(path)
    return read_sft(spark, path)


@query
def qa_files(spark, folder):
    path = fresh_path(spark, "qa")
    inputs.qa_rows(spark, folder).write.parquet(f"{path}/train")
    inputs.qa_rows(spark, folder).write.json(f"{path}/test")
    splits = {"train": read_qa(spark, path), "test": read_qa(spark, path, "test", "json")}
    rows = [
        mapping.format_qa(rows).select(F.lit(name).alias("split"), "question", "answer")
        for name, rows in splits.items()
    ]
    return rows[0].unionByName(rows[1])


@query
def token_files(spark, folder):
    path = fresh_path(spark, "tokens")
    encoded, _ = _encoded(spark, folder)
    write_tokens(encoded, path, ("doc_id", "input_ids", "attention_mask"))
    return _tokens(spark.read.parquet(path))
