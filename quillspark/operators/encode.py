"""Text to token ids and back over a vocabulary table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.tokens import SPECIAL_TOKENS, attention_mask, model_tokens, word_pattern, words
from quillspark.operators.scanner import registered_words, split_registered
from quillspark.operators.vocabulary import (
    UNKNOWN,
    LookupLimit,
    byte_ids,
    byte_tokens,
    registered_tokens,
    token_ids,
)
from quillspark.session import store


def encode(
    df: DataFrame,
    vocab: DataFrame,
    max_tokens: int | None = None,
    text: str = "text",
    pattern: str | None = None,
    unknown: str = UNKNOWN,
    bos: str | None = None,
    limit: LookupLimit = LookupLimit(),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` for a text column, whole unless ``max_tokens``.

    ``keep`` names the columns of ``df`` that go along, all of them unless it is given.

    Raw corpus text takes a beginning token (``bos``), rendered chat text brings its own. Words
    are split and truncated in the JVM. A vocabulary within ``limit`` is then looked up in
    place, with no shuffle; a larger one is joined (see encode_by_join). Both give the same
    rows. The check runs on ``vocab``, so pass a stored or checkpointed table.

    Tokens registered in the vocabulary (add_tokens) are found wherever they stand, the longest
    of those that begin first. With byte tokens (add_byte_tokens) words outside the vocabulary
    become their UTF-8 bytes instead of ``unknown``; a byte counts as a token of ``max_tokens``.
    """
    if not limit.admits(vocab):
        return encode_by_join(df, vocab, max_tokens, text, pattern, unknown, bos, keep)
    registered = registered_tokens(vocab)
    if _scanned(registered, pattern):  # words are looked up where they are found
        lookup = _id_lookup(vocab, unknown, max_tokens)
        ids = _scan(vocab, registered, bos, max_tokens, lookup, "array<int>")(F.col(text))
    else:
        tokens = text_tokens(vocab, F.col(text), max_tokens, pattern, bos, registered)
        ids = _lookup_ids(vocab, unknown, max_tokens)(tokens)
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("input_ids", "attention_mask")]
    encoded = df.withColumn("input_ids", ids) if keep is None else df.select(*kept, ids.alias("input_ids"))
    return encoded.withColumn("attention_mask", attention_mask(F.col("input_ids")))


def text_tokens(
    vocab: DataFrame,
    text: Column,
    max_tokens: int | None = None,
    pattern: str | None = None,
    bos: str | None = None,
    registered: list[str] | None = None,
) -> Column:
    """Tokens of a text: the registered ones of the vocabulary, and words between them.

    The tokens of the chat formats are part of the default pattern. Only where others are
    registered does the text go through the scanner. ``registered``: them, if already collected.
    """
    registered = registered_tokens(vocab) if registered is None else registered
    if _scanned(registered, pattern):
        return _scan(vocab, registered, bos, max_tokens)(text)
    if pattern is None or not registered:
        return model_tokens(text, max_tokens, pattern, bos)
    segments = split_registered(vocab.sparkSession, registered)(text)
    found = F.flatten(
        F.transform(
            segments,
            lambda s: F.when(s["token"], F.array(s["text"])).otherwise(words(s["text"], pattern)),
        )
    )
    found = found if bos is None else F.concat(F.array(F.lit(bos)), found)
    return found if max_tokens is None else F.slice(found, 1, max_tokens)


def _scanned(registered: Sequence[str], pattern: str | None) -> bool:
    """Whether a text is split in one pass in Python, and not by a regex in the JVM."""
    return pattern is None and not set(registered) <= set(SPECIAL_TOKENS)


def _scan(vocab: DataFrame, registered: Sequence[str], *options) -> Callable[[Column], Column]:
    return registered_words(vocab.sparkSession, [*registered, *SPECIAL_TOKENS], word_pattern(), *options)


def _lookup_ids(
    vocab: DataFrame, unknown: str = UNKNOWN, max_tokens: int | None = None
) -> Callable[[Column], Column]:
    """Expression mapping token arrays to id arrays; the vocabulary must be of checked size."""
    part_ids = _id_lookup(vocab, unknown, max_tokens)

    @F.arrow_udf("array<int>")
    def ids_of(tokens: pa.Array) -> pa.Array:
        return _in_slices(tokens, part_ids)

    return ids_of


def _id_lookup(
    vocab: DataFrame, unknown: str = UNKNOWN, max_tokens: int | None = None
) -> Callable[[pa.Array], pa.Array]:
    """As _lookup_ids, for arrays that are in a worker already."""
    in_bytes = byte_ids(vocab)
    (unknown_id,) = token_ids(vocab, [unknown], unknown) if in_bytes is None else (None,)
    shared = _broadcast(vocab)

    def part_ids(tokens: pa.Array) -> pa.Array:
        known, ids = shared.value
        place = pc.index_in(tokens.flatten(), value_set=known)
        if in_bytes is None:
            return _relist(tokens, pc.fill_null(ids.take(place), unknown_id))
        return _with_bytes(tokens, ids.take(place), np.array(in_bytes, np.int32), max_tokens)

    return part_ids


def _with_bytes(
    tokens: pa.Array, found: pa.Array, in_bytes: np.ndarray, max_tokens: int | None
) -> pa.Array:
    """Id arrays of token arrays, with the bytes of tokens that were not found, then cut."""
    flat = tokens.flatten()
    missing = found.is_null().to_numpy(zero_copy_only=False)
    sizes = np.where(missing, pc.binary_length(flat).to_numpy(zero_copy_only=False), 1).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.empty(ends[-1], np.int32)
    ids[ends[:-1][~missing]] = found.drop_null().to_numpy()
    spelled = np.frombuffer(b"".join(flat.filter(pa.array(missing)).cast(pa.binary()).to_pylist()), np.uint8)
    inside = np.ones(ends[-1], bool)
    inside[ends[:-1][~missing]] = False
    ids[inside] = in_bytes[spelled]
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    bounds = ends[np.concatenate([[0], np.cumsum(lengths)])]
    if max_tokens is not None:
        rows = np.diff(bounds)
        ids = ids[np.arange(ends[-1]) - np.repeat(bounds[:-1], rows) < max_tokens]
        bounds = np.concatenate([[0], np.cumsum(np.minimum(rows, max_tokens))])
    mask = tokens.is_null() if tokens.null_count else None
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids), mask=mask)


def _lookup_text(vocab: DataFrame, unknown: str = UNKNOWN) -> Callable[[Column], Column]:
    """Expression mapping id arrays to the concatenation of their tokens."""
    in_bytes = byte_ids(vocab)
    shared = _broadcast(vocab)

    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        return _in_slices(ids, part_text)

    def part_text(ids: pa.Array) -> pa.Array:
        tokens, known = shared.value
        place = pc.index_in(ids.flatten(), value_set=known)
        if in_bytes is None:
            return pc.binary_join(_relist(ids, pc.fill_null(tokens.take(place), unknown)), "")
        spelled = pa.array([bytes([b]) for b in range(256)])
        byte = pc.index_in(ids.flatten(), value_set=pa.array(in_bytes, pa.int32()))
        parts = pc.coalesce(spelled.take(byte), tokens.cast(pa.binary()).take(place), unknown.encode())
        joined = pc.binary_join(_relist(ids, parts), b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no whole characters, as truncation leaves them
            texts = [None if b is None else b.decode("utf-8", "replace") for b in joined.to_pylist()]
            return pa.array(texts, pa.string())

    return text_of


def numbers_text(*names: str) -> Callable[..., Column]:
    """Expression that writes arrays of whole numbers without nulls as texts, spaces between: a
    struct with a field of each name for that many arrays, two at least, which must be as long.

    Rows go back as they are done, so that a task holds the texts of SLICE_BYTES and not of a batch.
    """

    @F.arrow_udf(", ".join(f"{n} string" for n in names))
    def texts_of(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            for start, end in _cuts(batch[0], SLICE_BYTES):
                parts = [lists.slice(start, end - start) for lists in batch]
                texts = [pc.binary_join(_relist(p, p.flatten().cast(pa.string())), " ") for p in parts]
                yield pa.StructArray.from_arrays(texts, list(names))
            pa.default_memory_pool().release_unused()

    return texts_of


#: Bytes of items that are converted at once; a batch of rows may hold many times that.
SLICE_BYTES = 4_000_000


def _in_slices(lists: pa.Array, convert: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``convert`` of some rows at a time, so that what it needs besides follows SLICE_BYTES and
    not the size of the batch."""
    parts = [convert(lists.slice(start, end - start)) for start, end in _cuts(lists, SLICE_BYTES)]
    whole = pa.concat_arrays(parts) if parts else convert(lists)
    del parts
    pa.default_memory_pool().release_unused()
    return whole


def _broadcast(vocab: DataFrame) -> Broadcast[tuple[pa.Array, pa.Array]]:
    """Tokens and ids of a vocabulary that LookupLimit has admitted."""
    table = vocab.select("token", F.col("id").cast("int")).toArrow()
    columns = table["token"].combine_chunks(), table["id"].combine_chunks()
    return vocab.sparkSession.sparkContext.broadcast(columns)


def _relist(like: pa.Array, values: pa.Array) -> pa.Array:
    """``values`` cut into lists of the same lengths (and nulls) as ``like``."""
    lengths = pc.fill_null(pc.list_value_length(like), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


def _relist_lists(like: pa.Array, values: pa.Array) -> pa.Array:
    """As _relist, of values that are lists themselves, put together."""
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    lengths = pc.fill_null(pc.list_value_length(like), 0).to_numpy(zero_copy_only=False)
    bounds = ends[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(pa.array(bounds), values.flatten(), mask=mask)


def encode_by_join(
    df: DataFrame,
    vocab: DataFrame,
    max_tokens: int | None = None,
    text: str = "text",
    pattern: str | None = None,
    unknown: str = UNKNOWN,
    bos: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Encode against a vocabulary of any size by joining the words of blocks of rows.

    The text is split once and rows need no key (see _join_items).
    """
    in_bytes = byte_ids(vocab)
    tokens = text_tokens(vocab, F.col(text), max_tokens, pattern, bos)
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("input_ids", "attention_mask")]
    rows = df.select(*kept, tokens.alias("_words"))
    wanted = vocab.select(F.col("token").alias("_item"), F.col("id").cast("int").alias("_value"))
    if in_bytes is None:
        (unknown_id,) = token_ids(vocab, [unknown], unknown)
        encoded = _join_items(rows, "_words", wanted, F.lit(unknown_id), _relist)
    else:
        wanted = wanted.withColumn("_value", F.array("_value"))
        encoded = _join_items(rows, "_words", wanted, _spelled(F.col("_item"), in_bytes), _relist_lists)
        if max_tokens is not None:
            encoded = encoded.withColumn("_values", F.slice("_values", 1, max_tokens))
    encoded = encoded.select(*kept, F.col("_values").alias("input_ids"))
    return encoded.withColumn("attention_mask", attention_mask(F.col("input_ids")))


def _spelled(token: Column, in_bytes: list[int]) -> Column:
    """Ids of the UTF-8 bytes of a token."""
    table = F.array(*[F.lit(i) for i in in_bytes])
    digits = F.hex(token)

    def id_at(place: Column) -> Column:
        byte = F.conv(F.substring(digits, 2 * place - 1, F.lit(2)), 16, 10).cast("int")
        return F.element_at(table, byte + 1)

    return F.transform(F.sequence(F.lit(1), F.octet_length(token)), id_at)


def _join_items(
    rows: DataFrame,
    items: str,
    wanted: DataFrame,
    default: Column,
    assemble: Callable[[pa.Array, pa.Array], pa.Array],
    keep: bool = False,
) -> DataFrame:
    """``rows`` without their items (unless ``keep``), but with ``_values``: what ``assemble``
    makes of the lists and of the vocabulary values of all their elements.

    The rows are stored in blocks of bounded size, with their items as places in a list of the
    block's distinct ones. Only those lists are exploded and joined, so that an item goes through
    the shuffles once for a block and not once for every occurrence. Each block's values then meet
    its rows in one task.
    """
    others = rows.drop(items)
    kind = rows.schema[items].dataType
    added = [("_block", T.LongType()), ("_codes", T.ArrayType(T.IntegerType())), ("_items", kind)]
    coded = T.StructType([*others.schema.fields, *[T.StructField(n, k) for n, k in added]])
    stored = store(rows.select(*others.columns, items).mapInArrow(_block_maker(items), coded), "blocks")
    known = stored.where(F.col("_items").isNotNull())
    known = known.select(F.col("_block").alias("_of"), F.posexplode("_items").alias("_code", "_item"))
    found = known.join(wanted, "_item", "left")
    columns = ["_of", "_code", F.coalesce("_value", default).alias("_value")]
    found = found.select(*columns, *(["_item"] if keep else []))

    value = found.schema["_value"].dataType
    result = value if isinstance(value, (T.StringType, T.ArrayType)) else T.ArrayType(value)
    kept = [rows.schema[items]] if keep else []
    schema = T.StructType([*others.schema.fields, *kept, T.StructField("_values", result)])
    names = schema.names

    def meet(block: pa.Table, values: pa.Table) -> pa.Table:
        codes = block["_codes"].combine_chunks()
        place = codes.flatten()
        values = values.sort_by("_code")
        columns = {n: block[n] for n in names if n in block.column_names}
        columns["_values"] = assemble(codes, values["_value"].combine_chunks().take(place))
        if keep:
            columns[items] = _relist(codes, values["_item"].combine_chunks().take(place))
        return pa.table([columns[n] for n in names], names)

    left = stored.drop("_items").groupBy("_block")
    return left.cogroup(found.groupBy("_of")).applyInArrow(meet, schema)


#: Bytes of items in a block of rows, whose distinct items are looked up together.
BLOCK_BYTES = 16_000_000


def _block_maker(items: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Puts consecutive rows into blocks; the first row of a block has its distinct items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            lists = batch.column(items)
            for start, end in _cuts(lists, BLOCK_BYTES):
                part = lists.slice(start, end - start)
                coded = part.flatten().dictionary_encode()
                first = np.zeros(end - start + 1, np.int32)
                first[1:] = len(coded.dictionary)
                others = np.arange(end - start) > 0
                distinct = pa.ListArray.from_arrays(pa.array(first), coded.dictionary, mask=pa.array(others))
                columns = [batch.column(n).slice(start, end - start) for n in batch.schema.names if n != items]
                names = [n for n in batch.schema.names if n != items]
                columns += [pa.array(np.full(end - start, block)), _relist(part, coded.indices), distinct]
                yield pa.RecordBatch.from_arrays(columns, [*names, "_block", "_codes", "_items"])
                block += 1

    return run


def _cuts(lists: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows whose items take at most ``size`` bytes; a row is never cut."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    flat = lists.flatten()
    ends = 4 * bounds
    if pa.types.is_string(flat.type):
        offsets = np.frombuffer(flat.buffers()[1] or bytes(4), np.int32)[flat.offset :]
        ends = ends + offsets[bounds] - offsets[0]
    start = 0
    while start < len(lists):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + size, side="right")) - 1)
        yield start, end
        start = end


def decode(
    df: DataFrame,
    vocab: DataFrame,
    ids: str = "input_ids",
    unknown: str = UNKNOWN,
    limit: LookupLimit = LookupLimit(),
) -> DataFrame:
    """Add ``text``: the tokens of an id array put together, special tokens kept."""
    if limit.admits(vocab):
        return df.withColumn("text", _lookup_text(vocab, unknown)(F.col(ids)))
    return decode_by_join(df, vocab, ids, unknown)


def decode_by_join(
    df: DataFrame, vocab: DataFrame, ids: str = "input_ids", unknown: str = UNKNOWN
) -> DataFrame:
    """Decode against a vocabulary of any size, as encode_by_join encodes."""
    in_bytes = byte_ids(vocab)
    token, text = F.col("token"), F.col("_values")
    if in_bytes is not None:  # all tokens by the digits of their bytes
        is_byte = token.isin(byte_tokens())
        token = F.when(is_byte, F.substring(token, 4, 2)).otherwise(F.hex(token))
        text = F.make_valid_utf8(F.unhex(text).cast("string"))
        unknown = unknown.encode().hex()
    wanted = vocab.select(F.col("id").cast("int").alias("_item"), token.alias("_value"))
    kept = [c for c in df.columns if c != "text"]

    def concatenated(lists: pa.Array, values: pa.Array) -> pa.Array:
        return pc.binary_join(_relist(lists, pc.fill_null(values, unknown)), "")

    decoded = _join_items(df.select(*kept), ids, wanted, F.lit(unknown), concatenated, keep=True)
    return decoded.select(*kept, text.alias("text"))


def encode_with(
    df: DataFrame,
    tokenizer_factory: Callable[[], Callable[[list[str]], Sequence[Sequence[int]]]],
    max_tokens: int | None = None,
    text: str = "text",
) -> DataFrame:
    """Encode with a user-supplied tokenizer; it must give one list of ids per text.

    The factory runs once per task, typically opening a file shipped with SparkContext.addFile.
    Only the text column goes to Python.
    """

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = tokenizer_factory()
        for batch in batches:
            texts = batch.to_pylist()
            present = [t for t in texts if t is not None]
            found = tokenizer(present)
            if len(found) != len(present):
                raise ValueError(f"the tokenizer gave {len(found)} rows for {len(present)} texts")
            following = iter(found)
            rows = [None if t is None else list(next(following))[:max_tokens] for t in texts]
            yield pa.array(rows, pa.list_(pa.int32()))

    encoded = df.withColumn("input_ids", ids_of(F.col(text)))
    return encoded.withColumn("attention_mask", attention_mask(F.col("input_ids")))
