"""Chat formatting through a black-box renderer, turn by turn.

The renderer is any function from a list of (role, text) messages to one string. Each prefix of
a conversation is rendered and compared with the prefix before it: what is new is the turn's
piece, and what is gone shows a template that rewrites history. Only strings are compared, so
nothing is assumed about how the renderer works.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Message = tuple[str, str]
Renderer = Callable[[Sequence[Message]], str]

#: Characters of prefixes that a task renders of a conversation; longer conversations are dealt to
#: several tasks, MOST_PARTS at most, as each of them reads the turns before its own.
PART_CHARS, MOST_PARTS = 32_000_000, 64

#: What a message counts besides its characters.
MESSAGE_CHARS = 32


def _probe(messages: Sequence[Message]) -> str:
    """A private-use string that no message holds, to stand for a text while its place is sought."""
    for code in range(0xE000, 0xF900):
        if not any(chr(code) in role or chr(code) in text for role, text in messages):
            return chr(code) * 3
    raise ValueError("the messages hold all private-use characters")


#: The control strings of the marked template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    """Backslashes doubled, and one put after the first character of every control string."""
    doubled = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render_marked(messages: Sequence[Message]) -> str:
    """Turns between control strings; texts are escaped, so they hold none themselves."""
    parts = []
    for role, text in messages:
        text = escape(text)
        if role == "user":
            parts.append(f"<s>[INST] {text} [/INST]")
        elif role == "assistant":
            parts.append(f" {text} </s>")
        elif role == "system":
            parts.append(f"[SYS] {text} [/SYS]")
        else:
            parts.append(f"[ROLE]{escape(role)}[/ROLE] {text} </s>")
    return "".join(parts)


@dataclass(frozen=True)
class Template:
    """A renderer and what the formatter may know about it.

    ``encode``: what the renderer does to a text before it places it.
    ``lookback``: how many messages before a turn its piece may depend on, if that is to be
    checked. Every whole prefix is rendered either way; with a number format_turns also renders
    each turn after that many messages only, and fails where its piece isn't the same.
    """

    render: Renderer
    encode: Callable[[str], str] = str
    lookback: int | None = None


MARKED = Template(render_marked, escape)


@dataclass(frozen=True)
class Piece:
    """What a turn adds to the rendering so far.

    The text up to this turn is the text before it without its last ``cut`` characters, and then
    ``piece``. ``cut`` is over 0 where the template rewrites history. The turn's encoded text is
    ``piece[start : start + length]``; ``start`` is None where it isn't found as it is.
    """

    piece: str
    cut: int
    start: int | None
    length: int


def _common(left: str, right: str) -> int:
    low, high = 0, min(len(left), len(right))
    while low < high:
        middle = (low + high + 1) // 2
        if left[low:middle] == right[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def next_piece(template: Template, earlier: Sequence[Message], message: Message) -> Piece:
    """The piece of ``message`` after ``earlier``, by comparing two renderings."""
    before = template.render(earlier) if earlier else ""
    return _compared(template, earlier, message, before)[0]


def _compared(
    template: Template, earlier: Sequence[Message], message: Message, before: str
) -> tuple[Piece, str]:
    """The piece of ``message`` and the rendering up to it, given the rendering of ``earlier``."""
    after = template.render([*earlier, message])
    kept = len(before) if after.startswith(before) else _common(before, after)
    piece = after[kept:]
    encoded = template.encode(message[1])
    mark = _probe([*earlier, message])
    probe = template.render([*earlier, (message[0], mark)])
    at = probe.find(mark, _common(before, probe))
    start = at - kept if at >= kept and after[at : at + len(encoded)] == encoded else None
    return Piece(piece, len(before) - kept, start, len(encoded) if start is not None else 0), after


FORMATTED = (
    "conv_id bigint, seq bigint, turn bigint, role string, piece string, cut int, "
    "text_start int, text_length int, supervised boolean"
)


def format_turns(
    turns: DataFrame, template: Template = MARKED, supervised: Sequence[str] = ("assistant",)
) -> DataFrame:
    """One row per turn (conv_id, turn, role, text): its piece of the formatted conversation.

    Columns: conv_id, seq (place in the conversation, from 0), turn, role, piece, cut,
    text_start, text_length, supervised (the turn's text is under the loss mask). A
    conversation's text is its pieces in order (see Piece for templates that cut).

    Every prefix of every conversation is rendered whole, which takes time in the square of a
    conversation's turns. Conversations are dealt out by id; one that needs more than PART_CHARS
    is dealt out in parts of about equal work, each of which has the turns before it as well. A
    task holds the messages of one conversation and a few renderings of it. Turns go in order of
    turn, role and text. Null texts and roles count as empty, null turns come first, null ids
    form one conversation, repeated rows are turns of their own, and an empty table gives no
    rows. Texts of any length are rendered whole. Other columns are not read.
    """
    marked = tuple(supervised)
    lookback = template.lookback

    def check(p: Piece, earlier: list[Message], message: Message, conv_id: int | None) -> None:
        if next_piece(template, earlier[len(earlier) - lookback :], message) != p:
            raise ValueError(f"conversation {conv_id}: a piece depends on more than {lookback} messages before it")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, earlier, before = object(), [], None
        for batch in batches:
            rows = []
            columns = (batch.column(n).to_pylist() for n in _READ)
            for conv_id, part, own, seq, turn, role, text in zip(*columns):
                if (conv_id, part) != current:
                    current, earlier, before = (conv_id, part), [], None
                message = (role, text)
                if own:
                    if before is None:
                        before = template.render(earlier) if earlier else ""
                    p, before = _compared(template, earlier, message, before)
                    if lookback is not None and len(earlier) > lookback:
                        check(p, earlier, message, conv_id)
                    rows.append((conv_id, seq, turn, role, p.piece, p.cut, p.start, p.length, role in marked))
                earlier.append(message)
            yield _batch(rows)

    dealt = _in_parts(
        turns.select(
            F.col("conv_id").cast("bigint"),
            F.col("turn").cast("bigint"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
    )
    # conversations of one part stay where they were numbered
    whole = dealt.where(F.col("last") == 0).withColumn("own", F.lit(True))
    whole = whole.select(*_READ).sortWithinPartitions("conv_id", "turn", "role", "text")
    parts = dealt.where(F.col("last") > 0).withColumn("of", F.explode(F.sequence("part", "last")))
    parts = parts.withColumn("own", F.col("of") == F.col("part")).withColumn("part", F.col("of")).select(*_READ)
    # a given number, as they are few rows with much work each, which else would be put together
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.repartition(tasks, "conv_id", "part").sortWithinPartitions("conv_id", "part", "seq")
    return whole.mapInArrow(run, FORMATTED).unionByName(parts.mapInArrow(run, FORMATTED))


_READ = ("conv_id", "part", "own", "seq", "turn", "role", "text")


def _in_parts(turns: DataFrame) -> DataFrame:
    """The turns with their place in the conversation (seq), the part of it that renders them and
    the conversation's last part, from 0."""
    place = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size = F.length("role") + F.length("text") + F.lit(MESSAGE_CHARS).cast("bigint")
    share = F.greatest(F.lit(float(PART_CHARS)), F.max("rendered").over(whole) / MOST_PARTS)
    return (
        turns.withColumn("seq", F.row_number().over(place).cast("bigint") - 1)
        .withColumn("prefix", F.sum(size).over(so_far))
        .withColumn("rendered", F.sum("prefix").over(so_far))
        .withColumn("part", F.floor((F.col("rendered") - F.col("prefix")) / share))
        .withColumn("last", F.max("part").over(whole))
    )


_KINDS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("seq", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("piece", pa.string()),
        ("cut", pa.int32()),
        ("text_start", pa.int32()),
        ("text_length", pa.int32()),
        ("supervised", pa.bool_()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in _KINDS]
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, _KINDS)]
    return pa.RecordBatch.from_arrays(arrays, schema=_KINDS)


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint, rewritten bigint"
)


def conversation_digests(formatted: DataFrame, decode: Callable[[str], str] = unescape) -> DataFrame:
    """Per conversation of format_turns' output: what its pieces say when read back.

    n_turns, sha256 of role, newline, text, newline of each turn, characters and sha256 of all
    supervised texts, characters of the formatted conversation, and the number of turns that
    rewrote history. A digest needs its conversation in order, so one task takes each
    conversation; it streams and holds one turn at a time. A turn whose text was not found in its
    piece cannot be read back and stops the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["conv_id", "role", "piece", "cut", "text_start", "text_length", "supervised"]
        current, state = object(), None
        done: list[tuple] = []

        def close() -> None:
            if state is not None:
                n, turns, chars, loss, size, rewritten = state
                done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size, rewritten))

        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in fields)
            for conv_id, role, piece, cut, start, length, supervised in zip(*columns):
                if state is None or conv_id != current:
                    close()
                    current, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                if start is None:
                    raise ValueError(f"conversation {conv_id}: a text does not stand in its piece as it is")
                text = decode(piece[start : start + length])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if supervised:
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(piece) - cut
                state[5] += cut > 0
            if len(done) > 1000:
                yield _digest_batch(done)
                done = []
        close()
        if done:
            yield _digest_batch(done)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return ordered.mapInArrow(run, DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.strip().split(" ")[0] for f in DIGESTS.split(",")]
    kinds = [pa.string() if "sha256" in n else pa.int64() for n in names]
    arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names)
