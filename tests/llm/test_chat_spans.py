import dataclasses
import types
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import chat_spans
from quillspark.llm.chat_spans import (
    CONTROL,
    MARKED,
    Template,
    conversation_digests,
    escape,
    format_turns,
    next_piece,
    render_marked,
    unescape,
)

TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_escaped_texts_hold_no_control_string():
    rng = random.Random(1)
    parts = [*CONTROL, "\\", "<", "[", "/", "s>", "INST]", "a", "\n"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(8)))
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in CONTROL)


def conversations(seed=1):
    rng = random.Random(seed)
    parts = [*CONTROL, "\\", "hello", "é", "\n", " ", "", None]
    rows = []
    for c in range(40):
        for t in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", None])
            text = rng.choice(parts) if rng.random() < 0.3 else "".join(str(p) for p in rng.choices(parts[:-1], k=5))
            rows.append((c, t, role, text))
    rows += [(50, None, "user", "null turn"), (50, 0, "assistant", "x"), (None, 0, "user", "null id")]
    rows += [(51, 0, "user", "tie b"), (51, 0, "user", "tie a"), (52, 0, "user", "twice"), (52, 0, "user", "twice")]
    rows += [(53, t, ["user", "assistant"][t % 2], f"turn {t}") for t in range(700)]
    rows += [(54, 0, "assistant", "long " * 50_000)]
    return rows


def brute(rows):
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = []
    for c, turns in groups.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        rendered = render_marked([(r, x) for *_, r, x in turns])
        out.append(
            (
                c,
                len(turns),
                hashlib.sha256(whole.encode()).hexdigest(),
                len(loss),
                hashlib.sha256(loss.encode()).hexdigest(),
                len(rendered),
                0,
            )
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("lookback", [0, 1, None])
def test_pieces_read_back_as_the_conversation(spark, lookback):
    rows = [r for r in conversations() if lookback is not None or r[0] != 53]
    turns = spark.createDataFrame(rows, TURNS).withColumn("piece", F.lit("clash")).repartition(5)
    formatted = format_turns(turns, Template(render_marked, escape, lookback))
    assert sorted(map(tuple, conversation_digests(formatted).collect()), key=repr) == brute(rows)


def test_pieces_join_to_the_whole_rendering(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "</s>"), (1, 2, "assistant", "[INST]")]
    got = format_turns(spark.createDataFrame(rows, TURNS)).orderBy("seq").collect()
    assert "".join(r.piece for r in got) == render_marked([r[2:] for r in rows])
    for r, (*_, text) in zip(got, rows):
        assert unescape(r.piece[r.text_start : r.text_start + r.text_length]) == text


def test_templates_that_rewrite_history_show():
    """This one keeps the reasoning of the last turn only."""

    def render(messages):
        last = len(messages) - 1
        return "".join(f"<{r}>{x if i == last else x.split('#')[-1]}" for i, (r, x) in enumerate(messages))

    template, text, earlier, cuts = Template(render), "", [], []
    for message in [("u", "q"), ("a", "why#yes"), ("u", "more"), ("a", "so#no")]:
        piece = next_piece(template, earlier, message)
        text = text[: len(text) - piece.cut] + piece.piece
        earlier.append(message)
        cuts.append(piece.cut)
        assert text == render(earlier)
    assert cuts == [0, 0, len("why#yes"), 0]


def test_templates_that_change_texts_have_no_span():
    template = Template(lambda m: "".join(f"[{x.strip()}]" for _, x in m))
    assert next_piece(template, [], ("u", " padded ")).start is None
    assert next_piece(template, [], ("u", "plain")).start == 1


def test_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_digests(format_turns(empty, MARKED)).count() == 0


def numbered(messages):
    """Texts depend on how many messages there are before them."""
    return "".join(f"<{i}>{t}</{i}>" if i < 2 else f"<{len(messages)}>{t}</>" for i, (_, t) in enumerate(messages))


def later(messages):
    return "".join(f"<{'late' if i > 2 else 'early'}>{t}</>" for i, (_, t) in enumerate(messages))


@pytest.mark.parametrize("render", [numbered, later])
def test_a_lookback_that_is_not_true_is_noticed(spark, render):
    rows = [(c, t, "user", f"text {t}") for c in range(5) for t in range(5)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    template = by_value(render)
    with pytest.raises(Exception, match="depends on more than 1 messages"):
        format_turns(turns, Template(template, str, 1)).collect()
    assert format_turns(turns, Template(template, str, None)).count() == 25


def by_value(render):
    """The renderer as a function that workers get whole, for they cannot import this module."""
    return types.FunctionType(render.__code__, {"__builtins__": __builtins__}, render.__name__)


def test_texts_that_hold_private_use_characters(spark):
    odd = "".join(chr(c) for c in (0xE000, 0xE001, 0xE000)) * 3
    rows = [(1, 0, odd, "a"), (1, 1, "user", odd), (1, 2, "assistant", odd + "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    (row,) = conversation_digests(format_turns(turns)).collect()
    want = "".join(f"{r}\n{t}\n" for _, _, r, t in rows)
    assert row.turns_sha256 == hashlib.sha256(want.encode()).hexdigest() and row.loss_chars == 10


def test_a_text_that_cannot_be_read_back_stops_the_job(spark):
    turns = spark.createDataFrame([(1, 0, "user", " padded ")], "conv_id bigint, turn bigint, role string, text string")

    def stripped(messages):
        return "".join(t.strip() for _, t in messages)

    formatted = format_turns(turns, Template(stripped, str, None))
    with pytest.raises(Exception, match="does not stand in its piece"):
        conversation_digests(formatted, str).collect()


def latest(messages):
    return "".join(f"<{'late' if i > 100 else 'early'}>{t}</>" for i, (_, t) in enumerate(messages))


def from_the_start(messages):
    """Fails on anything but the beginning of a conversation."""
    if messages[0][0] != "first":
        raise ValueError("not a whole prefix")
    return "".join(f"<{i}>{t}</>" for i, (_, t) in enumerate(messages))


def recounting(messages):
    """The end is written anew after each turn."""
    return "".join(t for _, t in messages) + f"|{len(messages)}"


def a_long_conversation(spark, n=150):
    rows = [(1, t, "user" if t else "first", f"text {t}") for t in range(n)]
    return spark.createDataFrame([*rows, (2, 0, "first", "alone")], TURNS)


def test_a_lookback_is_checked_on_every_turn(spark):
    """Also where it fails after a hundred turns only."""
    with pytest.raises(Exception, match="depends on more than 1 messages"):
        format_turns(a_long_conversation(spark), Template(by_value(latest), str, 1)).collect()


def test_every_prefix_is_rendered_whole(spark):
    template = dataclasses.replace(MARKED, render=by_value(from_the_start), encode=str)
    got = format_turns(a_long_conversation(spark), template).where("conv_id = 1").orderBy("seq").collect()
    assert "".join(r.piece for r in got) == "".join(f"<{t}>text {t}</>" for t in range(150))


@pytest.mark.parametrize("render", [render_marked, latest, recounting])
@pytest.mark.parametrize("chars", [1, 20_000, 10**9])
def test_parts_of_a_long_conversation_give_the_pieces_of_the_whole(spark, monkeypatch, render, chars):
    monkeypatch.setattr(chat_spans, "PART_CHARS", chars)
    turns = a_long_conversation(spark, 90).repartition(3)
    last = {r.conv_id: r.last for r in chat_spans._in_parts(turns).collect()}
    assert last[2] == 0 and (last[1] == 0 if chars == 10**9 else 2 < last[1] <= chat_spans.MOST_PARTS)
    template = Template(render if render is render_marked else by_value(render), escape)
    got = format_turns(turns, template).where("conv_id = 1").orderBy("seq").collect()
    text, earlier = "", []
    for t, r in enumerate(got):
        message = ("user" if t else "first", f"text {t}")
        want = next_piece(Template(render, escape), earlier, message)
        assert (r.seq, r.turn, r.role) == (t, t, message[0])
        assert (r.piece, r.cut, r.text_start, r.text_length) == dataclasses.astuple(want)
        earlier.append(message)
        text = text[: len(text) - r.cut] + r.piece
    assert len(got) == 90 and text == render(earlier)
