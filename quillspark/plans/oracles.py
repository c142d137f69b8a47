"""DuckDB SQL that states each registered query independently over the same tables."""

from __future__ import annotations

# What Python strips from a text, the format instruction, the tokens added to a
# vocabulary, and the limits and batch sizes of the stages.
from quillspark.functions.chat import FORMAT_INSTRUCTION
from quillspark.functions.text import WHITESPACE
from quillspark.functions.tokens import ADDED_TOKENS

VOCABULARY_SIZE = 128_000
DOCUMENT_TOKENS = 4096
SFT_TOKENS = 16384
SHARD_ROWS = 1000
UNKNOWN = "<unk>"
RESERVED = [
    UNKNOWN,
    "<|begin_of_text|>",
    "<|start_header_id|>",
    "<|end_header_id|>",
    "<|eot_id|>",
    "<|end_of_text|>",
    "<|finetune_right_pad_id|>",
    "\n\n",
    "system",
    "user",
    "assistant",
]
SPECIAL = sorted([*RESERVED[1:7], *ADDED_TOKENS], key=len, reverse=True)

ORACLES: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
WS_RE = "[" + "".join(f"\\x{{{ord(c):04x}}}" for c in WHITESPACE) + "]"
NL = "chr(10)"


def strip(sql: str) -> str:
    return f"trim({sql}, {WS})"


# conversations and prompts


def header(role: str, gap: str) -> str:
    return f"'<|start_header_id|>' || {role} || '<|end_header_id|>' || {gap}"


def turn(role: str, content: str, gap: str = f"{NL} || {NL}", end: str = "<|eot_id|>") -> str:
    return f"{header(role, gap)} || {strip(content)} || '{end}'"


def chat(gap: str, end: str) -> str:
    return f"""
    SELECT conv_id,
      '<|begin_of_text|>' || string_agg({turn('role', 'text', gap, end)}, '' ORDER BY turn) AS text
    FROM conversations GROUP BY conv_id"""


ORACLES["chat_render"] = chat(f"{NL} || {NL}", "<|eot_id|>")
ORACLES["chat_render_draft"] = chat(NL, "<|end_of_text|>")

FORMAT = quoted(FORMAT_INSTRUCTION)
ORACLES["chat_render_generation"] = f"""
    SELECT item_id, '<|begin_of_text|>' || {turn("'system'", FORMAT)} || {turn("'user'", "text")}
      || {header("'assistant'", f"{NL} || {NL}")} AS text
    FROM benchmark"""

SFT = """
    SELECT doc_id, 'You read ' || lang || ' text.' AS system_prompt,
      'Name the source among ' || source AS instruction, text AS reference,
      'length ' || n_chars AS modified_reasoning,
      CASE WHEN lang <> 'fr' THEN source END AS formatted_label
    FROM documents"""


def sft_text(label: str, gap: str, end: str) -> str:
    target = (
        f"'<think>' || modified_reasoning || '</think>' || {NL}"
        f" || '<answer>' || {label} || '</answer>'"
    )
    return (
        f"'<|begin_of_text|>' || {turn(quoted('system'), 'system_prompt', gap, end)}"
        f" || {turn(quoted('user'), f'instruction || {NL} || reference', gap, end)}"
        f" || {turn(quoted('assistant'), target, gap, end)}"
    )


SFT_TEXT = f"""
    SELECT doc_id, {sft_text("formatted_label", f"{NL} || {NL}", "<|eot_id|>")} AS text
    FROM ({SFT}) WHERE formatted_label IS NOT NULL"""
ORACLES["sft_text"] = SFT_TEXT
ORACLES["sft_text_compat"] = f"""
    SELECT doc_id, {sft_text("coalesce(formatted_label, 'None')", NL, "<|end_of_text|>")} AS text
    FROM ({SFT})"""
ORACLES["sft_rejected"] = f"""
    SELECT doc_id, system_prompt, modified_reasoning, formatted_label
    FROM ({SFT}) WHERE formatted_label IS NULL"""
ORACLES["target_block"] = f"""
    SELECT doc_id, '<think>' || {NL} || reference || {NL} || '</think>' || {NL} || '<answer>'
      || {NL} || modified_reasoning || {NL} || '</answer>' || {NL} AS target
    FROM ({SFT})"""
QA_ANSWER = "format('{:,}', item_id * 1000)"
ORACLES["rl_prompt"] = f"""
    SELECT item_id, text AS question, {QA_ANSWER} AS answer,
      'system' AS first_role, {FORMAT} AS first_content,
      'user' AS second_role, text AS second_content
    FROM benchmark"""

# answers and rewards

BLOCK = (
    f"'<think>' || {NL} || r || {NL} || '</think>' || {NL} || '<answer>' || {NL} || a || {NL}"
    " || '</answer>'"
)
ROLLOUTS = f"""
    SELECT conv_id AS prompt_id, turn AS gen_id, a AS answer,
      CASE (conv_id * 7 + turn) % 8
        WHEN 0 THEN {BLOCK} || {NL}
        WHEN 1 THEN {BLOCK}
        WHEN 2 THEN '<think>' || r || '</think>' || {NL} || '<answer>' || a || '</answer>'
        WHEN 3 THEN {BLOCK} || {NL} || text
        WHEN 4 THEN text
        WHEN 5 THEN '<answer>' || a || '</answer> ' || text || ' <answer>' || a
        WHEN 6 THEN '-1,00' || a || '.5'
        ELSE '' END AS t
    FROM (SELECT *, replace(text, {NL}, ' ') AS r, CAST(turn AS VARCHAR) AS a FROM conversations)"""

EXTRACTED = strip("string_split(string_split(t, '<answer>')[-1], '</answer>')[1]")
RUN = r"[0-9]+(?:_[0-9]+)*"
NUMBER = (
    rf"^[+-]?(?:(?:{RUN}\.?(?:{RUN})?|\.{RUN})(?:[eE][+-]?{RUN})?|(?i:inf|infinity|nan))$"
)
WITHOUT_COMMAS = strip(f"replace({EXTRACTED}, ',', '')")


def worth(condition: str, value: float) -> str:
    return f"CASE WHEN {condition} THEN {value}::DOUBLE ELSE 0.0::DOUBLE END"


NUMERIC = worth(f"regexp_matches({WITHOUT_COMMAS}, '{NUMBER}')", 0.5)
DIGITS = worth(f"regexp_matches({EXTRACTED}, '^[0-9]+$')", 0.5)


def once(tag: str) -> str:
    return f"len(string_split(t, {tag})) = 2"


def tail(tag: str) -> str:
    return f"length(string_split(t, {tag})[-1])"


XML = f"""(
    CASE WHEN {once(f"'<think>' || {NL}")} THEN 0.125::DOUBLE ELSE 0 END
    + CASE WHEN {once(f"{NL} || '</think>' || {NL}")} THEN 0.125::DOUBLE ELSE 0 END
    + CASE WHEN {once(f"{NL} || '<answer>' || {NL}")}
        THEN 0.125::DOUBLE - {tail(f"{NL} || '</answer>' || {NL}")} * 0.001::DOUBLE ELSE 0 END
    + CASE WHEN {once(f"{NL} || '</answer>'")}
        THEN 0.125::DOUBLE - ({tail(f"{NL} || '</answer>'")} - 1) * 0.001::DOUBLE ELSE 0 END)"""
SOFT = worth(f"regexp_matches(t, '^<think>.*?</think>{WS_RE}*<answer>.*?</answer>')", 0.5)
STRICT = worth(
    r"regexp_matches(t, '^<think>\n.*?\n</think>\n<answer>\n.*?\n</answer>\n\n?$')", 0.5
)
CORRECT = worth(f"{EXTRACTED} = answer", 2.0)


def rollout_query(columns: str) -> str:
    return f"SELECT prompt_id, gen_id, {columns} FROM ({ROLLOUTS})"


ORACLES["extract_answer"] = rollout_query(f"{EXTRACTED} AS extracted")
ORACLES["hash_answer"] = f"""
    SELECT doc_id,
      CASE WHEN contains(t, '####') THEN {strip("string_split(t, '####')[2]")} END AS answer
    FROM (SELECT doc_id, CASE WHEN lang <> 'fr' THEN text || ' #### ' || source || {NL}
                              ELSE text END AS t FROM documents)"""
ORACLES["reward_numeric"] = rollout_query(f"{NUMERIC} AS numeric")
ORACLES["reward_digits"] = rollout_query(f"{DIGITS} AS digits")
ORACLES["reward_xmlcount"] = rollout_query(f"round({XML}, 6) AS xmlcount")
ORACLES["reward_soft"] = rollout_query(f"{SOFT} AS soft_format")
ORACLES["reward_strict"] = rollout_query(f"{STRICT} AS strict_format")
ORACLES["reward_correct"] = rollout_query(f"{CORRECT} AS correctness")
REWARDS = rollout_query(
    f"{XML} AS xmlcount, {SOFT} AS soft_format, {STRICT} AS strict_format, "
    f"{NUMERIC} AS numeric, {CORRECT} AS correctness"
)
TOTAL = "xmlcount + soft_format + strict_format + numeric + correctness"
ORACLES["reward_total"] = f"""
    SELECT prompt_id, gen_id, round(xmlcount, 6) AS xmlcount, soft_format, strict_format, numeric,
      correctness, round({TOTAL}, 6) AS reward
    FROM ({REWARDS})"""
ORACLES["reward_custom"] = f"""
    SELECT prompt_id, gen_id, round(brevity, 6) AS brevity, mentions, numeric,
      round(10 * brevity + mentions + numeric, 6) AS reward
    FROM (SELECT prompt_id, gen_id, 1.0::DOUBLE / (1 + length(t) + length(answer)) AS brevity,
            CASE WHEN contains(t, answer) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS mentions,
            {NUMERIC} AS numeric
          FROM ({ROLLOUTS}))"""
ORACLES["rollout_fanout"] = f"""
    SELECT item_id, CAST(unnest(range(6)) AS INTEGER) AS gen_id, {QA_ANSWER} AS answer
    FROM benchmark"""
ORACLES["group_advantage"] = f"""
    SELECT prompt_id, gen_id, round(reward, 6) AS reward,
      round((reward - avg(reward) OVER g) / (stddev_samp(reward) OVER g + 1e-4), 6) AS advantage
    FROM (SELECT prompt_id, gen_id, {TOTAL} AS reward FROM ({REWARDS}))
    WINDOW g AS (PARTITION BY prompt_id)"""
ORACLES["inspect_rollouts"] = f"""
    SELECT 'conversation ' || prompt_id AS question, answer, t AS response, {EXTRACTED} AS extracted
    FROM ({ROLLOUTS}) WHERE gen_id = 0"""

# vocabulary and tokens

ESCAPED = "|".join(t.replace("|", r"\|") for t in SPECIAL)
PATTERN = quoted(r"[^ \n<]+| |\n\n|\n|" + ESCAPED + "|<")


def values(tokens: list[str]) -> str:
    return ", ".join(f"({i}, {quoted(t)})" for i, t in enumerate(tokens))


def vocabulary(limit: str, added: list[str] = ADDED_TOKENS) -> str:
    return f"""
    reserved(id, token) AS (VALUES {values(RESERVED)}),
    added(place, token) AS (VALUES {values(added)}),
    counts AS (
      SELECT token, count(*) AS n
      FROM (SELECT unnest(regexp_extract_all(text, {PATTERN})) AS token FROM documents)
      WHERE token NOT IN (SELECT token FROM reserved) GROUP BY token),
    ranked AS (
      SELECT token, row_number() OVER (ORDER BY n DESC, token) AS place FROM counts
      ORDER BY place {limit}),
    base AS (
      SELECT id, token FROM reserved
      UNION ALL SELECT place + {len(RESERVED) - 1}, token FROM ranked),
    vocab AS (
      SELECT CAST(id AS INTEGER) AS id, token FROM base
      UNION ALL
      SELECT CAST((SELECT max(id) FROM base) + row_number() OVER (ORDER BY place) AS INTEGER), token
      FROM added WHERE token NOT IN (SELECT token FROM base))"""


VOCAB = vocabulary(f"LIMIT {VOCABULARY_SIZE}")
WHOLE_VOCAB = vocabulary("")


def encoded(
    source: str,
    limit: int | None,
    first: str = "[]",
    vocab: str = VOCAB,
    words: str = f"regexp_extract_all(text, {PATTERN})",
) -> str:
    words = f"list_concat({first}, {words})"
    if limit is not None:
        words = f"list_slice({words}, 1, {limit})"
    return f"""
    {vocab},
    source AS ({source}),
    word_lists AS (SELECT doc_id, {words} AS w FROM source),
    placed AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM word_lists),
    found AS (
      SELECT doc_id, list(coalesce(id, 0) ORDER BY pos) AS ids
      FROM placed LEFT JOIN vocab USING (token) GROUP BY doc_id),
    encoded AS MATERIALIZED (
      SELECT doc_id, coalesce(ids, CAST([] AS INTEGER[])) AS ids
      FROM source LEFT JOIN found USING (doc_id))"""


DOCUMENTS = encoded("SELECT doc_id, text FROM documents", DOCUMENT_TOKENS)
WHOLE = encoded("SELECT doc_id, text FROM documents", None)


def joined(sql: str) -> str:
    return f"array_to_string({sql}, ' ')"


def ones(sql: str) -> str:
    return f"list_transform({sql}, lambda x: 1)"


def padded(sql: str, fill: str, length: str) -> str:
    missing = f"list_transform(range({length} - len({sql})), lambda x: {fill})"
    return f"list_concat(list_slice({sql}, 1, {length}), {missing})"


TOKENS = f"{joined('ids')} AS ids, {joined(ones('ids'))} AS mask"
ENCODED = f"WITH {DOCUMENTS} SELECT doc_id, {TOKENS} FROM encoded"

ORACLES["vocabulary"] = f"WITH {VOCAB} SELECT token, id FROM vocab"
ORACLES["pad_token"] = f"""
    WITH {VOCAB}
    SELECT 'explicit' AS rule, id AS pad_id FROM vocab WHERE token = ' '
    UNION ALL SELECT 'right_pad', id FROM vocab WHERE token = '<|finetune_right_pad_id|>'
    UNION ALL SELECT 'end_of_text', id FROM vocab WHERE token = '<|end_of_text|>'"""
ORACLES["encode_truncate"] = ENCODED
ORACLES["encode_joined"] = ENCODED
ORACLES["encode_with_bos"] = f"""
    WITH {encoded("SELECT doc_id, text FROM documents", DOCUMENT_TOKENS, "['<|begin_of_text|>']")}
    SELECT doc_id, {TOKENS} FROM encoded"""
ORACLES["token_files"] = ENCODED
REGISTERED = sorted(["the", "tion", "on the", "ing th", "e", "und d", "ñ"], key=len, reverse=True)
# what stands between registered tokens is split as before; every second piece is a token
MARKED = f"regexp_replace(text, '({'|'.join(REGISTERED)})', chr(1) || '\\1' || chr(1), 'g')"
SPLIT = f"""flatten(list_transform(string_split({MARKED}, chr(1)),
    lambda p, i: CASE WHEN i % 2 = 0 THEN [p] ELSE regexp_extract_all(p, {PATTERN}) END))"""
NEW = ["the", "tion", "on the", "ing th", "e", "und d", "ñ"]
ORACLES["encode_registered"] = f"""
    WITH {encoded("SELECT doc_id, text FROM documents", DOCUMENT_TOKENS,
                  vocab=vocabulary(f"LIMIT {VOCABULARY_SIZE}", ADDED_TOKENS + NEW), words=SPLIT)}
    SELECT doc_id, {TOKENS} FROM encoded"""
ORACLES["encode_bytes"] = f"""
    WITH {vocabulary("LIMIT 500")},
    first_byte AS (SELECT max(id) + 1 AS b FROM vocab),
    placed AS (
      SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, regexp_extract_all(text, {PATTERN}) AS w FROM documents)),
    spelled AS (
      SELECT doc_id, pos, CASE WHEN id IS NOT NULL THEN [id] ELSE list_transform(
        range(strlen(token)),
        lambda i: CAST(b + CAST('0x' || substr(hex(token), 2 * i + 1, 2) AS INTEGER) AS INTEGER)) END AS part
      FROM placed LEFT JOIN vocab USING (token), first_byte),
    encoded AS MATERIALIZED (
      SELECT doc_id, list_slice(flatten(list(part ORDER BY pos)), 1, {DOCUMENT_TOKENS}) AS ids
      FROM spelled GROUP BY doc_id)
    SELECT doc_id, coalesce({joined('ids')}, '') AS ids, coalesce({joined(ones('ids'))}, '') AS mask
    FROM documents LEFT JOIN encoded USING (doc_id)"""
ORACLES["decode_bytes"] = "SELECT doc_id, text FROM documents"
DECODED = "SELECT doc_id, text FROM documents"
ORACLES["decode_text"] = DECODED
ORACLES["decode_joined"] = DECODED
FIRST_LINE = f"regexp_extract_all(string_split(text, {NL})[1], {PATTERN})"
ORACLES["completion_slice"] = f"""
    WITH {WHOLE}
    SELECT doc_id, {joined(f"list_slice(ids, len({FIRST_LINE}) + 1, len(ids))")} AS ids
    FROM encoded JOIN source USING (doc_id)"""
ORACLES["tensor_columns"] = f"WITH {WHOLE} SELECT {TOKENS} FROM encoded"

# labels, padding, batches

ORACLES["labels_causal"] = f"""
    WITH {DOCUMENTS},
    newline AS (SELECT id AS newline_id FROM vocab WHERE token = {NL})
    SELECT doc_id, {joined('ids')} AS labels,
      {joined('list_transform(ids, lambda x: CASE WHEN x = newline_id THEN -100 ELSE x END)')}
        AS labels_by_id
    FROM encoded, newline"""
ORACLES["labels_response"] = f"""
    WITH {encoded(SFT_TEXT, SFT_TOKENS)},
    marker AS (
      SELECT [(SELECT id FROM vocab WHERE token = '<|start_header_id|>'),
              (SELECT id FROM vocab WHERE token = 'assistant'),
              (SELECT id FROM vocab WHERE token = '<|end_header_id|>'),
              (SELECT id FROM vocab WHERE token = {NL} || {NL})] AS m),
    ends AS (
      SELECT doc_id, ids,
        coalesce(list_max(list_filter(range(1, greatest(2, len(ids) - 2)),
                 lambda j: list_slice(ids, j, j + 3) = m)) + 3, len(ids)) AS e
      FROM encoded, marker),
    labelled AS (
      SELECT doc_id,
        list_transform(ids, lambda x, i: CASE WHEN i <= e THEN -100 ELSE x END) AS labels
      FROM ends)
    SELECT doc_id, {joined('labels')} AS labels,
      CAST(len(list_filter(labels, lambda x: x <> -100)) AS INTEGER) AS supervised
    FROM labelled"""


CHAT_IDS = f"""
    {VOCAB},
    source AS ({ORACLES["chat_render"]}),
    placed AS (
      SELECT conv_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
      FROM (SELECT conv_id, regexp_extract_all(text, {PATTERN}) AS w FROM source)),
    encoded AS MATERIALIZED (
      SELECT conv_id, list(coalesce(id, 0) ORDER BY pos) AS ids
      FROM placed LEFT JOIN vocab USING (token) GROUP BY conv_id),
    marker AS (
      SELECT [(SELECT id FROM vocab WHERE token = '<|start_header_id|>'),
              (SELECT id FROM vocab WHERE token = 'assistant'),
              (SELECT id FROM vocab WHERE token = '<|end_header_id|>'),
              (SELECT id FROM vocab WHERE token = {NL} || {NL})] AS m,
             (SELECT id FROM vocab WHERE token = '<|eot_id|>') AS eot),
    places AS MATERIALIZED (
      SELECT conv_id, ids,
        list_filter(range(1, greatest(2, len(ids) - 2)), lambda j: list_slice(ids, j, j + 3) = m) AS heads,
        list_filter(range(1, len(ids) + 1), lambda j: ids[j] = eot) AS ends
      FROM encoded, marker),
    spans AS MATERIALIZED (
      SELECT conv_id, ids, list_transform(heads, lambda h: [h + 4,
        coalesce(list_min(list_filter(ends, lambda e: e >= h + 4)), len(ids))]) AS spans,
        coalesce(list_max(heads) + 3, len(ids)) AS last_end
      FROM places),
    labels AS MATERIALIZED (
      SELECT conv_id,
        list_transform(ids, lambda x, i: CASE WHEN len(list_filter(spans, lambda s: i >= s[1] AND i <= s[2])) > 0
          THEN x ELSE -100 END) AS turns,
        list_transform(ids, lambda x, i: CASE WHEN i <= last_end THEN -100 ELSE x END) AS last
      FROM spans)"""
ORACLES["labels_all_turns"] = f"""
    WITH {CHAT_IDS}
    SELECT conv_id, {joined('turns')} AS labels,
      CAST(len(list_filter(turns, lambda x: x <> -100)) AS INTEGER) AS supervised
    FROM labels"""
ORACLES["supervision"] = f"""
    WITH {CHAT_IDS}
    SELECT rule, count(*) AS rows, count(*) FILTER (n = 0) AS unsupervised, CAST(sum(n) AS BIGINT) AS tokens
    FROM (SELECT 'last' AS rule, len(list_filter(last, lambda x: x <> -100)) AS n FROM labels
          UNION ALL SELECT 'turns', len(list_filter(turns, lambda x: x <> -100)) FROM labels)
    GROUP BY rule"""


def permuted(source: str, seed: int, epoch: int, rounds: int = 8, prime: int = 2**31 - 1) -> str:
    """Numbers of ``source`` (number, value) under eight Feistel rounds over the grid ``cells``."""

    def mixed(x: str, r: int) -> str:
        digest = f"md5('{seed}:{epoch}:{r}')"
        a, b = (f"CAST('0x' || substr({digest}, {at}, 7) AS BIGINT)" for at in (1, 8))
        base = f"(({x} + {a}) % {prime})"
        return f"(((({base} * {base} + {b}) % {prime}) * {base}) % {prime})"

    rows = f"SELECT number, value % wide AS x, value // wide AS y, wide, high FROM {source}, cells"
    for r in range(rounds):
        x, y = ("x", f"(y + {mixed('x', r)}) % high") if r % 2 else (f"(x + {mixed('y', r)}) % wide", "y")
        rows = f"SELECT number, {x} AS x, {y} AS y, wide, high FROM ({rows})"
    return f"SELECT number, y * wide + x AS value FROM ({rows})"


ORACLES["epoch_deal"] = f"""
    WITH RECURSIVE cells AS (
      SELECT n, wide, CAST(ceil(n / wide) AS BIGINT) AS high
      FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS wide FROM documents)),
    numbers AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS number FROM documents),
    walk AS (
      {permuted('(SELECT number, number AS value FROM numbers)', 11, 2)}
      UNION ALL
      {permuted('(SELECT number, value FROM walk WHERE value >= (SELECT n FROM cells))', 11, 2)})
    SELECT doc_id, value AS position, CAST(floor(value / 2) % 8 AS INTEGER) AS device,
      CAST(floor(value / 16) AS INTEGER) AS batch, CAST(floor(value / 128) AS INTEGER) AS step
    FROM numbers JOIN walk USING (number) WHERE value < (SELECT n FROM cells)"""
ORACLES["length_batches"] = f"""
    WITH {DOCUMENTS},
    lengths AS (SELECT doc_id, len(ids) AS tokens FROM encoded),
    sorted AS (SELECT list(tokens ORDER BY tokens) AS l FROM lengths),
    bounds AS (
      SELECT list_distinct(list_transform(range(1, 64),
        lambda i: l[CAST(greatest(1, ceil(i * len(l) / 64)) AS BIGINT)])) AS limits FROM sorted),
    bucketed AS (
      SELECT doc_id, tokens,
        CAST(len(list_filter(limits, lambda b: b < tokens)) AS INTEGER) AS bucket,
        md5('11' || chr(31) || '0' || chr(31) || doc_id) AS place
      FROM lengths, bounds),
    dealt AS (
      SELECT *, CAST(floor((row_number() OVER (ORDER BY bucket, place, doc_id) - 1) / 16) AS BIGINT) AS batch
      FROM bucketed)
    SELECT doc_id, bucket, batch, CAST(tokens AS INTEGER) AS tokens,
      CAST(max(tokens) OVER (PARTITION BY batch) AS INTEGER) AS length
    FROM dealt"""


def numbered(
    source: str, columns: str = "", key: str = "doc_id", size: int = 2, counted: str | None = None
) -> str:
    digits = f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"
    shards = f"(SELECT greatest(ceil(count(*) / {SHARD_ROWS}), 1) FROM {counted or source})"
    return f"""
      SELECT {key}{columns}, shard,
        CAST(floor((row_number() OVER (PARTITION BY shard ORDER BY {key}) - 1) / {size}) AS INTEGER)
          AS batch
      FROM (SELECT *, CAST({digits} % CAST({shards} AS BIGINT) AS INTEGER) AS shard FROM {source})"""


ORACLES["batch_assign"] = f"""
    SELECT doc_id, shard, batch, CAST(floor(batch / 8) AS INTEGER) AS step
    FROM ({numbered('documents')})"""
ORACLES["batch_pad"] = f"""
    WITH {DOCUMENTS},
    numbered AS ({numbered('encoded', ', ids')}),
    sized AS (
      SELECT *, CAST(max(len(ids)) OVER (PARTITION BY shard, batch) AS INTEGER) AS length
      FROM numbered),
    pad AS (SELECT id AS pad_id FROM vocab WHERE token = '<|finetune_right_pad_id|>')
    SELECT doc_id, shard, batch, length, {joined(padded('ids', 'pad_id', 'length'))} AS ids,
      {joined(padded(ones('ids'), '0', 'length'))} AS mask,
      {joined(padded('ids', '-100', 'length'))} AS labels
    FROM sized, pad"""
ORACLES["fixed_pad"] = f"""
    WITH {DOCUMENTS},
    pad AS (SELECT id AS pad_id FROM vocab WHERE token = '<|finetune_right_pad_id|>')
    SELECT doc_id, {joined(padded('ids', 'pad_id', str(DOCUMENT_TOKENS)))} AS ids,
      {joined(padded(ones('ids'), '0', str(DOCUMENT_TOKENS)))} AS mask
    FROM encoded, pad"""
ORACLES["length_budget"] = f"""
    WITH {WHOLE}
    SELECT doc_id, {joined('list_slice(ids, greatest(1, len(ids) - 511), len(ids))')} AS prompt,
      {joined('list_slice(ids, 1, 3584)')} AS completion
    FROM encoded"""

ORACLES["sft_batches"] = f"""
    WITH {encoded(SFT_TEXT, SFT_TOKENS)},
    marker AS (
      SELECT [(SELECT id FROM vocab WHERE token = '<|start_header_id|>'),
              (SELECT id FROM vocab WHERE token = 'assistant'),
              (SELECT id FROM vocab WHERE token = '<|end_header_id|>'),
              (SELECT id FROM vocab WHERE token = {NL} || {NL})] AS m),
    ends AS MATERIALIZED (
      SELECT text, ids,
        coalesce(list_max(list_filter(range(1, greatest(2, len(ids) - 2)),
                 lambda j: list_slice(ids, j, j + 3) = m)) + 3, len(ids)) AS e
      FROM encoded JOIN source USING (doc_id), marker),
    labelled AS MATERIALIZED (
      SELECT text, ids,
        list_transform(ids, lambda x, i: CASE WHEN i <= e THEN -100 ELSE x END) AS labels
      FROM ends),
    numbered AS ({numbered('labelled', ', ids, labels', 'text', counted='source')}),
    sized AS (
      SELECT *, CAST(max(len(ids)) OVER (PARTITION BY shard, batch) AS INTEGER) AS length
      FROM numbered),
    pad AS (SELECT id AS pad_id FROM vocab WHERE token = '<|finetune_right_pad_id|>')
    SELECT text, shard, batch, CAST(floor(batch / 4) AS INTEGER) AS step, length,
      {joined(padded('ids', 'pad_id', 'length'))} AS ids,
      {joined(padded(ones('ids'), '0', 'length'))} AS mask,
      {joined(padded('labels', '-100', 'length'))} AS labels
    FROM sized, pad"""

# callbacks and inference

LAST_WORDS = "list_slice(w, greatest(1, len(w) - 511), len(w))"
ORACLES["tokens_predict"] = f"""
    SELECT doc_id, array_to_string(list_slice(list_reverse({LAST_WORDS}), 1, 16), '') AS response
    FROM (SELECT doc_id, regexp_extract_all(text, {PATTERN}) AS w FROM documents)"""

ORACLES["map_callback"] = """
    SELECT doc_id, len(string_split(text, ' ')) AS n_words, replace(text, 'e', 'E') AS shouted
    FROM documents"""
ORACLES["prompts_filter"] = f"""
    SELECT doc_id, {strip('text')} AS value FROM documents
    WHERE lang <> 'fr' AND length({strip('text')}) > 0"""
PROMPT = f"""CASE WHEN role IN ('user', 'system') THEN text
    ELSE '<|begin_of_text|>' || {turn("'system'", "'turn ' || turn")} || {turn("'user'", "text")}
      || {header("'assistant'", f"{NL} || {NL}")} END"""
ORACLES["prompts_render"] = f"""
    SELECT {PROMPT} AS text, CAST(NULL AS VARCHAR) AS error FROM conversations"""
PREDICTED = f"""
    SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn,
      CASE WHEN role IN ('user', 'system') THEN text ELSE 'unused' END AS prompt,
      {PROMPT} || '|1024' AS response,
      CASE WHEN role IN ('user', 'system') THEN 'conv_id,prompt,response,turn'
           ELSE 'conv_id,messages,prompt,response,turn' END AS keys
    FROM conversations"""
ORACLES["prompts_predict"] = PREDICTED
ORACLES["prompt_files"] = PREDICTED
ORACLES["prompt_folder"] = PREDICTED
ORACLES["prompts_ordered"] = f"""
    SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS number, CAST(conv_id AS VARCHAR) AS conv_id,
      CAST(turn AS VARCHAR) AS turn, {PROMPT} || '|1024' AS response
    FROM conversations"""
ORACLES["advantage_stream"] = f"SELECT *, true AS complete FROM ({ORACLES['group_advantage']})"
ORACLES["prompts_quarantine"] = """
    SELECT conv_id, turn,
      CASE WHEN role = 'system' THEN 'not a JSON object'
           WHEN turn = 0 THEN 'neither messages nor prompt'
           ELSE 'unusable messages' END AS error
    FROM conversations WHERE role <> 'user' OR turn = 0"""

# files

ORACLES["corpus_mixed_files"] = "SELECT text FROM documents"
# what a record's other fields must read after its response was replaced
NUMBERS = (
    '{"n": [1.50, 1e400, -0, NaN, -Infinity, 123456789012345678901234567890123456789012345]'
)
ORACLES["corpus_files"] = "SELECT text FROM documents"
ORACLES["corpus_line_lists"] = "SELECT text FROM documents"
ORACLES["corpus_list_files"] = "SELECT text FROM documents"
ORACLES["sft_files"] = f"""
    SELECT system_prompt, instruction, reference, modified_reasoning, formatted_label FROM ({SFT})"""
ORACLES["qa_files"] = f"""
    SELECT split, text AS question, {QA_ANSWER} AS answer
    FROM benchmark, (VALUES ('train'), ('test')) s(split)"""
ORACLES["prompts_with_responses"] = f"""
    SELECT {quoted(NUMBERS)} AS head,
      text AS prompt, text || '|1024' AS response
    FROM conversations WHERE text IS NOT NULL"""
