"""DuckDB statements for the training-data queries that SQL can express."""

from __future__ import annotations

from quillspark.llm.secret_scan import BASE_RULES, RULES, Rule

LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
# the control strings that a formatted text escapes
CONTROL = r"</?s>|\[/?INST\]|\[/?SYS\]|\[/?ROLE\]"


def escaped_length(text: str) -> str:
    """Characters of a text with its backslashes doubled and one more in each control string."""
    marks = f"len(regexp_extract_all({text}, '{CONTROL}'))"
    return f"(length({text}) + length({text}) - length(replace({text}, chr(92), '')) + {marks})"


TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rule_spans(number: int, rule: Rule) -> str:
    """Spans of one rule: every match is put between two marks, the pieces give the offsets."""
    pattern = quoted(rule.pattern)
    return f"""
        SELECT doc_id, {number} AS number, {quoted(rule.kind)} AS kind, start, start + size AS stop
        FROM (
            SELECT doc_id, i, strpos(piece, chr(2)) - 1 AS size, split_part(piece, chr(2), 1) AS hit,
                   sum(length(replace(piece, chr(2), ''))) OVER (PARTITION BY doc_id ORDER BY i)
                       - length(replace(piece, chr(2), '')) AS start
            FROM (
                SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i
                FROM (
                    SELECT doc_id, string_split(regexp_replace(
                        text, {pattern}, chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS pieces
                    FROM texts WHERE regexp_matches(text, {pattern})
                )
            )
        )
        WHERE i > 1 AND length(regexp_extract(hit, {pattern}, {rule.group})) >= {rule.least}
    """


def listed(condition: str) -> str:
    return f"""coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number)
        FILTER ({condition}), '')"""


LLM_ORACLES = {
    "op2_chat_spans": f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        sized AS (
            SELECT *, {escaped_length('text')} + CASE role
                WHEN 'user' THEN length('<s>[INST]  [/INST]')
                WHEN 'assistant' THEN length('  </s>')
                WHEN 'system' THEN length('[SYS]  [/SYS]')
                ELSE length('[ROLE][/ROLE]  </s>') + {escaped_length('role')} END AS size
            FROM turns
        )
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                   AS turns_sha256,
               CAST(sum(CASE role WHEN 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
                   AS loss_chars,
               sha256(string_agg(CASE role WHEN 'assistant' THEN text ELSE '' END, ''
                                 ORDER BY turn, role, text)) AS loss_sha256,
               CAST(sum(size) AS BIGINT) AS formatted_chars,
               CAST(0 AS BIGINT) AS rewritten
        FROM sized
        GROUP BY conv_id
    """,
    "op7_near_dedup": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(
                list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
            FROM words
        ),
        items AS (SELECT doc_id, unnest(s) AS item, len(s) AS n FROM sets),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n + b.n) AS n
            FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id
        ),
        links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (n - c)),
        either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM sets
            UNION
            SELECT e.b, r.other FROM reached r JOIN either e ON e.a = r.doc_id
        ),
        components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
               doc_id = component_id AS kept
        FROM sets JOIN components USING (doc_id)
    """,
    "op5_exact_dedup": f"""
        WITH texts AS (
            SELECT doc_id, {LOWER} AS text FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(text) AS text_sha256
        FROM texts
        WINDOW same AS (PARTITION BY text)
    """,
    "op11_ranked_search": f"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all({LOWER}, '{TERMS}')) AS term FROM documents
        ),
        postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sizes),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
        ),
        items AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER}, '{TERMS}')) AS term FROM benchmark
        ),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) //
                (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l)))) AS BIGINT) AS score
            FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
            GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scored WHERE score > 0
        )
        WHERE rank <= 50
    """,
    "op12_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
        grams AS (
            {" UNION ALL ".join(
                f"""SELECT lang, {m} AS m, unnest(list_transform(range(1, len(w) - {m - 2}),
                    lambda i: array_to_string(list_slice(w, i, i + {m - 1}), ' '))) AS phrase FROM words"""
                for m in (1, 2, 3, 4)
            )}
        ),
        counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
        sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang),
        frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30),
        cuts AS (
            SELECT lang, m, phrase, f, k, array_to_string(list_slice(w, 1, k), ' ') AS first,
                   array_to_string(list_slice(w, k + 1, m), ' ') AS rest
            FROM frequent, (VALUES (1), (2), (3)) AS c(k) WHERE k < m
        ),
        scored AS (
            SELECT c.lang, c.m, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r,
                   CAST((2000000::HUGEINT * c.f) // (x.f + y.f) AS BIGINT) AS score
            FROM cuts c
            JOIN counts x ON x.lang = c.lang AND x.phrase = c.first
            JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
        ),
        lowest AS (
            SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
        ),
        inner_phrases AS (
            SELECT lang, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase, max(f) AS longer
            FROM frequent, (VALUES (2), (3)) AS s(size), (VALUES (1), (2), (3)) AS p(i)
            WHERE size < m AND i + size - 1 <= m
            GROUP BY ALL
        )
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM (
            SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, encode(o.phrase)) AS rank
            FROM lowest o LEFT JOIN inner_phrases i ON i.lang = o.lang AND i.phrase = o.phrase
            WHERE place = 1 AND (longer IS NULL OR 100 * longer < 80 * a)
        )
        JOIN sizes USING (lang)
        WHERE rank <= 2000
    """,
    "op13_secret_scan": f"""
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS text
            FROM documents
        ),
        spans AS ({" UNION ALL ".join(rule_spans(i, rule) for i, rule in enumerate(RULES))})
        SELECT doc_id,
               {", ".join(
                   f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE_RULES
               )},
               sha256({listed(f"number < {len(BASE_RULES)}")}) AS base_sha256,
               {listed("true")} AS spans
        FROM texts LEFT JOIN spans USING (doc_id)
        GROUP BY doc_id
    """,
}
