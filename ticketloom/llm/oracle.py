"""DuckDB SQL of the corpus operators that SQL can express."""

_LEVEL = r"length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g'))"
_NORMAL = r"trim(regexp_replace(lower({}), '[ \t\r\f]+', ' ', 'g'), ' ')"
_CONTENT = _NORMAL.format(r"regexp_replace(line, '^(?:[ \t]*>)+', '')")

_OP3 = rf"""
WITH RECURSIVE message AS (
    SELECT row_number() OVER () AS id, conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), line AS (
    SELECT id, conv_id, turn, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS nth FROM message
), levelled AS (
    SELECT id, conv_id, turn, nth, line, {_LEVEL} AS level, {_CONTENT} AS content FROM line
), numbered AS (
    SELECT *, sum(CASE WHEN level = before THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY nth) AS passage
    FROM (SELECT *, lag(level) OVER (PARTITION BY id ORDER BY nth) AS before FROM levelled)
), quoted AS (
    SELECT id, conv_id, turn, passage, level, string_agg(content, ' ' ORDER BY nth) AS whole, list(content) AS lines
    FROM numbered WHERE level > 0 AND content <> '' GROUP BY ALL
), asked AS (
    SELECT id, conv_id, turn, passage, level, unnest(list_distinct(list_append(lines, whole))) AS unit FROM quoted
), own AS (
    SELECT id, conv_id, turn, string_agg(line, chr(10) ORDER BY nth) AS reply_text,
           string_agg(content, ' ' ORDER BY nth) FILTER (content <> '') AS whole,
           string_agg(content, chr(10) ORDER BY nth) AS joined
    FROM levelled WHERE level = 0 GROUP BY ALL
), written AS (
    SELECT conv_id, unit, min(turn) AS original FROM (
        SELECT conv_id, turn, whole AS unit FROM own
        UNION ALL SELECT conv_id, turn, unnest(string_split(joined, chr(10))) FROM own
        UNION ALL SELECT conv_id, turn, trim(replace(p, chr(10), ' '), ' ') FROM (
            SELECT conv_id, turn, unnest(string_split(regexp_replace(joined, '\n\n+', chr(10) || chr(10), 'g'), chr(10) || chr(10))) AS p
            FROM own)
    ) WHERE unit <> '' GROUP BY ALL
), linked AS (
    SELECT id, conv_id, turn, passage, level, arg_max(original, (length(unit), original)) AS original
    FROM asked JOIN written USING (conv_id, unit) WHERE original < turn GROUP BY ALL
), reply AS (
    SELECT conv_id, turn, arg_max(original, (-level, original)) AS reply_to FROM linked GROUP BY ALL
), thread AS (
    SELECT conv_id, turn, reply_to AS thread_turn, 1 AS depth FROM reply
    UNION ALL
    SELECT t.conv_id, t.turn, r.reply_to, t.depth + 1
    FROM thread t JOIN reply r ON r.conv_id = t.conv_id AND r.turn = t.thread_turn
), root AS (
    SELECT conv_id, turn, arg_max(thread_turn, depth) AS thread_turn, max(depth) AS depth FROM thread GROUP BY ALL
), q AS (SELECT id, count(*) AS n FROM quoted GROUP BY id), l AS (SELECT id, count(*) AS n FROM linked GROUP BY id)
SELECT m.conv_id, m.turn, m.role, trim(coalesce(o.reply_text, ''), ' ') AS reply_text,
       coalesce(q.n, 0) AS quoted_passages, coalesce(l.n, 0) AS linked_passages, r.reply_to,
       coalesce(t.thread_turn, m.turn) AS thread_turn, CAST(coalesce(t.depth, 0) AS BIGINT) AS depth
FROM message m LEFT JOIN own o USING (id) LEFT JOIN q USING (id) LEFT JOIN l USING (id)
LEFT JOIN reply r ON r.conv_id = m.conv_id AND r.turn = m.turn
LEFT JOIN root t ON t.conv_id = m.conv_id AND t.turn = m.turn
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP11 = rf"""
WITH doc AS (
    SELECT row_number() OVER () AS id, doc_id, {_TERMS} AS terms, len(terms) AS n FROM documents
), total AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM doc WHERE n > 0
), asked AS (
    SELECT q, item_id, term, count(*) AS times
    FROM (SELECT row_number() OVER () AS q, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), posting AS (
    SELECT id, doc_id, n, term, count(*) AS tf FROM (SELECT id, doc_id, n, unnest(terms) AS term FROM doc)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM posting, total GROUP BY term
), scored AS (
    SELECT q, item_id, id, doc_id, CAST(sum(times * w *
        ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
    FROM asked JOIN weight USING (term) JOIN posting USING (term), total GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20
"""

_OP13 = r"""
WITH doc AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), label AS (
    SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
    FROM labels GROUP BY doc_id
), flagged AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
        'A': len(words) < 200,
        'B': 100 * len(list_distinct(words)) < 50 * len(words),
        'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
        'D': regexp_matches(text, '[#$%&*|]'),
        'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)
    } AS fails FROM doc LEFT JOIN label USING (doc_id)
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), filters AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letter a JOIN letter b ON b.l <> a.l JOIN letter c ON c.l NOT IN (a.l, b.l)
    JOIN letter d ON d.l NOT IN (a.l, b.l, c.l) JOIN letter e ON e.l NOT IN (a.l, b.l, c.l, d.l)
), steps AS (
    SELECT filter_order, unnest(range(1, 6)) AS step, substr(filter_order, step, 1) AS own,
           substr(filter_order, 1, step - 1) AS before FROM filters
), counted AS (
    SELECT part, good, toxic, fails, count(*) AS n,
           CASE WHEN fails.A THEN 'A' ELSE '' END || CASE WHEN fails.B THEN 'B' ELSE '' END ||
           CASE WHEN fails.C THEN 'C' ELSE '' END || CASE WHEN fails.D THEN 'D' ELSE '' END ||
           CASE WHEN fails.E THEN 'E' ELSE '' END AS failed FROM flagged GROUP BY ALL
), judged AS (
    SELECT *, contains(failed, own) AS now,
           before <> '' AND failed <> '' AND regexp_matches(failed, '[' || before || '_]') AS earlier
    FROM counted CROSS JOIN steps
), summed AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (NOT now AND NOT earlier), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (now AND NOT earlier), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (now AND earlier), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (failed = own), 0)::BIGINT AS unique_fails,
           coalesce(sum(n) FILTER (now AND NOT earlier AND good), 0)::BIGINT AS good_lost,
           coalesce(sum(n) FILTER (now AND NOT earlier AND toxic), 0)::BIGINT AS toxic_lost
    FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""

ORACLE_SQL = {
    "op3_chat_formatting": _OP3,
    "op11_lexical_search": _OP11,
    "op13_filter_audit": _OP13,
}
