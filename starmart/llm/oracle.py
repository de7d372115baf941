"""SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op6_chat": r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
    SELECT *, 12 + length(role) + length(regexp_replace(role, '[^\\\n]', '', 'g'))
        + CASE WHEN contains(role, '<|im_end|>') OR contains(role, '<|im_start|>') THEN len(regexp_extract_all(role, '<\|')) ELSE 0 END
        + 1 + length(text) + 10 + 1 + CASE
        WHEN contains(text, '<|im_end|>') OR contains(text, '<|im_start|>') OR regexp_matches(text, '<\\+\|')
        THEN len(regexp_extract_all(text, '<\\*\|')) ELSE 0 END AS chars
    FROM rows)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op12_prefix_trie": r"""
WITH said AS (
    SELECT conv_id::BIGINT AS conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
            lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                lambda c, i: xor(c >> 1, (c & 1) * 3988292384))), 4294967295::BIGINT) % 9 AS h
    FROM said),
heads AS (
    SELECT c.conv_id, role, text, place, max(place) OVER (PARTITION BY c.conv_id) + 1 AS size
    FROM convs c JOIN said s ON s.conv_id = base AND place < h),
rebuilt AS (
    SELECT conv_id, role, text, place FROM heads
    UNION ALL
    SELECT s.conv_id, role, text, place - h + coalesce((SELECT max(size) FROM heads x WHERE x.conv_id = s.conv_id), 0)
    FROM said s JOIN convs c USING (conv_id) WHERE place >= h),
turns AS (
    SELECT conv_id, place + 1 AS depth, strlen(text) AS size,
        string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY place) AS path
    FROM rebuilt),
paths AS (
    SELECT conv_id, depth, size, path FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
members AS (
    SELECT conv_id, depth, size, path, length, min(conv_id) OVER (PARTITION BY depth, path) AS node
    FROM paths JOIN lengths USING (conv_id)),
nodes AS (
    SELECT node, depth, count(*) AS n_convs, max(size) AS size, max(length) = depth AS leaf,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends_sha256
    FROM members GROUP BY node, depth),
parents AS (
    SELECT n.*, m.node AS parent FROM nodes n LEFT JOIN members m ON m.conv_id = n.node AND m.depth = n.depth - 1),
children AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE parent IS NOT NULL GROUP BY ALL),
below AS (
    SELECT a.node, a.depth, count(*) FILTER (WHERE n.leaf) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved
    FROM nodes n JOIN members a ON a.conv_id = n.node AND a.depth <= n.depth GROUP BY a.node, a.depth)
SELECT p.node AS conv_id, p.depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
    n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM parents p LEFT JOIN children c USING (node, depth) JOIN below b USING (node, depth)""",
    "op13_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
suffixes AS (
    SELECT lang, words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3
    FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM words)),
totals AS (SELECT lang, count(*) AS n FROM suffixes GROUP BY lang),
counts AS (
    SELECT lang, 1 AS size, w1 AS phrase, count(*) AS n FROM suffixes GROUP BY ALL HAVING n >= 10
    UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) AS n FROM suffixes WHERE w2 IS NOT NULL GROUP BY ALL HAVING n >= 10
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) AS n FROM suffixes WHERE w3 IS NOT NULL GROUP BY ALL HAVING n >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.n AS a, k, l.n AS l, r.n AS r, 1000000 * c.n::HUGEINT * c.n::HUGEINT // (l.n::HUGEINT * r.n::HUGEINT) AS score
    FROM (SELECT *, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k FROM counts WHERE size > 1) c
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(words[1:k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(words[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
holders AS (
    SELECT lang, part AS phrase, max(n) AS b FROM (
        SELECT lang, n, unnest([words[1] || ' ' || words[2], words[2] || ' ' || words[3]]) AS part
        FROM (SELECT lang, n, string_split(phrase, ' ') AS words FROM counts WHERE size = 3))
    GROUP BY ALL),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
    FROM best LEFT JOIN holders USING (lang, phrase) JOIN totals USING (lang)
    WHERE b IS NULL OR 100 * b < 50 * a)
SELECT * FROM ranked WHERE rank <= 2000""",
}
