"""DuckDB SQL for the training-data queries that SQL can express."""

# Ranks, the words for each unit of weight, and the line of each source in md5 order. The level is the largest that
# any set of full sources gives: sources fill up in the order of cap to weight.
OP6 = r"""
WITH sized AS (
    SELECT doc_id, source, md5(concat_ws('|', doc_id::VARCHAR, text)) AS k,
           COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, SUM(size)::BIGINT AS source_size, ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sized GROUP BY source
), weighted AS (
    SELECT *, [3.0::DOUBLE, 1.0, 2.0][rank % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS cap,
           [1.5::DOUBLE, 1.0, 0.5][rank % 3 + 1] AS w0, [0.5::DOUBLE, 1.0, 1.5][rank % 3 + 1] AS w1
    FROM sources
), filled AS (
    SELECT *, COALESCE(SUM(cap) OVER before, 0) AS given, SUM(weight) OVER rest AS open
    FROM weighted
    WINDOW before AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           rest AS (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
    SELECT MAX((1.5::DOUBLE * (SELECT SUM(source_size) FROM sources) - given) / open) AS level FROM filled
), targets AS (
    SELECT w.*, LEAST(cap, weight * level) AS target FROM weighted w, level
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, t.w0, t.w1, ROUND(t.target)::BIGINT AS words,
           COALESCE(SUM(s.size) OVER (PARTITION BY t.rank ORDER BY s.k, s.doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
    SELECT *, GREATEST(0, LEAST(size, words - begin)) AS first_pass,
           GREATEST(0, LEAST(size, words - begin - source_size)) AS second_pass,
           w0 / ((w0 + w1) / 2) AS f, (w1 - w0) / ((w0 + w1) / 2) AS slope
    FROM placed
)
SELECT doc_id, size, source_size, target, (first_pass + second_pass)::BIGINT AS taken,
       CASE WHEN first_pass > 0 THEN 2 * (begin / target) / (f + sqrt(f * f + 2 * slope * (begin / target))) END
           AS position
FROM taken
"""

OP7 = """
WITH used AS (
    SELECT vec_id, list_transform(embedding, lambda v: FLOOR(64 * v::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda v: NOT isfinite(v))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM used q JOIN used c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, (ROW_NUMBER() OVER w)::INTEGER AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY ROW_NUMBER() OVER w <= 20
"""

# A page is listed if its host or a parent of two labels or more begins with a label that has a listed word.
OP9 = r"""
WITH split AS (
    SELECT page_id,
           translate(COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM split
), numbered AS (
    SELECT *, ROW_NUMBER() OVER () AS n, string_split(host, '.') AS labels FROM ruled
), listed AS (
    SELECT host || path AS key FROM split WHERE page_id % 50 = 7
    UNION SELECT host || '/' FROM split WHERE page_id % 500 = 7
    UNION SELECT 'reported-' || page_id || '.example/' FROM split WHERE page_id % 50 = 7
), asked AS (
    SELECT n, UNNEST(list_append(list_transform(range(1, len(labels)),
               lambda i: array_to_string(labels[i:], '.') || '/'), host || path)) AS key
    FROM numbered WHERE host <> ''
), found AS (
    SELECT DISTINCT n FROM asked JOIN listed USING (key)
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR f.n IS NOT NULL THEN 'block' ELSE 'allow'
    END AS verdict
FROM numbered p LEFT JOIN found f ON p.n = f.n
"""

OP11 = r"""
WITH said AS (
    SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
    SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS safe_text,
           replace(replace(role, '\', '\\'), '<|', '<\|') AS safe_role,
           LAG(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS DISTINCT FROM role AS starts
    FROM said
)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       SUM(length(safe_text) + CASE WHEN starts THEN length('<|turn|><|says|><|end|>') + 1 + length(safe_role)
           ELSE length('<|more|>') END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

# A path is the list of the turns' hashes. Every node counts towards each of its prefixes, itself included.
OP12 = r"""
WITH turns AS (
    SELECT conv_id, strlen(COALESCE(text, '')) AS n_bytes,
           sha256(strlen(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, '')) AS turn,
           ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY conversations.turn NULLS FIRST, sha256(
               strlen(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, ''))) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
               list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
               lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                   lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT t.conv_id, 1 AS own, pos, turn, n_bytes FROM turns t JOIN ids i ON t.conv_id = i.conv_id
    WHERE i.base = i.conv_id OR pos >= h
    UNION ALL
    SELECT i.conv_id, 0, pos, turn, n_bytes FROM turns t JOIN ids i ON t.conv_id = i.base
    WHERE i.base <> i.conv_id AND pos < h
), paths AS (
    SELECT conv_id, list(turn) OVER so_far AS path, n_bytes,
           ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY own DESC, pos DESC) = 1 AS ends
    FROM rebuilt WINDOW so_far AS (PARTITION BY conv_id ORDER BY own, pos)
    UNION ALL SELECT conv_id, [], 0, conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM ids
), nodes AS (
    SELECT path, len(path) AS depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, MIN(n_bytes) AS n_bytes,
           sha256(COALESCE(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM paths GROUP BY path
), children AS (
    SELECT path[:-2] AS path, COUNT(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), totals AS (
    SELECT path[:k] AS path, SUM((n_convs - 1) * n_bytes)::BIGINT AS saved_tokens, COUNT(*) FILTER (leaf) AS n_leaves
    FROM (SELECT n.*, c.path IS NULL AS leaf, UNNEST(range(n.depth + 1)) AS k
          FROM nodes n LEFT JOIN children c ON n.path = c.path)
    GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, COALESCE(c.n_children, 0) AS n_children,
       t.n_leaves, t.saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON n.path = t.path LEFT JOIN children c ON n.path = c.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:-2]
"""

ORACLE = {
    "op6_curriculum": OP6, "op7_uniform_threshold": OP7, "op9_bloom_cascade": OP9, "op11_chat_format": OP11,
    "op12_prefix_trie": OP12,
}
