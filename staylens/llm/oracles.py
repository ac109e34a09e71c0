"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

_ESCAPED = "(2 * length({0}) - length(regexp_replace({0}, '[\\\\<\\[\\]]', '', 'g')))"

_CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum({_ESCAPED.format("text")} + CASE WHEN opens THEN 7 + {_ESCAPED.format("role")}
    + CASE WHEN role = 'assistant' THEN 4 ELSE 7 END ELSE 3 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""

_JACCARD = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
cells AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared, any_value(a.n) AS n, any_value(b.n) AS m
  FROM cells a JOIN cells b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs WHERE 100 * shared >= 80 * (n + m - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
counted AS (SELECT x, count(*) AS n_links FROM edges GROUP BY x),
near AS (SELECT e.x, count(DISTINCT list_sort(t.s)) AS n_class_links FROM edges e JOIN sets t ON t.doc_id = e.y
  JOIN sets o ON o.doc_id = e.x WHERE list_sort(t.s) <> list_sort(o.s) GROUP BY e.x),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.y) AS component_id,
  coalesce(any_value(c.n_links), 0) AS n_links, coalesce(any_value(k.n_class_links), 0) AS n_class_links
FROM sets s JOIN reach r ON r.x = s.doc_id LEFT JOIN counted c ON c.x = s.doc_id LEFT JOIN near k ON k.x = s.doc_id
GROUP BY s.doc_id, len(s.s)"""

ORACLES = {"op7_chat_formatting": _CHAT, "op8_ngram_jaccard_join": _JACCARD}
