"""DuckDB SQL with the same results as the registered queries, where SQL can express them."""

from __future__ import annotations

#: The words of a text: runs of what is not blank, or of letters and digits, of the lower-cased text.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: w[i:i+3]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS s
  FROM texts
), sizes AS (
  SELECT doc_id, coalesce(len(s), 0) AS n FROM shingles
), items AS (
  SELECT doc_id, unnest(s) AS s FROM shingles
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM items x JOIN items y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * c >= 80 * (p.n + q.n - c)
), ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM sizes UNION SELECT r.node, w.b FROM reach r JOIN ways w ON r.other = w.a
), least AS (
  SELECT node, min(other) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least ON doc_id = node
"""

OP3 = r'''
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), turns AS (
  SELECT *, 4 + length(role) + 2 + length(regexp_replace(text, '(### [A-Za-z0-9.*_+%-]*: |</turn>)', '\\\1', 'g')) + 9 AS long,
    CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss
  FROM said
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(long) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
'''

_SQL = {"op1_minhash_near_dedup": OP1, "op3_chat_round_trip": OP3}


def all_sql() -> dict[str, str]:
    return dict(_SQL)
