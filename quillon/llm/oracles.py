"""DuckDB SQL for the queries of this subpackage that SQL can express, by plain comparison of all rows."""

OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9),
r(node, reach) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT node AS vec_id, coalesce(k.n, 0) AS n_links, component_id, node = component_id AS kept FROM c LEFT JOIN k ON node = a
"""

OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM e JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)),
r(node, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON r.reach = l.a),
k AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT node AS doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM k LEFT JOIN n ON node = n.doc_id
"""

#: Roles of letters, digits, _ and - only; other characters would be escaped in a turn's head.
OP6_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(15 + len(role) + len(text) + len(regexp_extract_all(text, '### |</turn>'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
