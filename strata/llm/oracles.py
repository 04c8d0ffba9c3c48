"""DuckDB SQL of the operators' queries that SQL can express, each written without the operator's method."""

#: CRC-32 of a decimal number's text, bit by bit, and its remainder by 4.
_CRC = """(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295::BIGINT) % 4)"""

_TRIE = rf"""
WITH own AS (
  SELECT conv_id, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS token,
    length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} AS h FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (
  SELECT c.conv_id, o.i AS place, o.token, o.words FROM convs c JOIN own o ON o.conv_id = c.base AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, 4 + o.i, o.token, o.words FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h),
path AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(token, ',') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS node, words
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place)
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM convs),
member AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM path),
node AS (
  SELECT node, any_value(parent) AS parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '') AS ended
  FROM member GROUP BY node, depth),
child AS (SELECT parent AS node, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent),
pair AS (
  SELECT DISTINCT a.node AS top, d.node FROM member a JOIN member d ON a.conv_id = d.conv_id AND a.depth <= d.depth),
below AS (
  SELECT p.top, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.words) AS saved
  FROM pair p JOIN node d ON d.node = p.node LEFT JOIN child c ON c.node = p.node GROUP BY p.top)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.n_leaves,
  b.saved::BIGINT AS saved_tokens, sha256(n.ended) AS ends_sha256
FROM node n JOIN below b ON b.top = n.node LEFT JOIN child c ON c.node = n.node LEFT JOIN node p ON p.node = n.parent
"""

_JACCARD = r"""
WITH RECURSIVE text_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM text_words WHERE len(w) > 0)),
sized AS (SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles FROM text_words t LEFT JOIN (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id) n USING (doc_id)),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT s.a, s.b FROM shared s JOIN sized x ON x.doc_id = s.a JOIN sized y ON y.doc_id = s.b
  WHERE 100 * s.n >= 85 * (x.n_shingles + y.n_shingles - s.n)),
reach AS (SELECT doc_id, doc_id AS other FROM sized UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, s.n_shingles::BIGINT AS n_shingles, c.component_id FROM sized s JOIN component c USING (doc_id)
"""

_REPEATS = r"""
WITH text_words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM text_words),
starts AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth
  FROM (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM text_words WHERE len(w) >= 20))),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM starts WHERE nth > 1),
marked AS (SELECT p.*, g.i IS NOT NULL AS removed FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS kept
  FROM marked GROUP BY doc_id)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(p.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(p.kept, '')) AS kept_sha256
FROM text_words t LEFT JOIN per_doc p USING (doc_id)
"""

ORACLE_SQL = {"op6_jaccard_join": _JACCARD, "op10_substring_dedup": _REPEATS, "op12_conversation_trie": _TRIE}
