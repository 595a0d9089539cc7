"""DuckDB SQL of the resampling, prefix-trie and vector operators."""

from __future__ import annotations

# The table of CRC-32, and the checksum of a text's UTF-8 bytes, as expressions.
_TABLE = """SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i))"""


def _crc32(text: str, table: str = "crc.t") -> str:
    return (f"xor(list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode({text}))), "
            f"lambda k: ('0x' || substr(hex(encode({text})), (2 * k + 1)::INT, 2))::BIGINT), "
            f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255)::INT + 1])), 4294967295)")


def _features(table: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {table}"


IMPORTANCE = rf"""
WITH crc AS ({_TABLE}), d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_features('documents')}
), f AS (
  SELECT rid, unnest(words) AS w FROM d
), g AS (
  SELECT unnest(words) AS w FROM (SELECT {_features('benchmark')})
), b AS (
  SELECT w, {_crc32('w')} % 10000 AS bucket FROM (SELECT w FROM f UNION SELECT w FROM g), crc
), n AS (
  SELECT bucket, coalesce(s, 0)::DOUBLE AS s, coalesce(t, 0)::DOUBLE AS t,
         sum(coalesce(s, 0)) OVER ()::DOUBLE AS alls, sum(coalesce(t, 0)) OVER ()::DOUBLE AS allt
  FROM (SELECT DISTINCT bucket FROM b)
  LEFT JOIN (SELECT bucket, count(*) AS s FROM f JOIN b USING (w) GROUP BY 1) USING (bucket)
  LEFT JOIN (SELECT bucket, count(*) AS t FROM g JOIN b USING (w) GROUP BY 1) USING (bucket)
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (alls + 10000) / ((s + 1) * (allt + 10000))))::BIGINT AS gain FROM n
), weight AS (
  SELECT rid, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN b USING (w) JOIN gain USING (bucket) GROUP BY rid
), scored AS (
  SELECT rid, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN weight USING (rid)
), score AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored
), able AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM score WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM score LEFT JOIN able USING (rid)
"""

PREFIX_TRIE = rf"""
WITH crc AS ({_TABLE}), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32('conv_id::VARCHAR')} % 9 AS h, n
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY 1), crc
), m AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS head FROM c LEFT JOIN c b ON c.base = b.conv_id
), turns AS (
  SELECT m.conv_id, pos AS depth, role, text FROM m JOIN t ON t.conv_id = m.base WHERE pos <= h
  UNION ALL
  SELECT m.conv_id, pos - h + head, role, text FROM m JOIN t ON t.conv_id = m.conv_id WHERE pos > h
), path AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS size,
         list(md5(octet_length(encode(role)) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY depth) AS key
  FROM turns
  UNION ALL SELECT conv_id, 0, 0, [] FROM c
), node AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size FROM path GROUP BY key, depth
), ends AS (
  SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(key, depth) AS key FROM path GROUP BY conv_id) GROUP BY key
), child AS (
  SELECT key[1:len(key) - 1] AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1
), up AS (
  SELECT node.key, unnest(range(0, depth + 1)) AS d, depth, (n_convs - 1) * size AS saved, coalesce(n_children, 0) = 0 AS leaf
  FROM node LEFT JOIN child USING (key)
), below AS (
  SELECT key[1:d] AS key, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY 1
)
SELECT node.conv_id, node.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node LEFT JOIN node p ON node.depth > 0 AND p.key = node.key[1:len(node.key) - 1]
LEFT JOIN child c ON c.key = node.key LEFT JOIN ends e ON e.key = node.key JOIN below b ON b.key = node.key
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), u AS (
  SELECT rid, vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS u FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(e, lambda x: x * x)) > 0
), link AS (
  SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.rid <> b.rid AND len(a.u) = len(b.u)
  WHERE list_dot_product(a.u, b.u) >= 0.95
), reach AS (
  SELECT rid AS a, rid AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (
  SELECT reach.a AS rid, min(v.vec_id) AS component_id FROM reach JOIN v ON v.rid = reach.b GROUP BY 1
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (rid) LEFT JOIN (SELECT a AS rid, count(*) AS n FROM link GROUP BY 1) USING (rid)
"""
