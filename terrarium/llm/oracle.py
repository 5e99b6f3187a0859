"""DuckDB SQL of the dealt queries that SQL can express: all pairs instead of
projections, plain distances instead of dictionaries, lists of digests instead
of a node table."""

from __future__ import annotations

OP11 = """
WITH RECURSIVE able AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  AND list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
reached(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
  least(e.vec_id, coalesce(l.b, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id
"""


def _assigned(parts: str, book: str) -> str:
    far = "list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))::BIGINT"
    return f"""SELECT x.vec_id, x.label, x.p, x.v, min(struct_pack(far := coalesce({far}, 0), e := b.e)) AS near
  FROM {parts} x JOIN {book} b USING (p) GROUP BY ALL"""


def _refitted(assigned: str, book: str) -> str:
    return f"""SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM {book} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS v FROM (
      SELECT p, near.e AS e, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS m
      FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM {assigned}) GROUP BY ALL) GROUP BY ALL) n
  ON n.p = b.p AND n.e = b.e"""


OP12 = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, label, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS v
  FROM (SELECT *, unnest(range(16)) AS p FROM kept)),
book_0 AS (
  SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 64),
near_0 AS ({_assigned("parts", "book_0")}),
book_1 AS ({_refitted("near_0", "book_0")}),
near_1 AS ({_assigned("parts", "book_1")}),
book_2 AS ({_refitted("near_1", "book_1")}),
near_2 AS ({_assigned("parts", "book_2")}),
coded AS (
  SELECT vec_id, label, string_agg(lower(printf('%02x', near.e)), '' ORDER BY p) AS code, sum(near.far)::BIGINT AS error
  FROM near_2 GROUP BY vec_id, label),
books AS (
  SELECT sha256(string_agg(v[i]::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM book_2))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded, books
"""

#: crc32 of a conversation's id, a byte at a time, and a bit of it at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''),
    lambda x: ascii(x)::UBIGINT)), lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda y, z: xor(y >> 1, (y & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)"""

OP13 = f"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
    coalesce(text, '')) - 1 AS i, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 20 AS base, ({_CRC} % 4)::BIGINT AS h FROM (SELECT DISTINCT c FROM own)),
turns AS (
  SELECT v.c, 0 AS own, o.i, o.role, o.text FROM convs v JOIN own o ON o.c = v.base AND o.i < v.h
  UNION ALL SELECT v.c, 1, o.i, o.role, o.text FROM convs v JOIN own o ON o.c = v.c AND o.i >= v.h),
paths AS (
  SELECT v.c, coalesce(list(sha256(t.role || chr(31) || t.text) ORDER BY t.own, t.i) FILTER (t.c IS NOT NULL), []) AS path,
    coalesce(list(len(regexp_extract_all(t.text, '[^\\x20\\x09-\\x0D]+')) ORDER BY t.own, t.i)
      FILTER (t.c IS NOT NULL), []) AS words
  FROM convs v LEFT JOIN turns t ON t.c = v.c GROUP BY v.c),
members AS (
  SELECT c, d, path[1:d] AS node, CASE WHEN d > 0 THEN path[1:d - 1] END AS parent, d = len(path) AS ends,
    CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT node, parent, min(c) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, parent),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
above AS (
  SELECT node[1:d] AS node, n_children, n_convs, words
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_nodes)),
sums AS (
  SELECT node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM above GROUP BY node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (node) LEFT JOIN full_nodes p ON p.node = n.parent
"""

SQL: dict[str, str] = {
    "op11_embedding_dedup": OP11,
    "op12_vector_codes": OP12,
    "op13_conversation_trie": OP13,
}
