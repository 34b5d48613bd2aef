"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

URL_FILTERS = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), addressed AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(verdict, rule, rule_host, rule_path) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
)
SELECT page_id, host, path,
  (SELECT arg_max(rule, length(rule)) FROM rules
   WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
  coalesce((SELECT arg_max(verdict, length(rule)) FROM rules
   WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM addressed
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
             max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""


TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


PREFIX_TRIE = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM t GROUP BY c
), opened AS (
  SELECT c, turns, c - c % 20 AS base,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::UBIGINT)),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)))) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM opened o LEFT JOIN own b ON b.c = o.base
), prefixes AS (
  SELECT c, d AS depth, turns[1:d] AS path, len(turns) AS n FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CASE WHEN n = depth THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM prefixes GROUP BY path, depth
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
)
SELECT a.conv_id, a.depth::BIGINT AS depth, a.parent_conv_id, a.n_convs, a.n_children,
  count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
  sum((b.n_convs - 1) * b.words)::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM linked a JOIN linked b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path
GROUP BY a.path, a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends
"""


def all_sql() -> dict[str, str]:
    return {"op1_url_filters": URL_FILTERS, "op8_topk": TOPK, "op10_warc": WARC, "op12_prefix_trie": PREFIX_TRIE}
