"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {
    "op9_extendible_shards": """
WITH r AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), n AS (
  SELECT depth, h >> (60 - depth) AS prefix, count(*) AS shard_rows, CAST(sum(bytes) AS BIGINT) AS shard_bytes
  FROM r, (SELECT CAST(unnest(range(0, 61)) AS INT) AS depth) d
  GROUP BY depth, h >> (60 - depth)
), leaf AS (
  SELECT n.* FROM n LEFT JOIN n p ON p.depth = n.depth - 1 AND p.prefix = n.prefix >> 1
  WHERE (n.depth = 0 OR p.shard_bytes > 1048576) AND (n.shard_bytes <= 1048576 OR n.depth = 60)
)
SELECT doc_id, bytes, depth, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard, shard_rows, shard_bytes
FROM r JOIN leaf ON h >> (60 - depth) = prefix""",
    "op10_voronoi_topk": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * d.e[i])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) t
WHERE rank <= 5""",
    # crc32 of a decimal number, byte by byte and bit by bit.
    "op11_prefix_trie": r"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT conv_id, s, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM ids
  UNION ALL
  SELECT conv_id, s, i + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END
  FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(s, CAST(i // 8 + 1 AS INT), 1)) AS BIGINT)) ELSE c END AS x FROM bits) b
  WHERE i < 8 * length(s)
), own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), seq AS (
  SELECT own.conv_id, CAST(xor(c, CAST(4294967295 AS BIGINT)) % 4 AS INT) AS h, own.t AS t, head.t AS head
  FROM own JOIN bits ON bits.conv_id = own.conv_id AND bits.i = 8 * length(s)
  LEFT JOIN own head ON head.conv_id = own.conv_id - own.conv_id % 20
), rebuilt AS (
  SELECT conv_id, list_concat(coalesce(head[1:h], []), t[h + 1:]) AS t FROM seq
), member AS (
  SELECT conv_id, t[1:d] AS path, CAST(d AS BIGINT) AS depth, len(t) = d AS ends
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, row_number() OVER () AS id,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends,
    CASE WHEN depth > 0 THEN (count(*) - 1) * len(regexp_extract_all(path[-1].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM member GROUP BY path, depth
), linked AS (
  SELECT c.*, p.id AS parent, p.conv_id AS parent_conv_id FROM node c LEFT JOIN node p ON p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]
), sized AS (
  SELECT l.*, (SELECT count(*) FROM linked k WHERE k.parent = l.id) AS n_children FROM linked l
), below AS (
  SELECT id AS top, id, n_children, saved FROM sized
  UNION ALL
  SELECT b.top, s.id, s.n_children, s.saved FROM below b JOIN sized s ON s.parent = b.id
), sums AS (
  SELECT top, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM below GROUP BY top
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM sized JOIN sums ON sums.top = sized.id""",
}
