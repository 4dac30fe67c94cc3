"""DuckDB twins of the queries that SQL can express over whole tables."""

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
         row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS place,
         first_value(page_id) OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS lead_id
  FROM p
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda j: substr('{ALPHABET}',
         (((('0x' || substr(hex, (5 * (j // 4) + 1)::INT, 5))::INT >> (15 - 5 * (j % 4))::INT) & 31) + 1)::INT, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN lead_id END AS refers_to
FROM h
"""

URLS = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), part AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), longest AS (
  SELECT page_id, host, path,
         (SELECT max_by(struct_pack(r := rhost || rpath, v := rverdict), length(rhost || rpath)) FROM rules
          WHERE ('.' || host) LIKE ('%.' || rhost) AND starts_with(path, rpath)) AS hit
  FROM part
)
SELECT page_id, host, path, hit.r AS rule, coalesce(hit.v, 'allow') AS verdict FROM longest
"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 20
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id FROM documents
), t AS (
  SELECT id, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
), k AS (
  SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term
), cell AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), x AS (
  SELECT lang, source, term, n,
         (1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER g + 2 * count(*) OVER g)::HUGEINT)::HUGEINT AS p,
         (1 + (1000000000::HUGEINT * (lang_n + 2)) // (sum(lang_n) OVER g + 2 * count(*) OVER g)::HUGEINT)::HUGEINT AS q
  FROM cell WINDOW g AS (PARTITION BY lang, source)
), far AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), g AS (SELECT DISTINCT lang, source FROM d), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
), words AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM x WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM words)
) WHERE part = 'pair' OR rank <= 10
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, positive_id, s.other AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
  WHERE 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
) WHERE rank <= 10
"""

LINES = r"""
WITH d AS (
  SELECT coalesce(text, '') AS text, doc_id, row_number() OVER () AS id FROM documents
), l AS (
  SELECT id, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), m AS (
  SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS lost FROM k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY id, doc_id
"""
