"""DuckDB texts of the queries that SQL can express."""

NEAR_COMPONENTS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i+2], ' ') FOR i IN range(1, len(ws) - 1)]) END AS sh
  FROM w
), n AS (SELECT doc_id, len(sh) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
f AS (SELECT * FROM e WHERE g IN (SELECT g FROM e GROUP BY g HAVING count(*) > 1)),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM f a JOIN f b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM c JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v WHERE 100 * shared >= 90 * (p.n_shingles + q.n_shingles - shared)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, l.v FROM r JOIN l ON l.u = r.seen)
SELECT n.doc_id, n.n_shingles, min(r.seen) AS component_id FROM n JOIN r ON r.node = n.doc_id GROUP BY ALL
"""

URL_LISTS = r"""
WITH p AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919) % 31622400 AS fetched_at,
    rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '.') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), seen AS (
  SELECT 'domain' AS kind, regexp_replace(host, '^(www|m|blog)\.', '') AS pattern FROM p WHERE host <> ''
  UNION SELECT 'prefix', host || regexp_extract(path, '^(/[^/]+)', 1) FROM p WHERE host <> ''
), listed AS (
  SELECT *, ('0x' || substr(md5(pattern), 1, 6))::BIGINT AS d0, ('0x' || substr(md5(pattern), 7, 6))::BIGINT AS d1,
    ('0x' || substr(md5(pattern), 13, 6))::BIGINT AS d2, ('0x' || substr(md5(pattern), 19, 6))::BIGINT AS d3
  FROM seen
), t AS (
  SELECT *, 1688169600 + d1 % 31536000 AS a FROM listed WHERE d0 % 3 = 0
), u AS (SELECT *, a + 86400 + d2 % 15768000 AS b FROM t), x AS (SELECT *, b + 86400 + d3 % 7884000 AS c FROM u),
iv AS (
  SELECT kind, pattern AS key, a AS since, CASE WHEN d0 % 4 >= 2 THEN b END AS until, 'spam' AS category FROM x WHERE d0 % 4 >= 1
  UNION ALL SELECT kind, pattern, c, NULL, 'adult' FROM x WHERE d0 % 4 >= 3
), h AS (
  SELECT p.page_id, p.url, p.fetched_at, iv.*, row_number() OVER (PARTITION BY p.page_id, p.url ORDER BY length(iv.key) DESC, iv.kind DESC, iv.key DESC) AS k
  FROM p JOIN iv ON p.fetched_at >= iv.since AND (iv.until IS NULL OR p.fetched_at < iv.until)
    AND ((iv.kind = 'domain' AND (p.host = iv.key OR ends_with(p.host, '.' || iv.key)))
      OR (iv.kind = 'prefix' AND (p.host || p.path = iv.key OR starts_with(p.host || p.path, iv.key || '/'))))
)
SELECT p.page_id, p.url, p.fetched_at, h.key IS NOT NULL AS blocked, h.kind AS list_kind, h.key AS list_key,
  h.category AS list_category, h.since AS listed_since
FROM p LEFT JOIN h ON h.page_id = p.page_id AND h.url = p.url AND h.k = 1
"""

# crc32 of the distinct words only, bit by bit; word characters are a-z, 0-9 and all beyond ASCII
_WORDS = lambda table: f"SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w{', doc_id' if table == 'documents' else ''} FROM {table}"
_CRC = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(1, 9)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))))"""
IMPORTANCE_RESAMPLING = f"""
WITH ours AS (SELECT w, doc_id, count(*) AS n FROM ({_WORDS('documents')}) GROUP BY ALL), theirs AS (SELECT w, count(*) AS n FROM ({_WORDS('benchmark')}) GROUP BY ALL),
kinds AS MATERIALIZED (SELECT w, {_CRC} % 10000 AS bucket FROM (SELECT w FROM ours UNION SELECT w FROM theirs)),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM ours JOIN kinds USING (w) GROUP BY 1), t AS (SELECT bucket, sum(n)::BIGINT AS t FROM theirs JOIN kinds USING (w) GROUP BY 1),
gain AS (SELECT b AS bucket, CAST(floor(1000.0::DOUBLE * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE) / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
weights AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM ours JOIN kinds USING (w) JOIN gain USING (bucket) GROUP BY 1),
scored AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM documents d LEFT JOIN weights w ON d.doc_id = w.doc_id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN place <= 10 * (SELECT count(*) FROM ranked) // 100 THEN place END AS rank FROM scored LEFT JOIN ranked ON scored.doc_id = ranked.doc_id
"""
