"""Expected results of the operators' queries in SQL, where SQL can say them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op3_url_filter"] = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

# Sources fill up in the order of ceiling to weight; the highest level that a source
# still fits under is the one at which the shares add up.
MIX = """
WITH docs AS (
  SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
         3.0::DOUBLE * source_size AS most,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total
  FROM sizes),
levels AS (
  SELECT *,
         (total - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW w AS (ORDER BY most / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size,
         least(most, coalesce(max(level) FILTER (level * weight <= most) OVER () * weight, most)) AS target
  FROM levels),
mixed AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('0:' || md5(concat_ws(chr(1), coalesce(CAST(doc_id AS VARCHAR), chr(2)),
                coalesce(text, chr(2)), coalesce(d.source, chr(2)))) || ':' || CAST(
                row_number() OVER (PARTITION BY doc_id, text, d.source) - 1 AS VARCHAR)), 1, 13) AS BIGINT)
           / 4503599627370496.0::DOUBLE AS draw
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
planned AS (
  SELECT *, least(3, CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS copies
  FROM mixed)
"""

ORACLES["op6_mixing"] = MIX + """
SELECT doc_id, size, source_size, target, copies * size AS taken FROM planned
"""

ORACLES["op9_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
placed AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
         length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h')) AS chars,
         length(replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c')) AS role_chars
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(chars + CASE WHEN before IS DISTINCT FROM role THEN 6 + role_chars ELSE 7 END
                + CASE WHEN after IS DISTINCT FROM role THEN 8 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

# Texts of one to four words have one shingle, of all their words.
LINKS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM words WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 5 * common >= 4 * (s.n + t.n - common)),
reached AS (
  SELECT doc_id AS start, doc_id AS node FROM documents
  UNION
  SELECT r.start, l.b FROM reached r JOIN links l ON l.a = r.node)
"""

ORACLES["op10_ngram_join"] = LINKS + """
SELECT start AS doc_id, min(node) AS class_id,
       (SELECT count(*) FROM links WHERE a = start) AS n_links
FROM reached GROUP BY start
"""

ORACLES["op5_exact_top_k"] = """
WITH vectors AS (
  SELECT vec_id, row_number() OVER () AS row, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, q.row, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.row <> c.row
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

ORACLES["op11_suffix_shards"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM words WHERE len(ws) >= 13)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (
  SELECT doc_id, list(DISTINCT spot) AS places
  FROM (SELECT doc_id, unnest(range(i, i + 13)) AS spot FROM windows JOIN firsts USING (w) WHERE first < doc_id)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(
         CASE WHEN places IS NULL THEN ws
              ELSE [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(places, i)] END,
         ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""

# crc32 by its table of 256 remainders, which the first step works out bit by bit.
_BIT = "CASE WHEN ({0}) & 1 = 1 THEN xor(({0}) >> 1, 3988292384::BIGINT) ELSE ({0}) >> 1 END"
ORACLES["op12_spelling_groups"] = (
    r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS step FROM (SELECT unnest(range(256))::BIGINT AS i)
  UNION ALL
  SELECT i, """
    + _BIT.format("c")
    + r""", step + 1 FROM bits WHERE step < 8),
remainders AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS doc,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
counted AS (SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n,
         xor(list_reduce(
           [CAST('0x' || b AS BIGINT) FOR b IN regexp_extract_all(hex(encode(doc || ':' || run)), '..')],
           lambda crc, b: xor(t[1 + (xor(crc, b) & 255)], crc >> 8), 4294967295::BIGINT), 4294967295) AS h
  FROM counted, remainders),
typed AS (
  SELECT n, CASE WHEN h % 31 = 0
                 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                 ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
patterns AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM holes),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n
  FROM patterns a JOIN patterns b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT DISTINCT a.word, a.n, b.word, b.n FROM patterns a JOIN words b ON b.word = a.head || a.tail
  UNION
  SELECT DISTINCT b.word, b.n, a.word, a.n FROM patterns a JOIN words b ON b.word = a.head || a.tail),
best AS (
  SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place
  FROM near),
forms AS (
  SELECT word, n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM best WHERE place = 1),
chains AS (
  SELECT word, word AS last, 0 AS step FROM words
  UNION ALL
  SELECT c.word, f.form, step + 1 FROM chains c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT w.word, f.form, (SELECT arg_max(last, step) FROM chains c WHERE c.word = w.word) AS root,
       w.n, coalesce(f.n_near, 0) AS n_near, f.form_n
FROM words w LEFT JOIN forms f ON f.word = w.word
"""
)


def _rounds(rounds: int) -> str:
    """K-means step by step: whole numbers below 2**53 are exact in the products of doubles."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT row, cluster, distance FROM (
    SELECT x.row, c.cluster,
           CAST(list_inner_product(x.v, x.v) + list_inner_product(c.v, c.v) - 2 * list_inner_product(x.v, c.v) AS BIGINT) AS distance,
           row_number() OVER (PARTITION BY x.row ORDER BY
             list_inner_product(x.v, x.v) + list_inner_product(c.v, c.v) - 2 * list_inner_product(x.v, c.v), c.cluster) AS place
    FROM vectors x CROSS JOIN centroids{r} c) WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (
  SELECT cluster, i, CAST(sum(CAST(v[i] AS BIGINT)) AS BIGINT) AS s, count(*) AS n
  FROM near{r} JOIN vectors USING (row), range(1, 65) AS places(i) GROUP BY cluster, i),
centroids{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centroids{r} c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS v FROM sums{r} GROUP BY cluster) m
  USING (cluster))""")
    return ",".join(steps)


ORACLES["op13_drift_clusters"] = (
    """
WITH vectors AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v
  FROM (SELECT v, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h FROM vectors ORDER BY h, v LIMIT 8)),"""
    + _rounds(10)
    + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN c.v], ',')) AS centroid_sha256
FROM near10 JOIN vectors USING (row) JOIN centroids10 c USING (cluster)
"""
)
