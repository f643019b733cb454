"""DuckDB twins of the queries that SQL expresses."""

OP2 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents
), items AS (
  SELECT CAST(item_id AS varchar) AS item_id, ws, least(13, len(ws)) AS n FROM (
    SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark)
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS k FROM items WHERE n > 0)
), doc_windows AS (
  SELECT doc_id, n, k, array_to_string(ws[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM docs, (SELECT DISTINCT n FROM items WHERE n > 0))
), hits AS (
  SELECT doc_id, k, n, item_id FROM doc_windows JOIN item_windows USING (n, g)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP4 = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), grams AS (
  SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (
    SELECT doc_id, k, ws[k:k + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS k FROM docs))
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(k, k + 3)) AS p FROM grams WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counted AS (
  SELECT doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM docs LEFT JOIN repeated USING (doc_id) LEFT JOIN lines USING (doc_id)
), ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines
         OR word_chars < 2 * n_words OR word_chars > 12 * n_words AS soft_failed
  FROM counted
), hosts AS (
  SELECT source, count(*) AS documents, count(*) FILTER (base_failed OR soft_failed) AS failures FROM ruled GROUP BY source
), moments AS (
  SELECT avg(failures / documents) AS m, var_pop(failures / documents) AS v, avg(1 / documents) AS s FROM hosts
), prior AS (
  SELECT m, CASE WHEN v > m * (1 - m) * s THEN least(greatest(m * (1 - m) / (v - m * (1 - m) * s) - 1, 1), 10000) ELSE 10000 END AS strength
  FROM moments
), rates AS (
  SELECT source, (failures + m * strength) / (documents + strength) AS host_rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (host_rate >= 0.6 AND soft_failed)) AS kept,
       ruled.source, soft_failed, round(host_rate, 6) AS host_rate, host_rate >= 0.6 AS host_failed
FROM ruled JOIN rates ON ruled.source IS NOT DISTINCT FROM rates.source
"""

OP11 = r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""

OP12 = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), placed AS (
  SELECT piece, lang, generate_subscripts(ws, 1) AS k, unnest(ws) AS w FROM pieces
), windows AS (
  SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
  FROM placed WINDOW p AS (PARTITION BY piece ORDER BY k)
), f AS MATERIALIZED (
  SELECT lang, [w1] AS g, 1 AS m, count(*) AS c FROM windows GROUP BY ALL UNION ALL
  SELECT lang, [w1, w2], 2, count(*) FROM windows WHERE w2 IS NOT NULL GROUP BY ALL UNION ALL
  SELECT lang, [w1, w2, w3], 3, count(*) FROM windows WHERE w3 IS NOT NULL GROUP BY ALL UNION ALL
  SELECT lang, [w1, w2, w3, w4], 4, count(*) FROM windows WHERE w4 IS NOT NULL GROUP BY ALL
), words AS (
  SELECT lang, CAST(sum(c) AS bigint) AS n FROM f WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT lang, g, m, c AS a FROM f WHERE m > 1 AND c >= 30
), cuts AS (
  SELECT x.lang, x.g, x.a, x.k, l.c AS l, r.c AS r, CAST(2000000::hugeint * x.a // (l.c + r.c) AS bigint) AS score
  FROM (SELECT lang, g, a, m, unnest(range(1, m)) AS k FROM candidates) AS x
  JOIN f AS l ON l.lang = x.lang AND l.g = x.g[1:x.k]
  JOIN f AS r ON r.lang = x.lang AND r.g = x.g[x.k + 1:x.m]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), longer AS (
  SELECT lang, g[s:s + z - 1] AS g, max(a) AS longest FROM (
    SELECT lang, g, a, z, unnest(range(1, m - z + 2)) AS s
    FROM (SELECT lang, g, a, m, unnest(range(2, m)) AS z FROM candidates))
  GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(lowest.g, ' ')) AS rank,
       array_to_string(lowest.g, ' ') AS phrase, a, l, r, n, score
FROM lowest LEFT JOIN longer USING (lang, g) JOIN words USING (lang)
WHERE longest IS NULL OR 100 * longest < 80 * a
QUALIFY rank <= 2000
"""

_NEAR = """near{i} AS MATERIALIZED (
  SELECT vec_id, p, m % 64 AS e, m // 64 AS d FROM (
    SELECT vec_id, parts.p, min(64 * list_sum(list_transform(range(1, w + 1), lambda j: (x[j] - y[j]) * (x[j] - y[j])))::bigint + e) AS m
    FROM parts JOIN book{i} AS b ON parts.p = b.p GROUP BY vec_id, parts.p)
)"""
_BOOK = """book{j} AS MATERIALIZED (
  SELECT p, e, coalesce(z, y) AS y FROM book{i} LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS z FROM (
      SELECT parts.p, e, j, sum(x[j])::bigint AS s, count(*) AS n
      FROM parts JOIN near{i} AS a ON a.vec_id = parts.vec_id AND a.p = parts.p, LATERAL (SELECT unnest(range(1, w + 1)) AS j)
      GROUP BY parts.p, e, j)
    GROUP BY p, e) USING (p, e)
)"""

OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS double)) AS bigint)) AS v, len(embedding) // 16 AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p, w, v[p * w + 1:(p + 1) * w] AS x FROM kept, range(16) AS positions(p)
), book0 AS MATERIALIZED (
  SELECT p, e, x AS y FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64) USING (vec_id)
), {_NEAR.format(i=0)}, {_BOOK.format(i=0, j=1)}, {_NEAR.format(i=1)}, {_BOOK.format(i=1, j=2)}, {_NEAR.format(i=2)},
codes AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS bigint) AS error FROM near2 GROUP BY vec_id
), checksum AS (
  SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), checksum
"""
