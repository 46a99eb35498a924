"""DuckDB SQL of this subpackage's registered queries, where SQL can express them."""

from __future__ import annotations

#: CTE ``tab``: the table of CRC-32 (polynomial 0xEDB88320, as zlib), one list of 256 numbers
_CRC_TABLE = """tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS tab)"""


def _crc32(word: str) -> str:
    """SQL for the unsigned CRC-32 of a string's UTF-8 bytes, where ``tab`` is in scope."""

    hexed = f"hex(encode({word}))"
    return f"""xor(list_reduce(
    list_transform(range(1, octet_length(encode({word})) + 1), lambda i: ('0x' || {hexed}[2 * i - 1:2 * i])::BIGINT),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"""


ORACLES: dict[str, str] = {
    "op2_minhash_dedup": r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS shingle FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
""",
    "op3_line_dedup": r"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
seen AS (
  SELECT source, unnest(list_distinct(list_transform(lines, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS line FROM d),
counts AS (SELECT source, line, count(*) AS pages FROM seen WHERE line <> '' GROUP BY ALL),
totals AS (SELECT source, count(*) AS site_pages FROM documents GROUP BY ALL),
bad AS (
  SELECT c.source, list(c.line) AS bad FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.pages >= 3 AND c.pages > 0.1 * t.site_pages GROUP BY c.source),
kept AS (
  SELECT d.*, CASE WHEN bad IS NULL THEN lines ELSE
    list_filter(lines, lambda x: NOT list_contains(bad, trim(x, ' ' || chr(9) || chr(13)))) END AS kept
  FROM d LEFT JOIN bad ON d.source IS NOT DISTINCT FROM bad.source)
SELECT doc_id, source, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(kept), 0) AS n_dropped,
  CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(kept, chr(10)), '') END AS text
FROM kept
""",
    "op5_near_vectors": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
    embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.good AND b.good AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, vec_id = c.component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
""",
    "op6_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM m
""",
    "op7_decontam": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT item_id, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p, w FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS win FROM iw),
widths AS (SELECT DISTINCT k FROM windows),
dp AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, widths WHERE len(w) >= k),
dw AS (SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS win FROM dp),
hits AS (SELECT dw.doc_id, dw.k, dw.p, windows.item_id FROM dw JOIN windows USING (k, win)),
n AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, k, p FROM hits)) GROUP BY 1),
it AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR) AS items FROM hits GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n_hit, 0)::BIGINT AS n_hit,
  coalesce(len(it.items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(list_sort(it.items), ','), '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op9_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
s1 AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, ([3, 1, 2])[rank % 3 + 1]::DOUBLE AS weight FROM s0),
s2 AS (
  SELECT *,
    (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS weights
  FROM s1),
s3 AS (SELECT *, max(rest / weights) OVER () AS level FROM s2),
s AS (SELECT source, rank, source_size, least(cap, level * weight) AS target FROM s3),
q AS (
  SELECT d.doc_id, d.size, d.h, s.rank, s.source_size, s.target,
    sum(d.size) OVER (PARTITION BY s.rank ORDER BY d.h, d.doc_id, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS served
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
e AS (
  SELECT *, (served + epoch * source_size)::DOUBLE / target AS finish
  FROM q CROSS JOIN (VALUES (0), (1)) AS t(epoch) WHERE size > 0),
c AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM e),
t AS (
  SELECT doc_id, h, size, count(*) AS copies FROM c
  WHERE upto <= (SELECT 1.5::DOUBLE * sum(size) FROM d) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * coalesce(t.copies, 0))::BIGINT AS taken
FROM q LEFT JOIN t ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.size = t.size
""",
    "op10_secrets": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
kinds(rank, kind, pattern) AS (VALUES
  (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
  (1, 'access', 'AKIA[A-Z0-9]{16,}'),
  (2, 'hex', '[0-9a-f]{24,}'),
  (3, 'entropy', '[A-Za-z0-9+/=_-]{20,}')),
m AS (
  SELECT doc_id, rank, kind, regexp_extract_all(text, pattern) AS found, string_split_regex(text, pattern) AS gaps
  FROM t, kinds WHERE regexp_matches(text, pattern)),
e AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m),
c AS (
  SELECT doc_id, rank, kind, found[i] AS m,
    (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: length(g))), 0))::BIGINT AS start
  FROM e),
base AS (
  SELECT * FROM c WHERE rank IN (1, 2)
    OR rank = 0 AND length(regexp_extract(m, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6),
runs AS (SELECT DISTINCT m FROM c WHERE rank = 3 AND regexp_matches(m, '[0-9]')),
cut AS (SELECT m, regexp_extract_all(m, '[+/=_-]+|[^+/=_-]+') AS pieces FROM runs WHERE regexp_matches(m, '[+/=_-]')),
pe AS (
  SELECT m AS run, pieces[i] AS m, coalesce(list_sum(list_transform(pieces[1:i - 1], lambda x: length(x))), 0)::BIGINT AS at
  FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS i FROM cut)),
strings AS (
  SELECT m FROM runs UNION SELECT m FROM pe WHERE length(m) >= 20 AND NOT regexp_full_match(m, '[+/=_-]+')),
judged AS (
  SELECT m, regexp_matches(m, '(?i:example|sample|placeholder|changeme|dummy|xxxx|your-|your_|0123456789|1234567890|abcdefgh)') AS worded,
    length(m) < 40 AND regexp_matches(m, '(?i:example|sample|placeholder|changeme|dummy|xxxx|your-|your_|0123456789|1234567890|abcdefgh)')
    OR regexp_full_match(m, '[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}')
    OR regexp_full_match(m, '[A-Za-z]+(?:[-_/][A-Za-z]+)+[0-9]{0,4}') OR regexp_full_match(m, '[0-9TZ:_-]+') AS allowed
  FROM strings),
parts AS (
  SELECT m, unnest(CASE WHEN worded THEN string_split_regex(m, '(?i:example|sample|placeholder|changeme|dummy|xxxx|your-|your_|0123456789|1234567890|abcdefgh)') ELSE [m] END) AS p FROM judged WHERE NOT allowed),
cand AS (
  SELECT DISTINCT p, CASE
    WHEN regexp_full_match(p, '[0-9A-Fa-f]+') AND regexp_matches(p, '[0-9]') AND regexp_matches(p, '[A-Fa-f]') THEN 3.0
    WHEN regexp_full_match(p, '[a-z0-9]+') AND regexp_matches(p, '[0-9][a-z]+[0-9]') THEN 3.5
    WHEN regexp_full_match(p, '[A-Z0-9]+') AND regexp_matches(p, '[0-9][A-Z]+[0-9]') THEN 3.4
    WHEN regexp_full_match(p, '[A-Za-z0-9]+') AND regexp_matches(p, '[0-9]') AND regexp_matches(p, '[A-Z]')
      AND regexp_matches(p, '[a-z]') THEN 3.7
    WHEN regexp_matches(p, '[0-9]') AND regexp_matches(p, '[A-Z]') AND regexp_matches(p, '[a-z]')
      AND regexp_matches(p, '[+/=_-]') THEN 3.8 END AS threshold
  FROM parts WHERE length(p) >= 20),
w AS (SELECT p, threshold, unnest(range(1, length(p) - 18)) AS i FROM cand WHERE threshold IS NOT NULL),
ch AS (SELECT p, threshold, i, unnest(string_split(substr(p, i, 20), '')) AS ch FROM w),
n AS (SELECT p, threshold, i, ch, count(*) AS n FROM ch GROUP BY ALL),
h AS (SELECT p, threshold, i, log2(20) - sum(n * log2(n)) / 20 AS bits FROM n GROUP BY ALL),
high AS (SELECT p FROM h GROUP BY p, threshold HAVING max(bits) >= threshold),
secret AS (SELECT DISTINCT m FROM parts WHERE p IN (SELECT p FROM high)),
found AS (
  SELECT doc_id, rank, kind, m, start FROM c WHERE rank = 3 AND m IN (SELECT m FROM secret)
  UNION ALL SELECT c.doc_id, c.rank, c.kind, pe.m, c.start + pe.at FROM c JOIN pe ON pe.run = c.m JOIN judged ON judged.m = c.m
    WHERE c.rank = 3 AND NOT judged.allowed AND c.m NOT IN (SELECT m FROM secret) AND pe.m IN (SELECT m FROM secret)),
added AS (
  SELECT * FROM found f WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = f.doc_id AND b.start <= f.start
      AND f.start + length(f.m) <= b.start + length(b.m))),
spans AS (
  SELECT doc_id, rank, start, kind || ':' || start || ':' || (start + length(m)) AS span
  FROM (FROM base UNION ALL BY NAME SELECT * FROM added)),
g AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
    count(*) FILTER (rank = 2) AS n_hex, string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
    string_agg(span, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (doc_id)
""",
    "op11_importance_resampling": rf"""
WITH {_CRC_TABLE},
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS w FROM d),
qw AS (SELECT unnest(w) AS w FROM q),
words AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM qw)),
b AS (SELECT w, {_crc32('w')} % 10000 AS bucket FROM words, tab),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN b USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM qw JOIN b USING (w) GROUP BY 1),
g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM qw) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM b) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
m AS (
  SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY 1),
h AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM d LEFT JOIN m USING (doc_id)),
x AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM h),
r AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    sum((n_features >= 20)::INT) OVER () AS able FROM x)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM r
""",
    "op13_prefix_trie": rf"""
WITH {_CRC_TABLE},
said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role,
    md5(length(role) || ':' || role || text)) AS turns FROM said GROUP BY 1),
h AS (
  SELECT conv_id, turns, conv_id - (conv_id % 5 + 5) % 5 AS lender, {_crc32('conv_id::VARCHAR')} % 9 AS h FROM o, tab),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], h.turns[h.h + 1:]) AS path
  FROM h LEFT JOIN o b ON b.conv_id = h.lender),
p AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM r),
n AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '') AS ends FROM p GROUP BY 1, 2),
ch AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
v AS (
  SELECT n.node, depth, (n_children IS NULL)::BIGINT AS leaf,
    CASE WHEN depth > 0 THEN (n_convs - 1) * octet_length(encode(n.node[depth].text)) ELSE 0 END AS saved
  FROM n LEFT JOIN ch USING (node)),
up AS (SELECT node, leaf, saved, unnest(range(0, depth + 1)) AS e FROM v),
total AS (SELECT node[1:e] AS node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY 1)
SELECT n.conv_id, n.depth, parent.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children,
  n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN total USING (node) LEFT JOIN ch USING (node)
  LEFT JOIN n parent ON n.depth > 0 AND parent.node = n.node[1:n.depth - 1]
""",
}
