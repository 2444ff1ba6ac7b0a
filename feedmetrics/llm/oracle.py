"""DuckDB SQL for the registered queries that SQL can express, by plainer ways than the operators'."""

from __future__ import annotations

# Runs of lines: the shortest with 50 words from each line and to each line, as whole lists of
# lines; a run is a later copy where an equal list begins earlier.
LINE_DEDUP = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, lines, unnest(range(len(lines))) AS i,
             unnest(list_transform(lines, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))) AS w FROM docs),
c AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING), 0) AS upto FROM l),
onward AS (SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= 50 GROUP BY ALL),
back AS (SELECT a.doc_id, max(b.i) AS s, a.i AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i <= a.i AND a.upto - b.upto + b.w >= 50 GROUP BY ALL),
runs AS (SELECT DISTINCT r.doc_id, s, e, list_slice(d.lines, s + 1, e + 1) AS run FROM (SELECT * FROM onward UNION SELECT * FROM back) r JOIN docs d USING (doc_id)),
later AS (SELECT doc_id, s, e FROM (SELECT *, min((doc_id, s)) OVER (PARTITION BY run) AS first FROM runs) WHERE first < (doc_id, s)),
gone AS (SELECT DISTINCT c.doc_id, c.i FROM c JOIN later r ON c.doc_id = r.doc_id AND c.i BETWEEN r.s AND r.e),
left_ AS (SELECT l.doc_id, string_agg(l.lines[l.i + 1], chr(10) ORDER BY l.i) AS text FROM l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(n.n, 0) AS BIGINT) AS n_deleted, t.text
FROM docs d LEFT JOIN left_ t USING (doc_id) LEFT JOIN n USING (doc_id)
"""

JACCARD = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s FROM docs),
n AS (SELECT doc_id, len(s) AS n FROM sets),
rows_ AS (SELECT doc_id, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM rows_ a JOIN rows_ b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.y) AS component_id FROM n JOIN reach r ON r.x = n.doc_id GROUP BY n.doc_id, n.n
"""

CHAT = r"""
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i FROM conversations),
p AS (SELECT conv_id, i, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS turns, max(i) OVER (PARTITION BY conv_id) AS n FROM t),
begun AS (SELECT DISTINCT turns FROM p WHERE i < n),
kept AS (SELECT min(conv_id) AS conv_id, turns FROM p WHERE i = n AND turns NOT IN (SELECT turns FROM begun) GROUP BY turns)
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns,
       array_to_string(list_transform(turns, lambda x: '<|im_start|>' || coalesce(x.r, '') || chr(10) || coalesce(x.t, '') || '<|im_end|>' || chr(10)), '') AS text
FROM kept
"""

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS original FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, CAST(5 * i // 4 + 1 AS INT), 2) AS INT) >> CAST(3 - (5 * i) % 4 AS INT)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> original THEN original END AS refers_to
FROM d
"""

# Levels by recursion; crc32 bit by bit.
MERKLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, lang, n_chars, text FROM documents),
crc AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda k: [CAST(ascii(substr(CAST(doc_id AS VARCHAR), k, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
                             lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))) AS c
  FROM (SELECT DISTINCT doc_id FROM d WHERE doc_id IS NOT NULL)),
f AS (
  SELECT d.doc_id, source, coalesce(text, '') AS t,
         coalesce(octet_length(encode(CAST(d.doc_id AS VARCHAR))) || ':' || d.doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
         text, CASE WHEN xor(c, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM d LEFT JOIN crc ON crc.doc_id = d.doc_id),
h AS (
  SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(octet_length(encode(changed)) || ':' || changed, '-')) AS other FROM f),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM h),
nodes(source, level, i, node, n) AS (
  SELECT source, 0, i, leaf, n FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(node, '' ORDER BY i)), any_value((n + 2) // 3) FROM nodes WHERE n > 1 GROUP BY source, level, i // 3),
subroots AS (SELECT source, node AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, i, node, n) AS (
  SELECT 0, i, subroot, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(node, '' ORDER BY i)), any_value((n + 2) // 3) FROM tops WHERE n > 1 GROUP BY level, i // 3),
root AS (SELECT node AS root, level AS height FROM tops WHERE n = 1),
below AS (
  SELECT l.source, l.i, x.level, coalesce(string_agg(y.node, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS before, coalesce(string_agg(y.node, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS after
  FROM leaves l JOIN nodes x ON x.source IS NOT DISTINCT FROM l.source AND x.n > 1 AND x.i = l.i // CAST(pow(3, x.level) AS BIGINT)
  JOIN nodes y ON y.source IS NOT DISTINCT FROM x.source AND y.level = x.level AND y.i // 3 = x.i // 3 GROUP BY ALL),
above AS (
  SELECT s.source, s.height + x.level AS level, coalesce(string_agg(y.node, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS before, coalesce(string_agg(y.node, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS after
  FROM subroots s JOIN tops x ON x.n > 1 AND x.i = s.i // CAST(pow(3, x.level) AS BIGINT) JOIN tops y ON y.level = x.level AND y.i // 3 = x.i // 3 GROUP BY ALL),
steps AS (SELECT source, i, level, before, after FROM below
          UNION ALL SELECT a.source, l.i, a.level, a.before, a.after FROM above a JOIN leaves l ON l.source IS NOT DISTINCT FROM a.source),
listed AS (SELECT source, i, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256, list(before ORDER BY level) AS b, list(after ORDER BY level) AS a FROM steps GROUP BY source, i),
folds(source, i, k, node, b, a) AS (
  SELECT l.source, l.i, 0, l.other, coalesce(s.b, []), coalesce(s.a, []) FROM leaves l LEFT JOIN listed s ON s.source IS NOT DISTINCT FROM l.source AND s.i = l.i
  UNION ALL
  SELECT source, i, k + 1, sha256(b[k + 1] || node || a[k + 1]), b, a FROM folds WHERE k < len(b))
SELECT l.doc_id, l.leaf, u.subroot, r.root, coalesce(s.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = r.root AS verified
FROM leaves l JOIN subroots u ON u.source IS NOT DISTINCT FROM l.source CROSS JOIN root r
LEFT JOIN listed s ON s.source IS NOT DISTINCT FROM l.source AND s.i = l.i
JOIN folds f ON f.source IS NOT DISTINCT FROM l.source AND f.i = l.i AND f.k = len(f.b)
"""

SQL: dict[str, str] = {
    "op4_line_dedup": LINE_DEDUP,
    "op5_jaccard": JACCARD,
    "op7_chat": CHAT,
    "op8_warc": WARC,
    "op11_merkle": MERKLE,
}
