"""DuckDB SQL of the queries that SQL can express."""

OP5 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM win), g AS (
  SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lens WHERE len(w) >= n)
), occ AS (SELECT g.doc_id, g.k, g.n, win.item_id FROM g JOIN win ON g.g = win.g AND g.n = win.n
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM occ) GROUP BY doc_id
), its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP1 = r"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP8 = r"""
WITH t AS (
  SELECT conv_id, list({'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')} ORDER BY turn, coalesce(role, 'unknown'), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), l AS (
  SELECT conv_id, turns, len(turns) - list_position(list_transform(list_reverse(turns), lambda x: x.role = 'assistant'), true) + 1 AS last
  FROM t WHERE list_contains(list_transform(turns, lambda x: x.role = 'assistant'), true)
), r AS (
  SELECT *, turns[last].text AS reply, coalesce(lead(turns[last].text) OVER (ORDER BY conv_id DESC), first_value(turns[last].text) OVER (ORDER BY conv_id DESC)) AS other FROM l
), p AS (
  SELECT conv_id, turns[: last - 1] AS before, reply, other, CASE WHEN reply = other THEN last ELSE last - 1 END AS n_common FROM r
), x AS (
  SELECT *, '<|assistant|>' || chr(10) AS h, replace(reply, '<|', '< |') || '<|end|>' || chr(10) AS c, replace(other, '<|', '< |') || '<|end|>' || chr(10) AS o,
    array_to_string(list_transform(before, lambda x: '<|' || x.role || '|>' || chr(10) || replace(x.text, '<|', '< |') || '<|end|>' || chr(10)), '') AS b
  FROM p
)
SELECT conv_id, CAST(n_common AS BIGINT) AS n_common, CASE WHEN reply = other THEN b || h || c ELSE b END AS prompt,
  CASE WHEN reply = other THEN '' ELSE h || c END AS chosen_completion, CASE WHEN reply = other THEN '' ELSE h || o END AS rejected_completion,
  CASE WHEN reply = other THEN '' ELSE '14:0,' || length(c) || ':1' END AS chosen_mask, CASE WHEN reply = other THEN '' ELSE '14:0,' || length(o) || ':1' END AS rejected_mask
FROM x
"""

OP9 = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fit AS (
  SELECT page_id, host, path, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS place
  FROM p JOIN r ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT p.page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fit ON p.page_id = fit.page_id AND place = 1
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source
), w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2.0::DOUBLE * source_size AS most FROM s
), fill AS (
  SELECT *, coalesce(sum(most) OVER o, 0) AS below, sum(weight) OVER (ORDER BY most / weight DESC, rank DESC) AS open,
    1.5::DOUBLE * sum(source_size) OVER () AS goal
  FROM w WINDOW o AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT (goal - below) / open AS level FROM fill WHERE most >= weight * ((goal - below) / open) ORDER BY most / weight, rank LIMIT 1
), t AS (
  SELECT source, rank, source_size, CAST(least(most, weight * level) AS DOUBLE) AS target FROM w, level
), n AS (SELECT greatest(1, CAST(ceil(count(*) / 200000.0) AS BIGINT)) AS shards, CAST(floor(1.5 * sum(size) / 32 + 0.5) AS BIGINT) AS seats FROM d
), r AS (
  SELECT d.*, rank, source_size, target, CAST('0x' || substr(key, 1, 8) AS BIGINT) % shards AS shard
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, n
), cells AS (
  SELECT rank, shard, sum(size) AS words, any_value(target) * sum(size) / any_value(source_size) AS votes FROM r GROUP BY rank, shard HAVING sum(size) > 0
), won AS (
  SELECT rank, shard, count(*) AS quota FROM (
    SELECT rank, shard, row_number() OVER (ORDER BY votes / (2 * k + 1) DESC, rank, shard) AS place
    FROM (SELECT *, unnest(range(0, CAST(ceil(2.0 * words / 32) AS BIGINT) + 2)) AS k FROM cells)
  ), n WHERE place <= seats GROUP BY rank, shard
), give AS (
  SELECT rank, shard, CAST(words AS BIGINT) AS words, CAST(least(coalesce(quota, 0), floor(2.0 * words / 32)) * 32 AS BIGINT) AS give FROM cells LEFT JOIN won USING (rank, shard)
), ring AS (
  SELECT r.*, coalesce(give // words, 0) AS rounds, coalesce(give % words, 0) AS rest,
    sum(size) OVER (PARTITION BY rank, shard ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM r LEFT JOIN give USING (rank, shard)
)
SELECT doc_id, size, source_size, target, CAST(rounds * size + greatest(0, least(size, rest - start)) AS BIGINT) AS taken FROM ring
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), c AS (
  SELECT *, len(w) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(w) + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(w) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT *, array_to_string(w[1 : least(x, y)], '') AS pre, array_to_string(w[least(x, y) + 1 : greatest(x, y)], '') AS mid, array_to_string(w[greatest(x, y) + 1 :], '') AS suf FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

OP13 = r"""
WITH RECURSIVE bits(i, v, k) AS (
  SELECT i, i, 0 FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS c FROM bits WHERE k = 8
), ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), crc(conv_id, s, v) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL SELECT conv_id, substr(s, 2), xor(v >> 8, CAST(c[xor(v & 255, ascii(s)) + 1] AS BIGINT)) FROM crc, tab WHERE s <> ''
), convs AS (SELECT conv_id, xor(v, 4294967295) % 6 AS h, conv_id - conv_id % 100 AS base FROM crc WHERE s = ''
), t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), r AS (
  SELECT c.conv_id, t.role, t.text, t.i FROM convs c JOIN t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL SELECT c.conv_id, t.role, t.text, t.i FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
), whole AS (
  SELECT c.conv_id, coalesce(x.turns, []) AS turns
  FROM convs c LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns FROM r GROUP BY conv_id) x ON x.conv_id = c.conv_id
), mem AS (SELECT conv_id, len(turns) AS n, d, turns[1 : d] AS node, turns[1 : d - 1] AS parent FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM whole)
), nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends, CASE WHEN d = 0 THEN 0 ELSE length(node[d].text) END AS chars
  FROM mem GROUP BY node, d
), kids AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent, d
), own AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.parent = n.node AND k.d = n.d
), up AS (SELECT node[1 : e] AS top, e, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * chars AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM own)
), total AS (SELECT top, e, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM up GROUP BY top, e)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN total ON total.top = o.node AND total.e = o.d LEFT JOIN nodes p ON o.d > 0 AND p.node = o.parent AND p.d = o.d - 1
"""

SQL: dict[str, str] = {"op8_preference_pairs": OP8, "op1_warc_revisits": OP1, "op9_bloom_cascade": OP9, "op4_sainte_lague": OP4, "op5_decontaminate": OP5, "op11_infill": OP11, "op13_centroid_trie": OP13}
