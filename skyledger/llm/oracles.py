"""Reference SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from skyledger.llm.mixing import MOST, SEED

ORACLES: dict[str, str] = {}

ORACLES["op7_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
coded AS (
  SELECT *, role || chr(10) || text || chr(10) AS said,
    length(replace(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '|', '&bar;'), '[', '&sq;'))
      + length('<||>' || chr(10) || '<|end|>' || chr(10)) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) + length('<s>') AS BIGINT) AS formatted_chars
FROM coded GROUP BY conv_id
"""

ORACLES["op9_decontamination"] = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
    array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
),
place AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
hit AS (SELECT r, i, n, item_id FROM place JOIN win USING (n, words)),
words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r
),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

ORACLES["op10_mix_sources"] = rf"""
WITH doc AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CASE WHEN length(text) > 0 THEN length(translate(text, '#*$%&|<>!', '')) / length(text) END AS plain,
    CAST('0x' || substr(md5(concat_ws('/', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''),
      coalesce(md5(text), ''))), 1, 12) AS BIGINT) AS bits
  FROM documents
),
keyed AS (
  SELECT *, -ln((CAST(bits AS DOUBLE) + 1) / 281474976710656.0)
    / CASE WHEN plain IS NULL THEN 1.0 ELSE greatest(plain * plain, 0.05) END AS key
  FROM doc
),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS nth
  FROM keyed GROUP BY source
),
level AS (
  SELECT *, {MOST} * source_size AS cap,
    CAST(sum(source_size) OVER () - coalesce(sum({MOST} * source_size) OVER up, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER up, 0) AS DOUBLE) AS level
  FROM sizes
  WINDOW up AS (ORDER BY {MOST} * source_size / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
target AS (
  SELECT source, source_size, CASE WHEN cap > level * weight
    THEN weight * first_value(level) OVER (ORDER BY cap > level * weight DESC, cap / weight, nth)
    ELSE CAST(cap AS DOUBLE) END AS target
  FROM level
),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM target
),
run AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sooner
  FROM keyed k JOIN budget b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST((epochs + CASE WHEN size > 0 AND (rest - sooner) / size >= 0.5 THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM run
"""

ORACLES["op4_repeated_passages"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
),
win AS (
  SELECT r, i, md5(array_to_string(w[i : i + 34], ' ')) AS m
  FROM (SELECT *, unnest(range(1, len(w) - 33)) AS i FROM doc WHERE len(w) >= 35)
),
again AS (SELECT m FROM win GROUP BY m HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN again USING (m)
),
word AS (SELECT r, p, w[p] AS word FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM doc)),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM word ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

# CRC-32 bit by bit: 3988292384 is its reversed polynomial.
ORACLES["op11_prefix_trie"] = r"""
WITH conv AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT conv_id, flatten(list_transform(range(1, length(name) + 1),
    lambda i: list_transform(range(0, 8), lambda k: (ord(name[i]) >> k) & 1))) AS b
  FROM conv
),
cut AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(b, lambda x: CAST(x AS BIGINT))),
      lambda c, x: xor(c >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 9 AS h
  FROM bits
),
turn AS (
  SELECT conv_id, token, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) - 1 AS pos
  FROM (SELECT conv_id, turn, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS token,
          strlen(coalesce(text, '')) AS n
        FROM conversations WHERE conv_id IS NOT NULL)
),
made AS (
  SELECT c.conv_id, 0 AS own, pos, token, n FROM cut c JOIN turn t ON t.conv_id = c.base WHERE pos < h
  UNION ALL
  SELECT c.conv_id, 1, pos, token, n FROM cut c JOIN turn t ON t.conv_id = c.conv_id WHERE pos >= h
),
seq AS (
  SELECT c.conv_id, coalesce(tokens, []) AS tokens, coalesce(sizes, []) AS sizes
  FROM conv c LEFT JOIN (
    SELECT conv_id, list(token ORDER BY own, pos) AS tokens, list(n ORDER BY own, pos) AS sizes
    FROM made GROUP BY conv_id) USING (conv_id)
),
place AS (
  SELECT conv_id, d, len(tokens) AS size, md5(array_to_string(tokens[1:d], ',')) AS node,
    CASE WHEN d > 0 THEN md5(array_to_string(tokens[1:d - 1], ',')) END AS parent,
    CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS n
  FROM (SELECT *, unnest(range(0, len(tokens) + 1)) AS d FROM seq)
),
node AS (
  SELECT node, min(conv_id) AS conv_id, min(d) AS depth, min(parent) AS parent, count(*) AS n_convs,
    min(n) AS n, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = size) AS ends
  FROM place GROUP BY node
),
child AS (SELECT parent AS node, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
pair AS (SELECT DISTINCT a.node, b.node AS below FROM place a JOIN place b ON a.conv_id = b.conv_id AND a.d <= b.d),
sums AS (
  SELECT p.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * n) AS saved
  FROM pair p JOIN node b ON p.below = b.node LEFT JOIN child c ON c.node = b.node GROUP BY p.node
)
SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM node v LEFT JOIN node up ON v.parent = up.node LEFT JOIN child c ON c.node = v.node JOIN sums s ON s.node = v.node
"""
