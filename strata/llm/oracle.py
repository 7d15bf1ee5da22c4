"""DuckDB SQL of the queries that SQL can express, over whole tables."""

#: Rows whose vector is not null, empty or zero and has only finite components.
_VECTORS = """
vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

NEAREST = f"""
WITH {_VECTORS},
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, min(sqrt(list_reduce(list_transform(list_zip(q.v, c.v),
           lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b))) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
WHERE rank <= 10"""

#: Words at their places; a window is repeated if its words stand anywhere else.
REPEATS = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM split),
windows AS (
  SELECT *, CASE WHEN i <= n - 35 THEN md5(string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS h FROM placed),
counted AS (SELECT *, h IS NOT NULL AND count(h) OVER (PARTITION BY h) > 1 AS repeated FROM windows),
covered AS (
  SELECT *, bool_or(repeated) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text
  FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""

NEAR_DUPLICATES = """
WITH RECURSIVE
numbered AS (SELECT vec_id, embedding, row_number() OVER () AS r FROM embeddings),
unit AS (
  SELECT r, v, sqrt(list_dot_product(v, v)) AS size FROM (SELECT r, CAST(embedding AS DOUBLE[]) AS v FROM numbered
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
links AS (
  SELECT a.r AS a, b.r AS b FROM unit a JOIN unit b
  ON a.r <> b.r AND len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9),
reached AS (SELECT r, r AS other FROM numbered UNION SELECT x.r, l.b FROM reached x JOIN links l ON x.other = l.a),
least AS (SELECT x.r, min(n.vec_id) AS component_id FROM reached x JOIN numbered n ON n.r = x.other GROUP BY x.r),
counts AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM numbered JOIN least USING (r) LEFT JOIN counts USING (r)"""

#: Units, cut points and forms from the hash of the id; the restored text is the text.
FILL_IN_MIDDLE = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM split),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""

#: crc32 bit by bit: a byte is met, and -1 shifts once.
_CRC32 = """xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(str_split(CAST(conv_id AS VARCHAR), ''),
      lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

#: Every prefix of every rebuilt conversation by the hash of its turns; a node's ancestors are its smallest member's prefixes.
PREFIXES = rf"""
WITH keyed AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS i FROM keyed),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, n, h, least(h, coalesce(base_n, 0)) AS front
  FROM (SELECT conv_id, count(*) AS n, {_CRC32} % 4 AS h FROM turns GROUP BY conv_id)
  LEFT JOIN (SELECT conv_id AS base_id, count(*) AS base_n FROM turns GROUP BY conv_id) ON base_id = conv_id - conv_id % 20),
rebuilt AS (
  SELECT c.conv_id, 0 AS d, '' AS k, 0 AS words FROM convs c UNION ALL
  SELECT c.conv_id, t.i, t.k, t.words FROM convs c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h UNION ALL
  SELECT c.conv_id, t.i - c.h + c.front, t.k, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h),
prefixes AS (
  SELECT conv_id, d, words, string_agg(k, ',') OVER (PARTITION BY conv_id ORDER BY d) AS prefix,
         d = max(d) OVER (PARTITION BY conv_id) AS last FROM rebuilt),
members AS (SELECT *, min(conv_id) OVER (PARTITION BY d, prefix) AS owner FROM prefixes),
nodes AS (
  SELECT owner, d, count(*) AS n_convs, max(words) AS words,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last) AS ends FROM members GROUP BY owner, d),
parents AS (
  SELECT n.*, m.owner AS parent FROM nodes n LEFT JOIN members m ON m.conv_id = n.owner AND m.d = n.d - 1),
children AS (SELECT parent AS owner, d - 1 AS d, count(*) AS n_children FROM parents WHERE parent IS NOT NULL GROUP BY ALL),
counted AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p LEFT JOIN children USING (owner, d)),
sums AS (
  SELECT m.owner, m.d, sum((c.n_convs - 1) * c.words) AS saved, count(*) FILTER (WHERE c.n_children = 0) AS leaves
  FROM counted c JOIN members m ON m.conv_id = c.owner AND m.d <= c.d GROUP BY ALL)
SELECT owner AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM counted JOIN sums USING (owner, d)"""

ORACLE = {
    "op1_postings": NEAREST,
    "op8_substring": REPEATS,
    "op10_cap_filters": NEAR_DUPLICATES,
    "op11_fim": FILL_IN_MIDDLE,
    "op13_prefix_trie": PREFIXES,
}
