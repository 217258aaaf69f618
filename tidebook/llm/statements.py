"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

WORDS = r"""regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {WORDS.format(text="text")} AS words FROM benchmark
),
windows AS (
  SELECT DISTINCT item, len(pattern) AS m, array_to_string(pattern, ' ') AS pattern FROM (
    SELECT item, words[i : i + least(10, len(words)) - 1] AS pattern
    FROM (SELECT item, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
          FROM items WHERE len(words) > 0))
),
lengths AS (SELECT DISTINCT m FROM windows),
docs AS (
  SELECT row_number() OVER () AS n, doc_id, {WORDS.format(text="text")} AS words FROM documents
),
found AS (
  SELECT n, i, w.m AS m, item FROM (
    SELECT n, i, m, array_to_string(words[i : i + m - 1], ' ') AS pattern FROM (
      SELECT n, m, words, unnest(range(1, len(words) - m + 2)) AS i
      FROM docs, lengths WHERE len(words) >= m)) AS d
  JOIN windows AS w ON w.m = d.m AND w.pattern = d.pattern
),
hit AS (
  SELECT n, count(DISTINCT place) AS n_hit FROM (SELECT n, unnest(range(i, i + m)) AS place FROM found) GROUP BY n
),
listed AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item COLLATE "binary") AS items
  FROM (SELECT DISTINCT n, item FROM found WHERE item IS NOT NULL) GROUP BY n
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (n) LEFT JOIN listed USING (n)
"""

EXACT_DEDUP = r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM norm WINDOW same AS (PARTITION BY body)
"""

DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
places AS (SELECT n, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM places GROUP BY lang, term HAVING count(DISTINCT n) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
seen AS (
  SELECT lang, source, term, count(*) AS c FROM places JOIN (SELECT lang, term FROM kept) USING (lang, term) GROUP BY ALL
),
totals AS (SELECT lang, source, sum(c) AS n FROM seen GROUP BY ALL),
probable AS (
  SELECT g.lang, g.source, k.term, coalesce(s.c, 0) AS c,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(s.c, 0) + 1)) // (coalesce(t.n, 0) + l.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.c + 1)) // (l.n + l.v) AS q
  FROM groups AS g JOIN kept AS k ON k.lang = g.lang JOIN langs AS l ON l.lang = g.lang
  LEFT JOIN totals AS t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN seen AS s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM probable AS a JOIN probable AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
rows AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups AS g JOIN groups AS h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN sums AS s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM probable WHERE c > 0 AND p > q
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM rows
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

STATEMENTS = {
    "op2_decontamination": DECONTAMINATION,
    "op6_exact_dedup": EXACT_DEDUP,
    "op11_source_divergence": DIVERGENCE,
}
