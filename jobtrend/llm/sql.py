"""DuckDB statements for the queries that SQL can express."""

from jobtrend.llm.url_rules import DEFAULT_VERDICT, RULES

_RULE_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

OP10_SQL = f"""
WITH rules(verdict, host, path) AS (VALUES {_RULE_VALUES}),
parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 2, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 3, 's'), '') AS path,
    row_number() OVER () AS n
  FROM pages),
best AS (
  SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT_VERDICT}') AS verdict
FROM parts LEFT JOIN best USING (n)
"""

# windows of 13 words as text between word separators: every start position is joined by equality
OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS n,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
starts AS (
  SELECT n, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT n, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM windows))),
found AS (SELECT n, i, m, item_id FROM starts JOIN windows USING (m, s)),
items AS (
  SELECT n, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM found GROUP BY n),
hits AS (
  SELECT n, count(DISTINCT k) AS n_hit
  FROM (SELECT n, unnest(range(i, i + m)) AS k FROM (SELECT DISTINCT n, i, m FROM found)) GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN items USING (n) LEFT JOIN hits USING (n)
"""
