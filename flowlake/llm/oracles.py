"""SQL with the same rows, for the operators that SQL can express.

The others are compared with brute-force versions in the tests.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op5_warc": """
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM (
  SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest,
    CASE WHEN strlen(body) >= 100
      THEN min(page_id) OVER (PARTITION BY body) END AS first
  FROM (SELECT page_id, coalesce(html, '') AS body FROM pages)
)
""",
    "op6_url_filter": r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY page_id
      ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS turn
  FROM parts LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM fits WHERE turn = 1
""",
}
ORACLES["op12_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      AS text
  FROM documents
),
words AS (
  SELECT d, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
),
kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3
),
langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
),
occurring AS (
  SELECT lang, source, term, count(*) AS n
  FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
),
totals AS (
  SELECT g.lang, g.source, coalesce(sum(o.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN occurring o USING (lang, source)
  GROUP BY g.lang, g.source
),
-- Every group gives each kept term a share, and so does the language.
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(o.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(o.n, 0) + 1) // (t.total + l.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.n + 1) // (l.total + l.v) AS q
  FROM totals t JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN occurring o ON o.lang = t.lang AND o.source = t.source AND o.term = k.term
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    CAST(coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS BIGINT) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
),
terms AS (
  SELECT lang, source, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM shares WHERE n > 0 AND p > q
),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM terms
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 200
"""
