"""SQL for the operators that SQL can express."""

from __future__ import annotations

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
flags AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, map {
    'A': (len(words) < 200)::INT,
    'B': (100 * len(list_distinct(words)) < 50 * len(words))::INT,
    'C': (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text))::INT,
    'D': regexp_matches(text, '[#$%&*|]')::INT,
    'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT} AS f
  FROM words LEFT JOIN flags USING (doc_id)),
masks AS (SELECT part, f, good, toxic, count(*) AS n FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, string_split(filter_order[:step - 1], '') AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
seen AS (
  SELECT part, filter_order, step, letter, n, good, toxic, f[letter] AS here,
    len(list_filter(earlier, lambda x: x <> '' AND f[x] = 1)) > 0 AS gone,
    list_sum(map_values(f)) AS all_fails
  FROM steps, masks),
counts AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN NOT gone AND here = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT gone AND here = 1 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone AND here = 1 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN here = 1 AND all_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT gone AND here = 1 AND good = 1 THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND here = 1 AND toxic = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM seen GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counts
"""

_RANKED = rf"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    {_LOWERED.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
lengths AS (SELECT row, doc_id, len(words)::BIGINT AS n, words FROM words WHERE len(words) > 0),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    {_LOWERED.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
found AS (
  SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT row, doc_id, n, unnest(words) AS term FROM lengths)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM found, corpus GROUP BY term),
parts AS (
  SELECT row, doc_id, term,
    w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms)))) AS part
  FROM found JOIN weights USING (term), corpus),
scores AS (
  SELECT item_id, row, doc_id, sum(part)::BIGINT AS score
  FROM wanted JOIN parts USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 10
"""

_LINES = rf"""
WITH lines AS (
  SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place
  FROM (SELECT row_number() OVER () AS row, doc_id,
          string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
keys AS (
  SELECT *, {_LOWERED.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")}
    AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT row) >= 3),
told AS (
  SELECT keys.*, common.key IS NOT NULL AND keys.doc_id IS DISTINCT FROM keeper AS goes
  FROM keys LEFT JOIN common ON keys.key = common.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (goes)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT goes), '')) AS kept_sha256
FROM told GROUP BY row, doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_audit": _AUDIT, "op12_ranked": _RANKED, "op13_lines": _LINES}
