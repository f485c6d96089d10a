"""DuckDB SQL for the operators that SQL can express; ``{docs}`` is the table they read."""

from __future__ import annotations

from saleslake.llm.quality_rules import STOP_WORDS

_SPLIT = r"regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+')"
_WORDS = f"list_filter({_SPLIT}, lambda w: w <> '')"

QUALITY = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM {{docs}}),
windows AS (
  SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM base)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + d) AS n
  FROM repeated, (VALUES (0), (1), (2)) AS v(d) GROUP BY r),
counts AS (
  SELECT doc_id, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    len(list_filter(words, lambda w: list_contains([{", ".join(f"'{w}'" for w in STOP_WORDS)}], w)))
      AS n_stop_words
  FROM base LEFT JOIN covered USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_words >= 50 AND 2 * n_repeat_words <= n_words
    AND 2 * word_chars BETWEEN 5 * n_words AND 24 * n_words
    AND 10 * n_symbols <= n_words AND 25 * n_stop_words >= n_words
    AND 2 * n_dup_lines <= n_lines AS kept
FROM counts
"""

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 9))::BIGINT AS h
  FROM {{docs}}),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS cap,
    1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight FROM totals),
filled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
      ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS remaining,
    (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS among
  FROM ranked),
marked AS (SELECT *, cap::DOUBLE / weight <= remaining / among AS capped FROM filled),
free AS (
  SELECT remaining AS rate_remaining, among AS rate_among FROM marked WHERE NOT capped
  ORDER BY among DESC LIMIT 1),
aims AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE
    ELSE weight * rate_remaining / rate_among END AS target
  FROM marked LEFT JOIN free ON TRUE),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM aims),
cells AS (
  SELECT source, h, sum(size) AS words,
    sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM sized GROUP BY source, h)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE
    WHEN upto <= target - whole * source_size THEN 1
    WHEN upto - words <= target - whole * source_size
      AND (target - whole * source_size - (upto - words)) * 2 >= words THEN 1
    ELSE 0 END))::BIGINT AS taken
FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source
JOIN cells ON sized.source IS NOT DISTINCT FROM cells.source AND sized.h = cells.h
"""

AUDIT = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS words FROM {{docs}}),
judged AS (
  SELECT part, doc_id, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS e
  FROM texts),
labelled AS (
  SELECT doc_id, max(coalesce(quality = 1, FALSE)) AS good, max(coalesce(toxic = 1, FALSE)) AS toxic
  FROM {{labels}} WHERE doc_id IS NOT NULL GROUP BY doc_id),
kinds AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END)
      || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END)
      || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
    count(*) AS n, count_if(coalesce(good, FALSE)) AS good, count_if(coalesce(toxic, FALSE)) AS toxic
  FROM judged LEFT JOIN labelled USING (doc_id) GROUP BY ALL),
orders AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(f)
  WHERE NOT contains(filter_order, f)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before,
    substr(filter_order, step + 1) AS behind
  FROM orders, (VALUES (1), (2), (3), (4), (5)) AS v(step) WHERE length(filter_order) = 5),
met AS (
  SELECT part, filter_order, step, s.f, n, good, toxic, contains(fails, s.f) AS hit,
    before <> '' AND regexp_matches(fails, '[' || before || '.]') AS gone,
    fails = s.f AS sole
  FROM kinds, steps AS s),
summed AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (NOT gone AND NOT hit) AS kept,
    sum(n) FILTER (NOT gone AND hit) AS removed, sum(n) FILTER (gone AND hit) AS redundant,
    sum(n) FILTER (sole) AS unique_fails, sum(good) FILTER (NOT gone AND hit) AS good_lost,
    sum(toxic) FILTER (NOT gone AND hit) AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept,
  coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM summed
"""

DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM {docs}),
found AS (
  SELECT r, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM found GROUP BY ALL HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS n_lang,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS n_group
  FROM groups AS g JOIN kept AS k ON g.lang = k.lang
  LEFT JOIN counts AS c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
rates AS (
  SELECT lang, source, term, c.n,
    1 + (1000000000::HUGEINT * (c.n + 1)) // (n_group + v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (n_lang + 1)) // (l.n + v)::HUGEINT AS q
  FROM cells AS c JOIN langs AS l USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM rates AS a JOIN rates AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM rates WHERE n > 0 AND p > q),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs AS p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', item, value FROM terms),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
