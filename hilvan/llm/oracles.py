"""SQL over the given tables for the queries that SQL can express."""

from __future__ import annotations

_SMALL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _terms(pattern: str, text: str = "text") -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_SMALL}), '{pattern}')"


_LETTERS = _terms(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_WORDS = _terms(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

OP11_SOURCES = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LETTERS} AS terms
  FROM documents),
each AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS total FROM each GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
used AS MATERIALIZED (
  SELECT e.lang, e.source, e.term, count(*) AS n FROM each e JOIN kept k ON k.lang = e.lang AND k.term = e.term
  GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v, sum(total) AS lang_whole FROM kept GROUP BY lang),
wholes AS (SELECT lang, source, sum(n) AS whole FROM used GROUP BY ALL),
groups AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(s.v, 0)::HUGEINT AS v, coalesce(s.lang_whole, 0)::HUGEINT AS lang_whole,
         coalesce(w.whole, 0)::HUGEINT AS whole
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes s ON s.lang = g.lang
  LEFT JOIN wholes w ON w.lang = g.lang AND w.source = g.source),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(u.n, 0) + 2)) // (g.whole + 2 * g.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 2)) // (g.lang_whole + 2 * g.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.v = 0),
rows AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 10
"""

OP13_SEARCH = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS terms FROM documents),
items AS MATERIALIZED (
  SELECT DISTINCT i, item_id, unnest(terms) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, {_WORDS} AS terms FROM benchmark)),
whole AS (SELECT count(*) AS n, sum(len(terms)) AS l FROM docs WHERE len(terms) > 0),
posted AS MATERIALIZED (
  SELECT r, doc_id, len(terms) AS size, term, count(*) AS tf
  FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(whole.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM posted, whole GROUP BY term),
scores AS (
  SELECT i, item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * whole.n) // whole.l))))::BIGINT AS score
  FROM posted JOIN weights USING (term) JOIN items USING (term), whole GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r))::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""

_ITEM_WORDS = _terms(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

OP4_DECONTAMINATE = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[i:i + 9], ' ') AS key
  FROM (SELECT *, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS i FROM items WHERE len(words) > 0)),
places AS (
  SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS key
  FROM (SELECT r, words, unnest(generate_series(1, len(words))) AS i FROM docs), (SELECT DISTINCT size FROM windows)
  WHERE i + size - 1 <= len(words)),
found AS MATERIALIZED (
  SELECT DISTINCT r, i, size, item_id::VARCHAR AS item FROM places JOIN windows USING (size, key)),
hits AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS x FROM found) GROUP BY r),
held AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(held.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, hits.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN held USING (r)
"""

_BLANK = r"[\x20\x09-\x0D]"

OP9_QUALITY = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{_BLANK}+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 2], ' ') AS key
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS i FROM docs WHERE len(words) > 2)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, key) > 1),
covered AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS x FROM again) GROUP BY r),
counts AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(t, '!')) AS n_shouts
  FROM docs LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 2 * n_shouts <= n_words
         AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND 2 * n_dup_lines <= n_lines AS kept
FROM judged
"""

OP10_JACCARD = rf"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), {_SMALL}), '{_BLANK}+'), lambda x: x <> '') AS words
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(words[i:i + 4], ' ') AS key
  FROM (SELECT r, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS i FROM docs WHERE len(words) > 0)),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
  SELECT x.r AS a, y.r AS b, count(*) AS o FROM shingles x JOIN shingles y ON x.key = y.key AND x.r < y.r GROUP BY x.r, y.r),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * o >= 80 * (p.n + q.n - o)),
steps AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT r, r FROM docs UNION SELECT reach.a, steps.b FROM reach JOIN steps ON reach.b = steps.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(e.doc_id) AS component_id
FROM reach JOIN docs d ON d.r = reach.a JOIN docs e ON e.r = reach.b LEFT JOIN sizes ON sizes.r = reach.a
GROUP BY reach.a, d.doc_id
"""
