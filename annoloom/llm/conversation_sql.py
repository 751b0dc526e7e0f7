"""SQL of the conversation queries: structure repair as whole-string dynamic programming, the trie by all pairs of prefixes."""

from __future__ import annotations

#: CRC-32 of a text of ASCII characters, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS bigint)], list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS bigint))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, e: xor(d >> 1, CASE WHEN d & 1 = 1 THEN 3988292384 ELSE 0 END))))"""
#: Not one of the six white-space characters.
_SOLID = r"[^\x20\x09-\x0D]"

STRUCTURE_REPAIR = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format("coalesce(CAST(conv_id AS varchar), ' ') || ':' || coalesce(CAST(turn AS varchar), ' ')")} % 20 AS hit
  FROM conversations),
damaged AS MATERIALIZED (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE hit WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM given WHERE hit <> 0),
numbered AS (
  SELECT *, row_number() OVER w AS k, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
         lag(role[1]) OVER w || role[1] AS pair
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS MATERIALIZED (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{_SOLID}') THEN 'b' WHEN again > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault
  FROM numbered),
edge AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) v(state, initial, after)),
give AS (SELECT * FROM (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)) v(state, given, after)),
ways AS (
  SELECT DISTINCT conv_id, 0 AS k, 0 AS state, 0 AS cost, '' AS audit, CAST([] AS varchar[]) AS turns FROM conversations
  UNION ALL
  SELECT conv_id, k, state, cost, audit, turns FROM (
    WITH once AS (
      SELECT * FROM ways UNION ALL
      SELECT w.conv_id, w.k, g.after, w.cost + 2, w.audit || 'I', list_append(w.turns, g.given || ':') FROM ways w JOIN give g USING (state)),
    twice AS (
      SELECT * FROM once UNION ALL
      SELECT w.conv_id, w.k, g.after, w.cost + 2, w.audit || 'I', list_append(w.turns, g.given || ':') FROM once w JOIN give g USING (state)),
    moved AS (
      SELECT w.conv_id, j.k, w.state, w.cost + 3 AS cost, w.audit || 'D' AS audit, w.turns
      FROM twice w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.k = w.k + 1
      UNION ALL
      SELECT w.conv_id, j.k, e.after, w.cost + CASE fault WHEN 't' THEN 1 ELSE 0 END, w.audit || 'K', list_append(w.turns, role || ':' || text)
      FROM twice w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.k = w.k + 1
      JOIN edge e ON e.state = w.state AND e.initial = role[1] WHERE fault NOT IN ('b', 'd')
      UNION ALL
      SELECT w.conv_id, j.k, g.after, w.cost + 2 + CASE fault WHEN 't' THEN 1 ELSE 0 END, w.audit || 'R', list_append(w.turns, g.given || ':' || text)
      FROM twice w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.k = w.k + 1
      JOIN give g ON g.state = w.state WHERE fault NOT IN ('b', 'd'))
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS place FROM moved)
  WHERE place = 1),
last AS (
  SELECT w.* FROM ways w JOIN (SELECT conv_id, max(k) AS k FROM ways GROUP BY 1) m
       ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.k = w.k),
closed AS (
  SELECT conv_id, state, cost, audit, turns FROM last UNION ALL
  SELECT w.conv_id, g.after, w.cost + 2, w.audit || 'I', list_append(w.turns, g.given || ':') FROM last w JOIN give g USING (state) UNION ALL
  SELECT w.conv_id, h.after, w.cost + 4, w.audit || 'II', list_append(list_append(w.turns, g.given || ':'), h.given || ':')
  FROM last w JOIN give g USING (state) JOIN give h ON h.state = g.after),
best AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS place FROM closed WHERE state IN (0, 3)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY 1)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS bigint) AS cost, audit,
       sha256(array_to_string(turns, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id WHERE place = 1"""

PREFIX_TRIE = f"""
WITH t AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 100 AS donor, {_CRC.format('CAST(conv_id AS varchar)')} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS MATERIALIZED (
  SELECT conv_id, row_number() OVER w AS d, len(text) AS chars, lead(i) OVER w IS NULL AS ends,
         md5(string_agg(role || ':' || md5(text), '|') OVER w) AS node
  FROM (SELECT c.conv_id, 0 AS part, i, role, text FROM c JOIN t ON t.conv_id = donor AND i <= h
        UNION ALL SELECT c.conv_id, 1, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND i > h)
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
p AS MATERIALIZED (
  SELECT conv_id, d, chars, ends, node FROM r
  UNION ALL SELECT conv_id, 0, 0, conv_id NOT IN (SELECT conv_id FROM r), '' FROM c),
n AS MATERIALIZED (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY 1),
pairs AS MATERIALIZED (
  SELECT DISTINCT a.node AS top, b.node AS node, b.d - a.d AS below FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (
  SELECT top, count(*) FILTER (below = 1) AS n_children,
         count(*) FILTER (node NOT IN (SELECT top FROM pairs WHERE below = 1)) AS n_leaves,
         CAST(sum((n_convs - 1) * chars) AS bigint) AS saved_tokens
  FROM pairs JOIN n USING (node) GROUP BY 1),
parents AS (SELECT pairs.node, n.conv_id AS parent_conv_id FROM pairs JOIN n ON n.node = top WHERE below = 1)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM n JOIN sums ON top = n.node LEFT JOIN parents ON parents.node = n.node"""
