"""SQL checks of the text operators that SQL can express."""

#: A walk over the rows of a conversation that keeps, per place in the pattern, the least
#: (cost, audit, repaired text); CRC-32 is computed from its table.
STRUCTURE_REPAIR = r"""
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(
    [i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) AS v
    FROM range(256) AS r(i))),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s
  FROM conversations),
coded AS (
  SELECT named.*, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 20 AS code
  FROM named, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM coded, range(2) AS r(copy) WHERE code != 0 AND (copy = 0 OR code = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos
  FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS letter, CASE
    WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault
  FROM placed),
priced AS (
  SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS must_go,
    CAST(coalesce(fault = 'truncated', false) AS BIGINT) AS extra,
    lag(letter) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM judged),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, {'c': CAST(0 AS BIGINT), 'a': '', 't': ''} AS z,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s,
    {'c': CAST(2 AS BIGINT), 'a': 'I', 't': 'user:' || chr(10)} AS u,
    {'c': CAST(4 AS BIGINT), 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)} AS d
  FROM (SELECT DISTINCT conv_id FROM priced)
  UNION ALL
  SELECT conv_id, pos, z, s, u, list_sort(list_filter(
    [d, CASE WHEN u IS NOT NULL THEN {'c': u.c + 2, 'a': u.a || 'I', 't': u.t || 'assistant:' || chr(10)} END],
    lambda x: x IS NOT NULL))[1] AS d
  FROM (
    SELECT conv_id, pos, z, s, d, list_sort(list_filter(list_append(list_transform([z, s, d],
      lambda x: CASE WHEN x IS NOT NULL THEN {'c': x.c + 2, 'a': x.a || 'I', 't': x.t || 'user:' || chr(10)} END), u),
      lambda x: x IS NOT NULL))[1] AS u
    FROM (
      SELECT w.conv_id, r.pos,
        CASE WHEN w.z IS NOT NULL THEN {'c': w.z.c + 3, 'a': w.z.a || 'D', 't': w.z.t} END AS z,
        list_sort(list_filter([
          CASE WHEN w.s IS NOT NULL THEN {'c': w.s.c + 3, 'a': w.s.a || 'D', 't': w.s.t} END,
          CASE WHEN NOT must_go AND letter = 's' AND w.z IS NOT NULL
            THEN {'c': w.z.c + extra, 'a': w.z.a || 'K', 't': w.z.t || role || ':' || text || chr(10)} END],
          lambda x: x IS NOT NULL))[1] AS s,
        list_sort(list_filter(list_append(
          list_transform([w.z, w.s, w.d], lambda x: CASE WHEN x IS NULL OR must_go THEN NULL
            WHEN letter = 'u' THEN {'c': x.c + extra, 'a': x.a || 'K', 't': x.t || role || ':' || text || chr(10)}
            ELSE {'c': x.c + extra + 2, 'a': x.a || 'R', 't': x.t || 'user:' || text || chr(10)} END),
          CASE WHEN w.u IS NOT NULL THEN {'c': w.u.c + 3, 'a': w.u.a || 'D', 't': w.u.t} END),
          lambda x: x IS NOT NULL))[1] AS u,
        list_sort(list_filter([
          CASE WHEN w.d IS NOT NULL THEN {'c': w.d.c + 3, 'a': w.d.a || 'D', 't': w.d.t} END,
          CASE WHEN w.u IS NULL OR must_go THEN NULL
            WHEN letter = 'a' THEN {'c': w.u.c + extra, 'a': w.u.a || 'K', 't': w.u.t || role || ':' || text || chr(10)}
            ELSE {'c': w.u.c + extra + 2, 'a': w.u.a || 'R', 't': w.u.t || 'assistant:' || text || chr(10)} END],
          lambda x: x IS NOT NULL))[1] AS d
      FROM walk w JOIN priced r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1))),
ended AS (
  SELECT conv_id, list_sort(list_filter([z, d], lambda x: x IS NOT NULL))[1] AS best FROM walk
  QUALIFY pos = max(pos) OVER (PARTITION BY conv_id)),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM priced GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
  coalesce(best.a, '') AS audit,
  sha256(CASE WHEN coalesce(best.t, '') = '' THEN '' ELSE left(best.t, length(best.t) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS gram
  FROM words, range(1, 6) AS r(k)),
counts AS (SELECT lang, k, gram, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM counts WHERE k > 1 AND f >= 100),
kept AS (
  SELECT * FROM often s WHERE NOT EXISTS (
    SELECT 1 FROM often b WHERE b.lang = s.lang AND b.k > s.k AND 100 * b.f >= 100 * s.f
      AND contains(' ' || b.gram || ' ', ' ' || s.gram || ' '))),
cuts AS (
  SELECT lang, gram AS phrase, f AS a, c.cut, array_to_string(string_split(gram, ' ')[:c.cut], ' ') AS front,
    array_to_string(string_split(gram, ' ')[c.cut + 1:], ' ') AS back
  FROM kept, range(1, 5) AS c(cut) WHERE c.cut < k),
scored AS (
  SELECT c.lang, phrase, a, x.f AS l, y.f AS r, n, cut,
    CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.gram = front
  JOIN counts y ON y.lang = c.lang AND y.gram = back JOIN totals t ON t.lang = c.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score FROM best
QUALIFY rank <= 2000
"""

GROUPED_PREFIX = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS gram FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 90 * (p.n + q.n - c)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reached r ON r.a = d.doc_id
GROUP BY d.doc_id, n
"""
