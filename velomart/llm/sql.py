"""DuckDB twins of the queries that SQL can express.

Each spells out its own logic and constants; only the tables of license sentences and rules are
taken over, being long fixed values.
"""

from __future__ import annotations

from velomart.llm.licenses import ALL_RULES, ALL_SENTENCES

MIX = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight,
         (sum(source_size) OVER ())::BIGINT AS total
  FROM s),
o AS (
  SELECT *, coalesce(sum(source_size) OVER before, 0)::BIGINT AS held,
         (sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT AS open_weight
  FROM w
  WINDOW before AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT max((1.5 * total::DOUBLE - 2 * held) / open_weight) AS level
  FROM o),
t AS (
  SELECT source, source_size, coalesce(least(weight * level, source_size * 2.0), 0.0)::DOUBLE AS target,
         ('0x' || substr(md5(coalesce('=' || source, 'null') || '/20'), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM o, l),
p AS (
  SELECT doc_id, source, size,
         row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST) - 1 AS place
  FROM d)
SELECT p.doc_id, p.size, t.source_size, t.target,
       CASE WHEN t.source_size = 0 THEN 0 ELSE size * least(2,
         floor(u + (place + 1) * (target / source_size)) - floor(u + place * (target / source_size))) END::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""

URL_FILTER = r"""
WITH RECURSIVE r AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages),
u0 AS (
  SELECT url, count(*)::BIGINT AS rows,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM r GROUP BY url),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (
  SELECT url, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS ruled
  FROM u0 JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
  GROUP BY url),
bits AS (
  SELECT range AS b FROM range(8)),
crc AS (  -- CRC-32 of each byte value
  SELECT range::BIGINT AS byte, list_reduce([range::BIGINT] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256)),
tab AS (SELECT list(v ORDER BY byte) AS t FROM crc),
u AS (
  SELECT u0.*, f.rule, f.ruled,
         f.ruled IS NOT NULL AND xor(list_reduce([4294967295::BIGINT] ||
           list_transform(string_split(regexp_replace(hex(encode(url)), '(..)', '\1,', 'g'), ',')[:-2],
                          lambda x: ('0x' || x)::BIGINT),
           lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0 AS held
  FROM u0 LEFT JOIN f USING (url) CROSS JOIN tab),
w AS (
  SELECT url, rows, ruled, held,
         unnest([substr(repeat(chr(2), 4) || url, e, 5) FOR e IN range(1, length(url) + 1)]) AS win
  FROM u),
c AS (
  SELECT win, coalesce(sum(rows) FILTER (WHERE ruled = 'allow' AND NOT held), 0)::BIGINT AS a,
         coalesce(sum(rows) FILTER (WHERE ruled = 'block' AND NOT held), 0)::BIGINT AS b
  FROM w GROUP BY win),
g AS (
  SELECT k, right(win, (k + 1)::INT) AS gram, sum(a)::BIGINT AS a, sum(b)::BIGINT AS b
  FROM c, range(5) AS x(k) GROUP BY ALL),
m AS (
  SELECT k, gram, a, b, sum(a) OVER ctx AS na, sum(b) OVER ctx AS nb,
         count(*) FILTER (WHERE a > 0) OVER ctx AS ta, count(*) FILTER (WHERE b > 0) OVER ctx AS tb
  FROM g WINDOW ctx AS (PARTITION BY k, left(gram, k::INT))),
p AS (
  SELECT k, gram,
         CASE WHEN na + ta > 0 THEN (a + ta * (1.0::DOUBLE / 65536)) / (na + ta)::DOUBLE ELSE 1.0::DOUBLE / 65536 END AS pa,
         CASE WHEN nb + tb > 0 THEN (b + tb * (1.0::DOUBLE / 65536)) / (nb + tb)::DOUBLE ELSE 1.0::DOUBLE / 65536 END AS pb
  FROM m WHERE k = 0
  UNION ALL
  SELECT m.k, m.gram,
         CASE WHEN na + ta > 0 THEN (a + ta * pa) / (na + ta)::DOUBLE ELSE pa END,
         CASE WHEN nb + tb > 0 THEN (b + tb * pb) / (nb + tb)::DOUBLE ELSE pb END
  FROM m JOIN p ON m.k = p.k + 1 AND right(m.gram, p.k::INT + 1) = p.gram),
s AS (
  SELECT url, (sum(round((ln(pa) - ln(pb)) * 1e9)::BIGINT)::DOUBLE / count(*)) / 1e9 AS score
  FROM w JOIN p ON p.k = 4 AND p.gram = w.win GROUP BY url),
sc AS (SELECT u.*, coalesce(score, 0.0) AS score FROM u LEFT JOIN s USING (url)),
h AS (
  SELECT floor(least(greatest(score, -5.0::DOUBLE), 5.0::DOUBLE) / 0.005::DOUBLE)::BIGINT AS slot,
         sum(CASE WHEN ruled = 'allow' THEN rows ELSE 0 END) AS a,
         sum(CASE WHEN ruled = 'block' THEN rows ELSE 0 END) AS b
  FROM sc WHERE held GROUP BY slot),
e AS (
  SELECT slot, coalesce(sum(a) OVER lower_slots, 0)::DOUBLE / nullif(sum(a) OVER (), 0)
             + (sum(b) OVER () - coalesce(sum(b) OVER lower_slots, 0))::DOUBLE / nullif(sum(b) OVER (), 0) AS err
  FROM h WINDOW lower_slots AS (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT coalesce((SELECT slot FROM e WHERE err IS NOT NULL ORDER BY err, abs(slot), slot LIMIT 1), 0)
         * 0.005::DOUBLE AS cut)
SELECT r.page_id, sc.host, sc.path, sc.rule,
       coalesce(sc.ruled, CASE WHEN sc.score >= t.cut THEN 'allow' ELSE 'block' END) AS verdict,
       round(sc.score, 9) AS score
FROM r JOIN sc USING (url), t
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_matches(role || text, '[<\[]\\+(/?s>|/?INST\])') OR contains(role || text, '</s>')
            OR contains(role, '[/INST]') AS clash,
         len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\])'))
         + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\])')) AS marks
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(20 + length(role) + length(text) + CASE WHEN clash THEN marks ELSE 0 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::DOUBLE) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score
FROM s
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 20
"""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls, text FROM documents),
l AS (
  SELECT doc_id, pos, ls[pos + 1] AS line, len(regexp_extract_all(ls[pos + 1], '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS pos FROM d)),
c AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS upto FROM l),
pairs AS (  -- stretches of 50 words or more
  SELECT a.doc_id, a.pos AS lo, b.pos AS hi
  FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.pos <= b.pos AND b.upto - a.upto + a.words >= 50),
runs AS (  -- the shortest from each line on, and up to each line
  SELECT doc_id, lo, min(hi) AS hi FROM pairs GROUP BY doc_id, lo
  UNION SELECT doc_id, max(lo), hi FROM pairs GROUP BY doc_id, hi),
copies AS (
  SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY ls[lo + 1:hi + 1] ORDER BY doc_id, lo) AS nth
  FROM runs JOIN d USING (doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM copies WHERE nth > 1),
spans AS (
  SELECT doc_id, min(pos) AS lo, max(pos) AS hi
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM gone)
  GROUP BY doc_id, island),
s AS (
  SELECT doc_id, sum(hi - lo + 1) AS n, string_agg(lo || '-' || hi, ',' ORDER BY lo) AS removed
  FROM spans GROUP BY doc_id),
k AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS kept
  FROM l ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(d.ls)::BIGINT AS n_lines, coalesce(s.n, 0)::BIGINT AS n_removed,
       coalesce(s.removed, '') AS removed,
       sha256(CASE WHEN s.n IS NULL THEN d.text ELSE coalesce(k.kept, '') END) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TAG = "SPDX-License-Identifier:"
#: Lines are cleared of leading marks one by one; runs of lines inside a sentence are spelled out and
#: joined with the known sentences, and of overlapping runs the first and longest stays.
LICENSES = rf"""
WITH RECURSIVE known(id, txt) AS (VALUES {", ".join(f"({k}, {_text(s)})" for k, s in ALL_SENTENCES.items())}),
s AS (SELECT id, trim(regexp_replace(lower(txt), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS txt FROM known),
r(n, license, ids) AS (VALUES {", ".join(f"({n}, {_text(r.license)}, {list(r.sentences)})" for n, r in enumerate(ALL_RULES, 1))}),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l0 AS (SELECT rid, unnest(string_split(replace(text, chr(2), ' '), chr(10))) AS line,
              generate_subscripts(string_split(text, chr(10)), 1) AS nth FROM d),
l1 AS (
  SELECT rid, nth, CASE WHEN contains(line, '{_TAG}') THEN
      split_part(line, '{_TAG}', 1) || '{_TAG}' || regexp_replace(regexp_replace(
        substr(line, strpos(line, '{_TAG}') + {len(_TAG)}),
        '[ \t)]+WITH[ \t(]+[A-Za-z0-9.+-]+', '', 'g'), '[ \t)]+(?:OR|AND)[ \t(]+', '. {_TAG} ', 'g')
    ELSE line END AS line
  FROM l0),
l2 AS (SELECT rid, nth, regexp_replace(line, '^[^\p{{L}}\p{{N}}]+', '') AS line FROM l1),
t AS (
  SELECT rid, regexp_replace(regexp_replace(string_agg(lower(line), chr(10) ORDER BY nth),
           '\n\n+|[.!?;:]+([ \t\n\x0B\f\r])', chr(2) || '\1', 'g'), '[.!?;:]+$', chr(2)) AS text
  FROM l2 GROUP BY rid),
p0 AS (SELECT rid, string_split(text, chr(2)) AS parts FROM t),
p AS (SELECT rid, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM p0),
w AS (
  SELECT rid, pos, list_filter(list_transform(string_split(part, chr(10)),
           lambda x: trim(regexp_replace(x, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), lambda x: x <> '') AS lines
  FROM p),
i AS (SELECT rid, pos, lines, unnest(range(1, len(lines) + 1)) AS a FROM w),
j AS (SELECT rid, pos, lines, a, unnest(range(a, least(len(lines), a + 79) + 1)) AS b FROM i
      WHERE EXISTS (SELECT 1 FROM s WHERE starts_with(s.txt, lines[a]))),
h AS (SELECT rid, pos, a, b, id FROM j JOIN s ON array_to_string(lines[a : b], ' ') = s.txt),
g AS (SELECT rid, pos, list({{'a': a, 'b': b, 'ids': [id]}} ORDER BY a, b DESC) AS hits FROM h GROUP BY rid, pos),
k AS (
  SELECT rid, pos, list_reduce(list_prepend({{'a': 0::BIGINT, 'b': 0::BIGINT, 'ids': []::INTEGER[]}}, hits),
    lambda x, y: CASE WHEN y.a > x.b THEN {{'a': y.a, 'b': y.b, 'ids': list_concat(x.ids, y.ids)}} ELSE x END).ids AS ids
  FROM g),
q AS (SELECT rid, flatten(list(ids ORDER BY pos)) AS ids FROM k GROUP BY rid),
f AS (
  SELECT rid, 0 AS n, list_aggregate(list_transform(ids, lambda i: ' ' || i || ' '), 'string_agg', '') AS left_over,
         0::BIGINT AS matches, []::VARCHAR[] AS names
  FROM q
  UNION ALL
  SELECT rid, r.n, replace(left_over, pat, ','),
         matches + (length(left_over) - length(replace(left_over, pat, ','))) // (length(pat) - 1),
         CASE WHEN contains(left_over, pat) THEN list_append(names, license) ELSE names END
  FROM f JOIN (SELECT *, list_aggregate(list_transform(ids, lambda i: ' ' || i || ' '), 'string_agg', '') AS pat FROM r) r
    ON r.n = f.n + 1)
SELECT d.doc_id, coalesce(array_to_string(q.ids, ','), '') AS sentences, coalesce(f.matches, 0)::BIGINT AS matches,
       coalesce(array_to_string(list_sort(list_distinct(f.names)), ','), '') AS licenses
FROM d LEFT JOIN q USING (rid) LEFT JOIN f ON f.rid = d.rid AND f.n = {len(ALL_RULES)}
"""

#: Operator 12: every phrase of one to five words is spelled out and counted as text.
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), total AS (
  SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), phrases AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)
  GROUP BY ALL
  HAVING count(*) >= 100
), cuts AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM phrases WHERE k > 1
), scores AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, cuts.f AS a, head.f AS l, tail.f AS r, n, c,
         (1000::HUGEINT * cuts.f * n) // (head.f::HUGEINT * tail.f) AS score
  FROM cuts JOIN total USING (lang)
  JOIN phrases head ON head.lang = cuts.lang AND head.phrase = array_to_string(w[1 : c], ' ')
  JOIN phrases tail ON tail.lang = cuts.lang AND tail.phrase = array_to_string(w[c + 1 : ], ' ')
), worst AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), alone AS (
  SELECT * FROM worst WHERE NOT EXISTS (
    SELECT 1 FROM phrases longer
    WHERE longer.lang = worst.lang AND longer.k > worst.k AND 100 * longer.f >= 100 * worst.a
      AND contains(' ' || longer.phrase || ' ', ' ' || worst.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM alone QUALIFY rank <= 2000
"""

#: Operator 13: the cheapest edits forwards, row by row, with the best (cost, audit) of each state.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE table_of_crc AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, [0::UBIGINT for z in range(8)]),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256))::UBIGINT AS i))),
rows0 AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
rows1 AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
      list_prepend(4294967295::UBIGINT, [ascii(x)::UBIGINT for x in string_split(key, '')]),
      lambda c, b: xor(c >> 8, crc[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 20 AS damage
  FROM rows0, table_of_crc),
rows2 AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE damage WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM rows1 WHERE damage <> 0),
rows3 AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n FROM rows2),
turns AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
         WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?')
         THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair
  FROM rows3),
chains(state, became, added) AS (VALUES
  ('', '', []::VARCHAR[]), ('', 'u', ['user:']), ('', 'a', ['user:', 'assistant:']), ('s', 's', []),
  ('s', 'u', ['user:']), ('s', 'a', ['user:', 'assistant:']), ('u', 'u', []), ('u', 'a', ['assistant:']),
  ('a', 'a', []), ('a', 'u', ['user:'])),
whole(state, following, spelled) AS (VALUES ('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, '' AS state, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS way FROM turns
  UNION ALL
  SELECT conv_id, n, state, min(way) AS way FROM (
    SELECT t.conv_id, t.n, e.state,
      {'cost': b.way.cost + 3 * len(c.added) + e.cost,
       'audit': b.way.audit || repeat('I', len(c.added)) || e.letter,
       'lines': list_concat(list_concat(b.way.lines, c.added), e.lines)} AS way
    FROM best b JOIN turns t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.n = b.n + 1
    JOIN chains c ON c.state = b.state
    JOIN whole w ON w.state = c.became,
    LATERAL (
      SELECT c.became AS state, 4 AS cost, 'D' AS letter, []::VARCHAR[] AS lines
      UNION ALL
      SELECT t.initial, CASE t.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [t.role || ':' || t.text]
      WHERE t.fault NOT IN ('blank', 'duplicate') AND (t.initial = w.following OR (t.initial = 's' AND c.became = ''))
      UNION ALL
      SELECT w.following, CASE t.fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', [w.spelled || ':' || t.text]
      WHERE t.fault NOT IN ('blank', 'duplicate')) e) steps
  GROUP BY conv_id, n, state),
ended AS (
  SELECT b.conv_id, min({'cost': way.cost + 3 * len(c.added), 'audit': way.audit || repeat('I', len(c.added)),
                         'lines': list_concat(way.lines, c.added)}) AS way
  FROM best b JOIN chains c ON c.state = b.state AND c.became IN ('', 'a')
  WHERE b.n = (SELECT max(n) FROM turns t WHERE t.conv_id IS NOT DISTINCT FROM b.conv_id) GROUP BY b.conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.way.cost, 0)::BIGINT AS cost, coalesce(e.way.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
