"""Expected results of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
i AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS g
  FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(s) WHERE len(w) > 0),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM iw), unnest(range(1, len(w) - n + 2)) AS t(s) WHERE len(w) >= n),
hit AS (SELECT doc_id, item_id, s, n FROM dw JOIN iw USING (n, g)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# The fixed numbers are the parameters of the mix: weights 3, 1, 2; share 1.5; at most 2 copies; seed 17; texts below 50
# words half as likely.
MIX = """
WITH m AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
d AS (
  SELECT doc_id, source, size, CASE WHEN size < 50 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS pref,
         (CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 13)
               AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM m),
c AS (SELECT source, pref, sum(size)::DOUBLE AS words FROM d GROUP BY ALL),
s AS (
  SELECT source, sum(words) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM c GROUP BY source),
sw AS (
  SELECT source, source_size, pos, ([3, 1, 2])[(pos - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2 AS cap,
         sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s),
sr AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM sw),
t AS (
  SELECT source, source_size, CASE WHEN cap = 0 THEN 0 ELSE least(coalesce(
           max(rate) FILTER (WHERE rate * weight <= cap) OVER () * weight, cap), cap) END AS target FROM sr),
cw AS (
  SELECT c.source, pref, words, source_size, target, pref * words AS weight, words * 2 AS cap
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source),
cr AS (
  SELECT *, (target - coalesce(sum(cap) OVER (PARTITION BY source ORDER BY cap / weight, pref DESC
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (PARTITION BY source ORDER BY cap / weight, pref DESC
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM cw),
cd AS (
  SELECT *, CASE WHEN words > 0 THEN least(coalesce(
           max(rate) FILTER (WHERE rate * weight <= cap) OVER (PARTITION BY source) * weight, cap), cap) / words ELSE 0 END AS m
  FROM cr),
p AS (
  SELECT *, m - floor(m) AS p, target - sum(floor(m) * words) OVER (PARTITION BY source) AS rest FROM cd),
r AS (
  SELECT d.doc_id, d.source, d.size, p.source_size, p.target, floor(p.m) AS certain, p.rest,
         CASE WHEN p.p > 0 AND d.size > 0 THEN (d.u / (1 - d.u)) / (p.p / (1 - p.p)) END AS odds
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.pref = p.pref),
w AS (
  SELECT *, sum(size) OVER (PARTITION BY source, odds IS NULL ORDER BY odds / (1 + odds), doc_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached FROM r)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       ((certain + CASE WHEN odds IS NOT NULL AND reached - size / 2 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken,
       source, (certain + CASE WHEN odds IS NOT NULL AND reached - size / 2 <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM w
"""

_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + least(4, len(w)) - 1], ' ') AS g
  FROM d, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS t(s) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g AS a JOIN g AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) USING (doc_id)
"""

# Lower-cased texts have no A-Z, so the class without a-z and digits is that of the terms.
LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
tf AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, term, count(*) AS tf FROM d, unnest(w) AS t(term) GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
df AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs),
q AS (
  SELECT DISTINCT i, item_id, term
  FROM (SELECT row_number() OVER () AS i, item_id, {_ALNUM} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)), unnest(w) AS t(term)),
s AS (
  SELECT i, item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), total GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""

# Edits of a row and insertions in front of it move between what stands before: 0 nothing, 1 s, 2 u, 3 a. Two insertions
# reach whatever more of them could. A key is the cost with leading zeros, then the audit.
CONVERSATIONS = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, e: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
kinds AS (
  SELECT src.*, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 20 AS kind
  FROM src, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS c(copy) WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
r AS (
  SELECT *, substr(role, 1, 1) AS c, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN nth > 1 THEN 2
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault
  FROM o),
follows(p, c, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
names(c, name) AS (VALUES ('u', 'user'), ('a', 'assistant')),
one AS (SELECT p, q, name FROM follows JOIN names USING (c)),
ins AS (
  SELECT p, p AS q, '' AS e, CAST([] AS VARCHAR[]) AS added FROM (VALUES (0), (1), (2), (3)) AS s(p)
  UNION ALL SELECT p, q, 'I', [name || ':'] FROM one
  UNION ALL SELECT a.p, b.q, 'II', [a.name || ':', b.name || ':'] FROM one a JOIN one b ON b.p = a.q),
edits AS (
  SELECT p, q, c, 'K' AS e, 0 AS cost, NULL AS name FROM follows
  UNION ALL SELECT p, q, NULL, 'R', 3, name FROM one
  UNION ALL SELECT p, p, NULL, 'D', 4, NULL FROM (VALUES (0), (1), (2), (3)) AS s(p)),
moves AS (
  SELECT ins.p, edits.q, edits.c, edits.e AS edit, edits.name, ins.e || edits.e AS e, 3 * length(ins.e) + edits.cost AS cost, added
  FROM ins JOIN edits ON edits.p = ins.q),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS p, '000000000' AS key, CAST([] AS VARCHAR[]) AS lines FROM conversations
  UNION ALL
  SELECT conv_id, i, q, min(key), arg_min(lines, key)
  FROM (
    SELECT w.conv_id, r.i, m.q, list_concat(list_concat(w.lines, m.added), CASE m.edit WHEN 'K' THEN [r.role || ':' || r.text]
             WHEN 'R' THEN [m.name || ':' || r.text] ELSE [] END) AS lines,
           lpad(CAST(CAST(left(w.key, 9) AS INTEGER) + m.cost + CASE WHEN m.edit <> 'D' AND r.fault = 3 THEN 3 ELSE 0 END AS VARCHAR), 9, '0')
             || substr(w.key, 10) || m.e AS key
    FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN moves m ON m.p = w.p AND (m.edit <> 'K' OR m.c = r.c) AND (m.edit = 'D' OR r.fault IN (0, 3)))
  GROUP BY conv_id, i, q),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id),
goal AS (
  SELECT w.conv_id, min(k) AS key, arg_min(l, k) AS lines
  FROM (
    SELECT w.conv_id, w.i, list_concat(w.lines, ins.added) AS l,
           lpad(CAST(CAST(left(w.key, 9) AS INTEGER) + 3 * length(ins.e) AS VARCHAR), 9, '0') || substr(w.key, 10) || ins.e AS k
    FROM walk w JOIN ins ON ins.p = w.p AND ins.q IN (0, 3)) w
  LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.i = coalesce(c.n, 0) GROUP BY w.conv_id)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(key, 9) AS BIGINT) AS cost,
       substr(key, 10) AS audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM goal g LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
"""

EXPECTED: dict[str, str] = {
    "op2_decontaminate": DECONTAMINATE,
    "op3_mix": MIX,
    "op9_jaccard": JACCARD,
    "op11_lexical": LEXICAL,
    "op13_conversations": CONVERSATIONS,
}
