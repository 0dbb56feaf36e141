"""SQL for DuckDB that gives the rows of the registered queries that SQL can express."""

from __future__ import annotations

from paceline.llm import decontam, lexical, linededup, mixing, secretscan, sharding

_WORDS = r"[^\x20\x09-\x0D]+"


def _draw(seed: int) -> str:
    return f"md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, '')))"


#: Ranks inside the sources, fractional ranks, and the cut. The CRC-32 runs over the bytes with the usual table, built here.
OP3 = rf"""
WITH RECURSIVE turn(i, c, k) AS (SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM turn WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM turn WHERE k = 8),
own AS (SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS x, {_draw(sharding.SEED)} AS draw FROM documents),
bytes AS (SELECT doc_id, source, draw, CAST(length(x) // 2 AS BIGINT) AS n,
  list_transform(regexp_extract_all(x, '..'), lambda b: CAST('0x' || b AS BIGINT)) AS b FROM own),
sums AS (SELECT doc_id, source, draw, n + 8 AS size,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc),
ranks AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY draw, doc_id) - 1
  + CAST('0x' || md5('{sharding.SEED}:' || coalesce(source, 'null'))[:8] AS BIGINT) / 4294967296.0::DOUBLE)
  / count(*) OVER (PARTITION BY source) AS f FROM sums),
places AS (SELECT *, row_number() OVER (ORDER BY f, draw, doc_id) - 1 AS p, count(*) OVER () AS n FROM ranks)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(p * {sharding.SHARDS} // n AS INTEGER) AS shard,
  CAST(p - ((p * {sharding.SHARDS} // n) * n + {sharding.SHARDS - 1}) // {sharding.SHARDS} AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM places"""

#: Targets by the level of the water, slots by the golden ratio, rare sources to their targets, and each document's part of the taken stretch of its stream.
OP8 = rf"""
WITH own AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS size, {_draw(mixing.SEED)} AS draw FROM documents),
sizes AS (SELECT source, sum(size) AS source_size FROM own GROUP BY source),
caps AS (SELECT *, [{', '.join(f'{w}.0::DOUBLE' for w in mixing.WEIGHTS)}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1 AS INTEGER)] AS w,
  source_size * {float(mixing.REPEATS)}::DOUBLE AS cap, sum(source_size) OVER () * {mixing.TOTAL}::DOUBLE AS whole FROM sizes),
levels AS (SELECT *, (whole - coalesce(sum(cap) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS lvl FROM caps
  WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(lvl, cap / w) FROM levels WHERE lvl * w <= cap)) AS target FROM levels),
goals AS (SELECT *, target < {mixing.RARE}::DOUBLE * sum(target) OVER () AS rare FROM filled),
spans AS (SELECT source, sum(target) OVER (ORDER BY source NULLS LAST) / sum(target) OVER () AS hi, sum(target) OVER () AS whole,
  row_number() OVER (ORDER BY source DESC NULLS FIRST) AS from_end FROM goals WHERE target > 0 AND NOT rare),
bounds AS (SELECT source, whole, coalesce(lag(hi) OVER (ORDER BY source NULLS LAST), 0) AS lo, CASE WHEN from_end = 1 THEN 1 ELSE hi END AS hi FROM spans),
points AS (SELECT (i + 1) * {mixing._GOLDEN}::DOUBLE - floor((i + 1) * {mixing._GOLDEN}::DOUBLE) AS x FROM range({mixing.SLOTS}) t(i)),
slots AS (SELECT source, round(count(*) * (any_value(whole) / {float(mixing.SLOTS)}::DOUBLE)) AS upto FROM points JOIN bounds ON x >= lo AND x < hi GROUP BY source),
placed AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f FROM own)
SELECT p.doc_id, p.size, CAST(g.source_size AS BIGINT) AS source_size, g.target,
  CAST({' + '.join(f'greatest(0, least(f + size + {e} * source_size, coalesce(CASE WHEN rare THEN round(g.target) ELSE upto END, 0)) - f - {e} * source_size)' for e in range(mixing.REPEATS))} AS BIGINT) AS taken
FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source LEFT JOIN slots s ON p.source IS NOT DISTINCT FROM s.source"""

_SEEDS = ", ".join("'" + str(m) + ":' || " + " || ' ' || ".join(f"w[i + {o}]" for o in mask) for m, mask in enumerate(decontam.MASKS))


def _seeded(table: str) -> str:
    return f"SELECT k, i, unnest([{_SEEDS}]) AS seed FROM (SELECT k, w, unnest(range(1, len(w) - {decontam.SPAN} + 2)) AS i FROM {table})"


#: The same seeds as strings; alignments are verified by comparing the token lists.
OP9 = rf"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
docs AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM d),
items AS (SELECT item_id AS k, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark),
a AS ({_seeded('docs')}), b AS ({_seeded('items')}),
hits AS (SELECT DISTINCT a.k AS k, b.k AS item_id, a.i - b.i AS o FROM a JOIN b USING (seed)),
same AS (SELECT h.k, doc_id, item_id, o, len(items.w) AS item_tokens,
  list_transform(range(1, len(items.w) + 1), lambda i: CASE WHEN i + o >= 1 AND docs.w[greatest(i + o, 1)] = items.w[i] THEN 1 ELSE 0 END) AS s
  FROM hits h JOIN docs ON h.k = docs.k JOIN items ON h.item_id = items.k),
judged AS (SELECT k, doc_id, item_id, o, item_tokens, CAST(list_sum(s) AS INTEGER) AS matched,
  (SELECT max(t - low) FROM (SELECT t, min(t) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS low FROM (
     SELECT j, sum(v) OVER (ORDER BY j) AS t FROM (SELECT 0 AS j, 0 AS v UNION ALL SELECT j, CASE WHEN s[j] = 1 THEN 1 ELSE -2 END FROM range(1, len(s) + 1) r(j))))) AS stretch FROM same)
SELECT doc_id, item_id, CAST(item_tokens AS INTEGER) AS item_tokens, matched, CAST(stretch AS INTEGER) AS stretch, CAST(o AS INTEGER) AS doc_start FROM judged
WHERE matched >= item_tokens * {decontam.COVERAGE} OR stretch >= {decontam.STRETCH}
QUALIFY row_number() OVER (PARTITION BY k, item_id ORDER BY matched DESC, stretch DESC, o) = 1"""

#: Deletion variants as strings. Equal variants with the word missing at the same place, or against a whole line, are one edit apart.
OP6 = rf"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
docs AS (SELECT row_number() OVER () AS k, doc_id, string_split(text, chr(10)) AS l, text FROM d),
lines AS (SELECT k, doc_id, i - 1 AS line, l[i] AS t FROM (SELECT k, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM docs WHERE text IS NOT NULL)),
worded AS (SELECT *, regexp_extract_all(t, '{_WORDS}') AS w FROM lines WHERE regexp_matches(t, '{_WORDS}')),
kinds AS (SELECT t, any_value(w) AS w, min({{'d': doc_id, 'l': line}}) AS p FROM worded GROUP BY t),
long AS (SELECT * FROM kinds WHERE len(w) >= {linededup.MIN_WORDS}),
cut AS (SELECT t, p, i, list_concat(w[1:i - 1], w[i + 1:]) AS v FROM (SELECT t, p, w, unnest(range(1, len(w) + 1)) AS i FROM long)),
near AS (SELECT DISTINCT b.t FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND a.t <> b.t AND a.p < b.p
  UNION SELECT b.t FROM cut a JOIN long b ON a.v = b.w AND a.t <> b.t AND a.p < b.p
  UNION SELECT b.t FROM long a JOIN cut b ON a.w = b.v AND a.t <> b.t AND a.p < b.p
  UNION SELECT b.t FROM long a JOIN long b ON a.w = b.w AND a.t <> b.t AND a.p < b.p),
gone AS (SELECT k, line, n.t IS NOT NULL AS near FROM worded w JOIN kinds USING (t) LEFT JOIN near n USING (t)
  WHERE n.t IS NOT NULL OR p <> {{'d': doc_id, 'l': line}}),
lost AS (SELECT k, list(line) AS g, count(*) FILTER (NOT near) AS e, count(*) FILTER (near) AS n FROM gone GROUP BY k),
kept AS (SELECT doc_id, text, len(l) AS n_lines, coalesce(e, 0) AS n_exact, coalesce(n, 0) AS n_near,
  array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(coalesce(g, []), i - 1)), lambda i: l[i]), chr(10)) AS x
  FROM docs LEFT JOIN lost USING (k))
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, n_exact, n_near, CASE WHEN text IS NOT NULL THEN length(x) END AS n_chars,
  CASE WHEN text IS NOT NULL THEN md5(x) END AS text_md5 FROM kept"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{lexical._UPPER}', '{lexical._LOWER}'), '{lexical.TERM}')"

#: Term counts by unnesting, then the formula.
OP11 = rf"""
WITH own AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS t FROM documents),
lens AS (SELECT doc_id, r, len(t) AS n FROM own WHERE len(t) > 0),
sums AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lens),
items AS (SELECT i, item_id, term, count(*) AS k FROM (SELECT i, item_id, unnest(t) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS t FROM benchmark)) GROUP BY ALL),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM own) WHERE term IN (SELECT term FROM items) GROUP BY ALL),
worth AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, sums GROUP BY term, docs),
part AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total)))) AS p
  FROM tf JOIN worth USING (term) JOIN lens USING (r), sums),
scores AS (SELECT i, item_id, doc_id, r, CAST(sum(k * p) AS BIGINT) AS score FROM part JOIN items USING (term) JOIN lens USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r) AS rank
  FROM scores WHERE score > 0) WHERE rank <= {lexical.TOP}"""

_KINDS = ", ".join(f"({i}, '{r.kind}', '{r.pattern.replace(chr(39), chr(39) * 2)}', {r.group}, {r.least})"
                   for i, r in enumerate(secretscan.BASE + secretscan.MORE))

#: Matches by regex; their places are the lengths of the texts between them, added up.
OP12 = rf"""
WITH own AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
kinds(k, kind, pattern, part, least) AS (VALUES {_KINDS}),
found AS (SELECT r, k, kind, pattern, part, least, regexp_extract_all(text, pattern) AS m, string_split_regex(text, pattern) AS gaps FROM own, kinds),
hits AS (SELECT * EXCLUDE (m, gaps), unnest(m) AS hit, unnest(gaps[:len(m)]) AS gap, unnest(range(len(m))) AS i FROM found WHERE len(m) > 0),
ends AS (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY r, k ORDER BY i) AS BIGINT) AS upto FROM hits),
spans AS (SELECT r, k, kind, upto - length(hit) AS start, kind || ':' || (upto - length(hit)) || ':' || upto AS span FROM ends
  WHERE length(CASE WHEN part = 2 THEN regexp_extract(hit, pattern, 2) ELSE hit END) >= least),
docs AS (SELECT r, {', '.join(f"count(*) FILTER (kind = '{x.kind}') AS n_{x.kind}" for x in secretscan.BASE)},
  string_agg(span, ',' ORDER BY start, k) FILTER (k < {len(secretscan.BASE)}) AS base, string_agg(span, ',' ORDER BY start, k) AS spans FROM spans GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{x.kind}, 0) AS n_{x.kind}" for x in secretscan.BASE)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM own LEFT JOIN docs USING (r)"""

#: Costs to the end by a recursion from the last row, then one edit of every conversation at a time.
OP13 = rf"""
WITH RECURSIVE shift(i, c, k) AS (SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM shift WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM shift WHERE k = 8),
ids AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
own AS (SELECT g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(regexp_extract_all(hex(encode(
  coalesce(CAST(c.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'), lambda b: CAST('0x' || b AS BIGINT)) AS b
  FROM conversations c JOIN ids ON c.conv_id IS NOT DISTINCT FROM ids.conv_id),
kinds AS (SELECT g, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) % 20 AS h
  FROM own, crc),
hit AS (SELECT g, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) FROM kinds WHERE h <> 0),
num AS (SELECT g, turn, role, text, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
  row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i FROM hit),
marks AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again, left(role, 1) AS z, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS y FROM num),
line AS MATERIALIZED (SELECT g, turn, role, text, i, z, y, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f,
  CASE WHEN bare = '' OR again THEN 1000000 ELSE 0 END AS del, CASE WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut FROM marks),
stats AS (SELECT g, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank,
  count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
  count(*) FILTER (y IS NOT NULL AND y || ':' || z NOT IN ('s:u', 'u:a', 'a:u')) AS illegal FROM line GROUP BY g),
back(g, i, c0, cs, cu, ca) AS (SELECT g, n, 0, 4, 2, 0 FROM stats
  UNION ALL SELECT g, i, least(b0, 2 + bu, 4 + ba), least(bs, 2 + bu, 4 + ba), least(bu, 2 + ba), least(ba, 2 + bu) FROM (
    SELECT b.g, b.i - 1 AS i, least(3 + c0, del + cut + CASE z WHEN 's' THEN cs WHEN 'u' THEN cu ELSE 2 + cu END, del + cut + 2 + cu) AS b0,
      least(3 + cs, del + cut + cu + CASE z WHEN 'u' THEN 0 ELSE 2 END) AS bs, least(3 + cu, del + cut + ca + CASE z WHEN 'a' THEN 0 ELSE 2 END) AS bu,
      least(3 + ca, del + cut + cu + CASE z WHEN 'u' THEN 0 ELSE 2 END) AS ba
    FROM back b JOIN line l ON l.g = b.g AND l.i = b.i WHERE b.i > 0)),
cost AS MATERIALIZED (SELECT g, i, '0' AS q, c0 AS c FROM back UNION ALL SELECT g, i, 's', cs FROM back UNION ALL SELECT g, i, 'u', cu FROM back UNION ALL SELECT g, i, 'a', ca FROM back),
fwd(g, i, q, audit, said, ended) AS (SELECT g, CAST(0 AS BIGINT), '0', '', CAST([] AS VARCHAR[]), false FROM stats
  UNION ALL SELECT g, CASE WHEN e IN ('D', 'K', 'R') THEN i + 1 ELSE i END, CASE WHEN e = 'D' OR e = '' THEN q WHEN e = 'K' AND z = 's' THEN 's' ELSE up END, audit || e,
    CASE e WHEN 'K' THEN list_append(said, role || ':' || text) WHEN 'R' THEN list_append(said, name || ':' || text) WHEN 'I' THEN list_append(said, name || ':') ELSE said END, e = ''
  FROM (SELECT f.g, f.i, f.q, f.audit, f.said, l.z, l.role, l.text, CASE f.q WHEN 'u' THEN 'a' ELSE 'u' END AS up, CASE f.q WHEN 'u' THEN 'assistant' ELSE 'user' END AS name,
      CASE WHEN l.i IS NOT NULL AND 3 + same.c = here.c THEN 'D' WHEN l.i IS NULL AND f.q IN ('0', 'a') THEN '' WHEN 2 + ins.c = here.c THEN 'I'
        WHEN (l.z = CASE f.q WHEN 'u' THEN 'a' ELSE 'u' END AND del + cut + nxt.c = here.c) OR (l.z = 's' AND f.q = '0' AND del + cut + sys.c = here.c) THEN 'K' ELSE 'R' END AS e
    FROM fwd f JOIN cost here ON here.g = f.g AND here.i = f.i AND here.q = f.q
      JOIN cost ins ON ins.g = f.g AND ins.i = f.i AND ins.q = CASE f.q WHEN 'u' THEN 'a' ELSE 'u' END
      LEFT JOIN line l ON l.g = f.g AND l.i = f.i + 1
      LEFT JOIN cost same ON same.g = f.g AND same.i = f.i + 1 AND same.q = f.q
      LEFT JOIN cost nxt ON nxt.g = f.g AND nxt.i = f.i + 1 AND nxt.q = CASE f.q WHEN 'u' THEN 'a' ELSE 'u' END
      LEFT JOIN cost sys ON sys.g = f.g AND sys.i = f.i + 1 AND sys.q = 's' WHERE NOT f.ended))
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(c, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN stats USING (g) LEFT JOIN (SELECT g, audit, said FROM fwd WHERE ended) USING (g) LEFT JOIN (SELECT g, c FROM cost WHERE i = 0 AND q = '0') USING (g)"""
