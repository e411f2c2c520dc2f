"""SQL over the same tables for the corpus queries that SQL can express."""

ORACLES: dict[str, str] = {}

# White space between words and the counted symbols.
WORD = r"[^\x20\x09-\x0D]+"

ORACLES["op10_quality_rules"] = rf"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT row_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT row_id, regexp_extract_all(text, '{WORD}') AS ws FROM texts)),
g AS (
  SELECT *, lead(word) OVER (PARTITION BY row_id ORDER BY pos) AS w2,
    lead(word, 2) OVER (PARTITION BY row_id ORDER BY pos) AS w3 FROM w),
h AS (SELECT *, w3 IS NOT NULL AND count(*) OVER (PARTITION BY row_id, word, w2, w3) > 1 AS again FROM g),
c AS (
  SELECT *, again OR coalesce(lag(again) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS covered
  FROM h WINDOW o AS (PARTITION BY row_id ORDER BY pos)),
per_text AS (
  SELECT row_id, count(*) AS n_words, sum(length(word)) AS word_chars,
    count(*) FILTER (covered) AS n_repeat_words,
    count(*) FILTER (regexp_matches(word, '[A-Z][A-Z]') AND NOT regexp_matches(word, '[a-z]')) AS n_shouted,
    count(*) FILTER (regexp_full_match(word, '[\x00-\x40\x5b-\x60\x7b-\x7f]+')) AS n_letterless
  FROM c GROUP BY row_id),
lines AS (
  SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{WORD}') GROUP BY row_id),
s AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_shouted, 0) AS n_shouted, coalesce(n_letterless, 0) AS n_letterless
  FROM texts LEFT JOIN per_text USING (row_id) LEFT JOIN lines USING (row_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 2 * n_words OR 10 * n_dup_lines > 5 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_shouted > 3 * n_words
    OR 10 * n_letterless > 3 * n_words) AS kept
FROM b
"""

ORACLES["op5_mixing"] = rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
r AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce('=' || source, 'null') AS source_key, source,
    len(regexp_extract_all(text, '{WORD}'))::BIGINT AS size,
    -ln(1.0::DOUBLE - ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496::DOUBLE)
      / greatest(0.05::DOUBLE, 1.0::DOUBLE - 4.0::DOUBLE * CASE WHEN length(text) > 0 THEN
          (length(text) - length(translate(text, '#*$%&|<>!', '')))::DOUBLE / length(text) ELSE 0 END) AS key
  FROM t),
z AS (SELECT source_key, source, sum(size)::BIGINT AS source_size FROM r GROUP BY ALL),
w AS (
  SELECT *, [1.0, 2.0, 3.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)]::DOUBLE AS weight,
    (3 * source_size)::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE AS total FROM z),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
a AS (
  SELECT source_key, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size))::BIGINT ELSE 0 END AS epochs FROM a),
p AS (
  SELECT r.*, e.source_size, target, epochs, greatest(target - epochs * e.source_size, 0.0) AS rest,
    coalesce(sum(size) OVER (PARTITION BY source_key ORDER BY key, doc_id, size, row_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
  FROM r JOIN e USING (source_key))
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN 2 * so_far + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""

# Components over links (a, b) of nodes (id): the smallest id that links reach.
_REACH = """
reach AS (
  SELECT id, id AS other FROM nodes
  UNION
  SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a)
"""

ORACLES["op1_minhash"] = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
p AS (SELECT id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS k FROM t WHERE len(w) > 0),
s AS (SELECT DISTINCT id, array_to_string(w[k:k + 3], ' ') AS shingle FROM p),
n AS (SELECT id, count(*) AS size FROM s GROUP BY id),
both_in AS (
  SELECT a.id AS a, b.id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.id <> b.id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM both_in JOIN n x ON x.id = a JOIN n y ON y.id = b
  WHERE 100 * common >= 80 * (x.size + y.size - common)),
nodes AS (SELECT DISTINCT id FROM t),
{_REACH},
c AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT t.id AS doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id, t.id = component_id AS kept
FROM t LEFT JOIN n USING (id) JOIN c USING (id)
"""

ORACLES["op4_vector_links"] = rf"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS row_id, vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
fit AS (
  SELECT * FROM t WHERE v IS NOT NULL AND label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.row_id, a.id AS a, b.id AS b FROM fit a JOIN fit b
    ON a.label = b.label AND a.row_id <> b.row_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
links AS (SELECT DISTINCT a, b FROM pairs),
nodes AS (SELECT DISTINCT id FROM t),
{_REACH},
c AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
k AS (SELECT row_id, count(*) AS n_links FROM pairs GROUP BY row_id)
SELECT t.id AS vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, t.id = component_id AS kept
FROM t LEFT JOIN k USING (row_id) JOIN c USING (id)
"""

# What may be done with a row: (class of its initial, state before, letter, state behind, cost); states 0 to
# 3 are the start, after system, after user, after assistant. Rows put in: (state before, behind, letters, lines).
_KEPT = [("s", 0, 1), ("u", 0, 2), ("u", 1, 2), ("u", 3, 2), ("a", 2, 3)]
_REROLED = [("u", 0, 2), ("u", 1, 2), ("u", 3, 2), ("a", 2, 3)]
_EDITS = ", ".join(
    [f"('{c}', {a}, 'K', {b}, 0)" for c, a, b in _KEPT]
    + [f"('{c}', {a}, 'R', {b}, 1)" for to, a, b in _REROLED for c in "sua-" if c != to])
_INSERTS = """(0, 2, 'I', 'user:' || chr(10)), (1, 2, 'I', 'user:' || chr(10)), (2, 3, 'I', 'assistant:' || chr(10)),
  (3, 2, 'I', 'user:' || chr(10)), (0, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (1, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))"""
# CRC-32 of a text of ASCII characters, bit by bit; the number is the fixed value of that sum.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
  lambda sum, byte: list_reduce([xor(sum, byte), 1, 1, 1, 1, 1, 1, 1, 1],
    lambda v, one: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
d AS (SELECT *, {_CRC} % 20 AS kind FROM t),
e AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM d WHERE kind <> 0),
o AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM e),
f AS (
  SELECT *, NOT regexp_matches(text, '{WORD}') AS blank,
    row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 AS again,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
    role[1] AS initial, lag(role[1]) OVER (PARTITION BY c ORDER BY pos) AS earlier FROM o),
g AS (
  SELECT *, again AND NOT blank AS duplicate, cut AND NOT blank AND NOT again AS truncated,
    CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE '-' END AS class FROM f),
n AS (
  SELECT c, any_value(conv_id) AS conv_id, count(*) AS size,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY c),
edits(class, state, letter, there, price) AS (VALUES {_EDITS}),
inserts(state, there, letters, lines) AS (VALUES {_INSERTS}),
best AS (
  SELECT c, size + 1 AS pos, ends.* FROM n, (VALUES
    (0, {{'cost': 0, 'audit': '', 'lines': ''}}), (3, {{'cost': 0, 'audit': '', 'lines': ''}}),
    (2, {{'cost': 5, 'audit': 'I', 'lines': 'assistant:' || chr(10)}}),
    (1, {{'cost': 10, 'audit': 'II', 'lines': 'user:' || chr(10) || 'assistant:' || chr(10)}})) AS ends(state, s)
  UNION ALL
  SELECT c, pos, state, min(s) AS s FROM (
    WITH one AS (
      SELECT c, pos, state, min(s) AS s FROM (
        SELECT g.c, g.pos, b.state,
          {{'cost': 2 + b.s.cost, 'audit': 'D' || b.s.audit, 'lines': b.s.lines}} AS s
        FROM best b JOIN g ON g.c = b.c AND g.pos = b.pos - 1
        UNION ALL
        SELECT g.c, g.pos, x.state, {{'cost': x.price + CASE WHEN g.truncated THEN 5 ELSE 0 END + b.s.cost,
          'audit': x.letter || b.s.audit, 'lines': CASE WHEN x.letter = 'K' THEN g.role WHEN x.there = 2 THEN 'user'
            ELSE 'assistant' END || ':' || g.text || chr(10) || b.s.lines}} AS s
        FROM best b JOIN g ON g.c = b.c AND g.pos = b.pos - 1 JOIN edits x ON x.class = g.class AND x.there = b.state
        WHERE NOT g.blank AND NOT g.duplicate) GROUP BY ALL)
    SELECT * FROM one
    UNION ALL
    SELECT c, pos, i.state, {{'cost': 5 * length(letters) + s.cost, 'audit': letters || s.audit,
      'lines': i.lines || s.lines}} AS s
    FROM one JOIN inserts i ON i.there = one.state) GROUP BY ALL),
r AS (SELECT c, s FROM best WHERE pos = 1 AND state = 0)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(s.cost, 0)::BIGINT AS cost, coalesce(s.audit, '') AS audit,
  sha256(coalesce(left(s.lines, length(s.lines) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS every
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM every.conv_id LEFT JOIN r USING (c)
"""
