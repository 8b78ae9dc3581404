"""DuckDB twins of the queries that SQL can express."""

LOWER_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all({LOWER_AZ.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWER_AZ.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM benchmark WHERE text IS NOT NULL),
w AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(2, len(ws) - 11))) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM w),
dw AS (
  SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d) CROSS JOIN lens WHERE i + n - 1 <= len(ws)),
hit AS (SELECT dw.rid, dw.i, dw.n, w.item_id FROM dw JOIN w USING (n, win)),
n_hit AS (
  SELECT rid, count(*) AS n_hit
  FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n_hit USING (rid) LEFT JOIN named USING (rid)
"""

CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
#: Characters of a string after escaping: one more for each backslash and control string.
ESCAPED = "length({0}) + length({0}) - length(replace({0}, '\\', '')) + " + " + ".join(
    f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in CONTROLS)
OP7 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
         string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
                    ORDER BY turn NULLS FIRST, role, text) AS path,
         sum({sum(map(len, CONTROLS[:3]))} + {ESCAPED.format('role')} + {ESCAPED.format('text')}) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars,
       regexp_full_match(path, 's?(ua)+') AS valid
FROM g
"""

OP4 = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
                  octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id OR page_id IS NULL AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN page_id > first_id OR page_id IS NULL THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP6 = f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all({LOWER_AZ.format('text')}, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(ws[i:i + 4], ' ') AS sh
  FROM (SELECT rid, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.rid <> b.rid GROUP BY a.rid, b.rid),
e AS (
  SELECT a, b FROM p JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * i >= 75 * (na.n + nb.n - i)),
r AS (SELECT rid AS a, rid AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles,
       coalesce(min(o.doc_id), d.doc_id)::BIGINT AS component_id
FROM r JOIN w d ON d.rid = r.a JOIN w o ON o.rid = r.b LEFT JOIN n ON n.rid = r.a
GROUP BY r.a, d.doc_id
"""

OP12 = f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all({LOWER_AZ.format('text')}, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
s AS (
  SELECT DISTINCT rid, len(ws) < 3 AS few, array_to_string(ws[i:i + 2], ' ') AS sh
  FROM (SELECT rid, ws, unnest(range(1, greatest(2, len(ws) - 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS i
  FROM s a JOIN s b ON a.sh = b.sh AND a.few = b.few AND a.rid < b.rid GROUP BY a.rid, b.rid),
l AS (
  SELECT a, b FROM p JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rid AS a, rid AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (
  SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles,
         coalesce(min(o.doc_id), d.doc_id)::BIGINT AS component_id
  FROM r JOIN w d ON d.rid = r.a JOIN w o ON o.rid = r.b LEFT JOIN n ON n.rid = r.a GROUP BY r.a, d.doc_id)
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM c
"""

#: The role automaton as a table: state, role, next state. 0 and 3 accept.
ROLE_MOVES = "(VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS m(st, role, st2)"
#: State, state after inserts, their number and their lines.
ROLE_INSERTS = """(VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''),
  (0, 2, 1, '|user:'), (1, 2, 1, '|user:'), (2, 3, 1, '|assistant:'), (3, 2, 1, '|user:'),
  (0, 3, 2, '|user:|assistant:'), (1, 3, 2, '|user:|assistant:'), (2, 2, 2, '|assistant:|user:'),
  (3, 3, 2, '|user:|assistant:')) AS ins(st, st2, n, lines)"""
BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
OP13 = f"""
WITH RECURSIVE crc AS (     -- the byte table of CRC-32
  SELECT list(v ORDER BY i) AS tab
  FROM (SELECT i, list_reduce(list_prepend(i, range(0, 8)), lambda c, k:
          CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hit AS (
  SELECT src.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1),
           lambda j: ascii(key[j])::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
  FROM src CROSS JOIN crc),
dmg AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit WHERE k <> 0),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dmg),
judged AS (
  SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS c0,
         CASE WHEN rtrim(text, {BLANKS}) = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(rtrim(text, {BLANKS}), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
  FROM placed),
facts AS (
  SELECT g, any_value(conv_id) AS conv_id, max(i) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND c0 || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY g),
acts AS (       -- what may be done to a turn in a state
  SELECT g, i, st, st AS st2, 4 AS cost, 'D' AS edit, '' AS line FROM judged CROSS JOIN range(4) s(st)
  UNION ALL
  SELECT g, i, m.st, m.st2, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', chr(10) || judged.role || ':' || text
  FROM judged JOIN {ROLE_MOVES} ON m.role = c WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT g, i, m.st, m.st2, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R',
         chr(10) || CASE m.role WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
  FROM judged JOIN {ROLE_MOVES} ON m.role <> 's' WHERE fault NOT IN ('blank', 'duplicate')),
ways AS (
  SELECT g, i, ins.st, a.st2, 3 * ins.n + a.cost AS cost, repeat('I', ins.n) || edit AS edits,
         replace(ins.lines, '|', chr(10)) || line AS lines
  FROM acts a JOIN {ROLE_INSERTS} ON ins.st2 = a.st),
dp AS (
  SELECT g, 0::BIGINT AS i, 0 AS st, {{'cost': 0, 'audit': '', 'lines': ''}} AS v FROM facts
  UNION ALL
  SELECT g, i, st, min(v) FROM (
    SELECT dp.g, w.i, w.st2 AS st,
           {{'cost': v.cost + w.cost, 'audit': v.audit || edits, 'lines': v.lines || w.lines}} AS v
    FROM dp JOIN ways w ON w.g = dp.g AND w.i = dp.i + 1 AND w.st = dp.st)
  GROUP BY g, i, st),
best AS (
  SELECT g, min({{'cost': v.cost + 3 * ins.n, 'audit': v.audit || repeat('I', ins.n),
                  'lines': v.lines || replace(ins.lines, '|', chr(10))}}) AS v
  FROM dp JOIN facts USING (g) JOIN {ROLE_INSERTS} ON ins.st = dp.st AND ins.st2 IN (0, 3)
  WHERE dp.i = facts.n GROUP BY g)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.cost, 0)::BIGINT AS cost, coalesce(v.audit, '') AS audit,
       sha256(coalesce(substr(v.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN (facts JOIN best USING (g)) f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES = {"op3_benchmark_decontamination": OP3, "op4_warc_writer": OP4, "op6_ngram_jaccard_join": OP6,
           "op7_chat_formatting": OP7, "op12_odd_sketch_dedup": OP12, "op13_conversation_repair": OP13}
