"""DuckDB SQL counterparts of the queries that SQL can express."""

# Base32 from the hexadecimal digest: five digits are 20 bits, four letters.
OP2 = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex
  FROM pages),
d AS (
  SELECT page_id, payload_bytes,
         list_aggregate(list_transform(range(0, 8), lambda k:
           list_aggregate(list_transform([15, 10, 5, 0], lambda s:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, (5 * k + 1)::BIGINT, 5))::INT >> s) & 31) + 1, 1)),
             'string_agg', '')), 'string_agg', '') AS payload_digest,
         max(page_id) OVER (PARTITION BY hex, payload_bytes) AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, true AS valid, NULL::VARCHAR AS error
FROM d
"""

OP3 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
pairs AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.rid <> y.rid GROUP BY x.rid, y.rid)
  JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (
  WITH RECURSIVE r(origin, here) AS (SELECT rid, rid FROM d UNION SELECT origin, b FROM r JOIN pairs ON a = here) SELECT * FROM r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(e.doc_id) AS component_id
FROM d LEFT JOIN n USING (rid) JOIN reach ON origin = d.rid JOIN d e ON e.rid = here GROUP BY d.rid, d.doc_id, n.n
"""

OP6 = r"""
SELECT t.conv_id, p.perspective, t.turn, t.role AS speaker,
       CASE WHEN t.role = p.perspective THEN 'assistant' WHEN t.role = 'system' THEN 'system' ELSE 'user' END AS role,
       CASE WHEN t.role = p.perspective OR t.role = 'system' THEN NULL ELSE coalesce(t.role, 'unknown') END AS name,
       coalesce(t.text, '') AS content,
       '<|im_start|>' || CASE WHEN t.role = p.perspective THEN 'assistant' WHEN t.role = 'system' THEN 'system'
                              ELSE 'user name=' || coalesce(t.role, 'unknown') END
           || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10) AS rendered,
       CASE WHEN t.role = p.perspective THEN 1 ELSE 0 END AS mask,
       CASE WHEN t.role = p.perspective THEN length(coalesce(t.text, '')) ELSE 0 END AS n_loss_chars
FROM conversations t
JOIN (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system') p
  ON t.conv_id IS NOT DISTINCT FROM p.conv_id
"""

OP9 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS MATERIALIZED (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS MATERIALIZED (SELECT rid, i, bw.n, bw.item_id FROM dw JOIN bw ON bw.phrase = dw.phrase AND bw.n = dw.n),
spots AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hits) GROUP BY rid)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (rid) LEFT JOIN items USING (rid)
"""

# Rows are taken from the last one on; q0 to q3 hold the cheapest edits (cost, initials, repaired lines) of what
# follows if the repaired dialogue is empty so far or ends with a system, user or assistant turn.
OP11 = r"""
WITH RECURSIVE
crc AS MATERIALIZED (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS t
  FROM (SELECT unnest(range(0, 256)) AS n)),
d AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS harm
  FROM conversations, crc),
m AS (
  SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE harm WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM d WHERE harm <> 0),
n AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS l,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS after
  FROM m),
f AS MATERIALIZED (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM n),
dp AS (
  SELECT conv_id, max(i) + 1 AS i, {'c': 0, 's': '', 't': []::VARCHAR[]} AS q0, {'c': 10, 's': 'II', 't': ['user:', 'assistant:']} AS q1,
         {'c': 5, 's': 'I', 't': ['assistant:']} AS q2, {'c': 0, 's': '', 't': []::VARCHAR[]} AS q3
  FROM f GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i,
         list_min([h0, {'c': h2.c + 5, 's': 'I' || h2.s, 't': ['user:'] || h2.t}]),
         list_min([h1, {'c': h2.c + 5, 's': 'I' || h2.s, 't': ['user:'] || h2.t}]),
         list_min([h2, {'c': h3.c + 5, 's': 'I' || h3.s, 't': ['assistant:'] || h3.t}]),
         list_min([h3, {'c': h2.c + 5, 's': 'I' || h2.s, 't': ['user:'] || h2.t}])
  FROM (
    SELECT f.conv_id, f.i,
           list_min([d0, CASE WHEN stays AND l = 's' THEN {'c': q1.c + e, 's': 'K' || q1.s, 't': [k] || q1.t} END,
                     CASE WHEN stays AND l = 'u' THEN {'c': q2.c + e, 's': 'K' || q2.s, 't': [k] || q2.t} END, ru]) AS h0,
           list_min([d1, CASE WHEN stays AND l = 'u' THEN {'c': q2.c + e, 's': 'K' || q2.s, 't': [k] || q2.t} END, ru]) AS h1,
           list_min([d2, CASE WHEN stays AND l = 'a' THEN {'c': q3.c + e, 's': 'K' || q3.s, 't': [k] || q3.t} END, ra]) AS h2,
           list_min([d3, CASE WHEN stays AND l = 'u' THEN {'c': q2.c + e, 's': 'K' || q2.s, 't': [k] || q2.t} END, ru]) AS h3
    FROM (
      SELECT f.*, q1, q2, q3, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS e,
             role || ':' || text AS k,
             {'c': q0.c + 2, 's': 'D' || q0.s, 't': q0.t} AS d0, {'c': q1.c + 2, 's': 'D' || q1.s, 't': q1.t} AS d1,
             {'c': q2.c + 2, 's': 'D' || q2.s, 't': q2.t} AS d2, {'c': q3.c + 2, 's': 'D' || q3.s, 't': q3.t} AS d3,
             CASE WHEN stays THEN {'c': q2.c + e + 1, 's': 'R' || q2.s, 't': ['user:' || text] || q2.t} END AS ru,
             CASE WHEN stays THEN {'c': q3.c + e + 1, 's': 'R' || q3.s, 't': ['assistant:' || text] || q3.t} END AS ra
      FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i - 1) f)),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (after IS NOT NULL AND l || after NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(q0.c, 0)::BIGINT AS cost, coalesce(q0.s, '') AS audit,
       sha256(coalesce(array_to_string(q0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM o.conv_id AND dp.i = 1
"""

ORACLES = {"op2_warc": OP2, "op3_jaccard_join": OP3, "op6_perspectives": OP6, "op9_decontaminate": OP9, "op11_turn_repair": OP11}
