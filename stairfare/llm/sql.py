"""Reference SQL, for DuckDB, of the queries of this folder that SQL can express."""

SQL = {}

SQL["op7_decontaminate"] = r"""
WITH q AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
qw AS (SELECT DISTINCT item_id, least(len(ws), 13) AS k, array_to_string(ws[s : s + least(len(ws), 13) - 1], ' ') AS w
       FROM q, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS u(s) WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM qw),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
dw AS (SELECT doc_id, k, s, array_to_string(ws[s : s + k - 1], ' ') AS w FROM d, ks, unnest(range(1, len(ws) - k + 2)) AS u(s) WHERE len(ws) >= k),
m AS (SELECT doc_id, dw.k, s, item_id FROM dw JOIN qw ON dw.k = qw.k AND dw.w = qw.w),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

SQL["op11_phrases"] = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM pieces),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
f AS (SELECT lang, k, array_to_string(ws[s : s + k - 1], ' ') AS phrase, count(*) AS f
      FROM p, unnest(range(1, 6)) AS u(k), unnest(range(1, len(ws) - k + 2)) AS v(s) WHERE len(ws) >= k GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.phrase, c.a, x AS cut, array_to_string(w[1 : x], ' ') AS lp, array_to_string(w[x + 1 : k], ' ') AS rp FROM c, unnest(range(1, k)) AS u(x)),
sc AS (SELECT cuts.lang, cuts.phrase, a, cut, fl.f AS l, fr.f AS r, n, ((1000::HUGEINT * a * n) // (fl.f::HUGEINT * fr.f))::BIGINT AS score
       FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = lp JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = rp JOIN total ON total.lang = cuts.lang),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM sc),
inside AS (SELECT DISTINCT lang, f AS a, array_to_string(string_split(phrase, ' ')[s : s + j - 1], ' ') AS phrase
           FROM f, unnest(range(2, 5)) AS u(j), unnest(range(1, k - j + 2)) AS v(s) WHERE j < k),
whole AS (SELECT lang, phrase, a, l, r, n, score FROM least WHERE nth = 1
          AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = least.lang AND i.phrase = least.phrase AND 100 * i.a >= 100 * least.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM whole)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

SQL["op13_draw_like"] = r"""
WITH RECURSIVE bits AS (SELECT i, i AS c, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
tab AS (SELECT list(c ORDER BY i) AS crc FROM bits WHERE step = 8),
w AS (SELECT 'd' AS kind, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL SELECT 'b', NULL, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
per AS (SELECT kind, doc_id, word, count(*) AS n FROM w GROUP BY ALL),
vocabulary AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode(word)) * 2, 2), lambda p: ('0x' || substr(hex(encode(word)), p, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT word FROM per), tab),
bk AS (SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t FROM per JOIN vocabulary USING (word) GROUP BY bucket),
tot AS (SELECT sum(s) AS ss, sum(t) AS tt FROM bk),
g AS (SELECT bucket, floor(1000 * ln(((t + 1) * (ss + 10000))::DOUBLE / ((s + 1) * (tt + 10000))::DOUBLE))::BIGINT AS gain FROM bk, tot),
m AS (SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight FROM per JOIN vocabulary USING (word) JOIN g USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
h AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT AS h FROM documents LEFT JOIN m USING (doc_id)),
sc AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS nth, count(*) FILTER (n_features >= 20) OVER () AS fit FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND nth <= 10 * fit // 100 THEN nth END AS rank FROM r
"""

SQL["op3_shingle_links"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT r, array_to_string(ws[s : s + 4], ' ') AS w FROM d, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS u(s) WHERE len(ws) > 0),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
sets AS (SELECT r, n, h, min(r) OVER (PARTITION BY h) AS rep FROM (SELECT r, any_value(n) AS n, sha256(string_agg(w, chr(10) ORDER BY w)) AS h FROM sh JOIN n USING (r) GROUP BY r)),
few AS (SELECT sh.r, w, hash(w) AS hw FROM sh JOIN sets USING (r) WHERE r = rep),
pair AS (SELECT a.r AS x, b.r AS y, count(*) AS o FROM few a JOIN few b ON a.hw = b.hw AND a.w = b.w AND a.r < b.r GROUP BY a.r, b.r),
link AS (SELECT x, y FROM pair JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * o >= 80 * (nx.n + ny.n - o)),
sides AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT x, y FROM sides UNION SELECT reach.x, sides.y FROM reach JOIN sides ON reach.y = sides.x),
lowest AS (SELECT rep, min(doc_id) AS own FROM sets JOIN d USING (r) GROUP BY rep),
named AS (SELECT rep, least(any_value(own), min(other)) AS id FROM (SELECT l.rep, l.own, o.own AS other FROM lowest l LEFT JOIN reach ON reach.x = l.rep LEFT JOIN lowest o ON o.rep = reach.y) GROUP BY rep)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(id, doc_id) AS component_id FROM d LEFT JOIN sets USING (r) LEFT JOIN named USING (rep)
"""

SQL["op5_repeats"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
s AS (SELECT r, i, hash(array_slice(b, i, i + 199)) AS h FROM d, unnest(range(1, octet_length(b) - 198)) AS u(i) WHERE octet_length(b) >= 200),
twice AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
hit AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200, TRUE) AS fresh FROM s SEMI JOIN twice USING (h)),
runs AS (SELECT r, min(i) AS lo, max(i) + 199 AS hi FROM (SELECT r, i, count(*) FILTER (fresh) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM hit) GROUP BY r, run),
gaps AS (SELECT r, lo, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) + 1 AS start, hi FROM runs),
cut AS (SELECT r, count(*) AS n_spans, sum(hi - lo + 1)::BIGINT AS n_removed, max(hi) AS last, list({'a': start, 'b': lo - 1} ORDER BY lo) AS kept FROM gaps GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN b ELSE unhex(array_to_string(list_transform(kept, lambda k: substr(hex(b), 2 * k.a - 1, 2 * (k.b - k.a + 1))), '') || substr(hex(b), 2 * last + 1)) END) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

SQL["op6_chat_format"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v),
e AS (SELECT *, length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?INST\]|ROLE\])')) AS shown, length(role) + len(regexp_extract_all(role, '[<\[]\\*(?:/?s>|/?INST\]|ROLE\])')) AS named FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE role WHEN 'user' THEN shown + 13 WHEN 'assistant' THEN shown + 4 ELSE shown + named + 13 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
