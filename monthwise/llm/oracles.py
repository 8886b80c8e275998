"""DuckDB SQL for the queries that SQL can express."""

OP2 = r"""
WITH words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w
  FROM documents),
starts AS (SELECT doc_id, w, unnest(range(len(w) - 12)) AS p FROM words WHERE len(w) >= 13),
windows AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 13], ' ') AS s FROM starts),
firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s HAVING count(DISTINCT doc_id) > 1),
gone AS (
  SELECT DISTINCT doc_id, p + o AS pos
  FROM windows JOIN firsts USING (s), range(13) AS r(o) WHERE doc_id > first_id),
gone_list AS (SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM words),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.pos) AS kept
  FROM each_word e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos
  WHERE g.pos IS NULL GROUP BY e.doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN gone_list USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[p + 1:p + 3], ' ') FOR p IN range(len(w) - 2)] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (
  SELECT doc_id AS a, doc_id AS r FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.r),
lowest AS (SELECT a AS doc_id, min(r) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP1 = r"""
WITH words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w FROM documents),
items AS (
  SELECT item_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 13 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[p + 1:p + 13], ' ') FOR p IN range(len(w) - 12)] END) AS s FROM items),
sizes AS (SELECT DISTINCT len(string_split(s, ' ')) AS n FROM item_windows),
starts AS (
  SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS p FROM words, sizes WHERE len(w) >= n),
doc_windows AS (SELECT doc_id, n, p, array_to_string(w[p + 1:p + n], ' ') AS s FROM starts),
hits AS (SELECT doc_id, n, p, item_id FROM doc_windows JOIN item_windows USING (s)),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS pos FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN n_hits USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP4 = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
f AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
firsts AS (SELECT digest, min(page_id) AS first_id FROM f WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, f.digest AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f LEFT JOIN firsts ON firsts.digest = f.digest AND f.n >= 100
"""

OP9 = r"""
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP11 = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[p + 1:p + k], ' ') FOR p IN range(len(w) - k + 1)]) AS phrase
  FROM words, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
cuts AS (
  SELECT lang, k, phrase, a, c, array_to_string(w[:c], ' ') AS lp, array_to_string(w[c + 1:], ' ') AS rp
  FROM candidates, (VALUES (1), (2)) AS s(c) WHERE c < k),
scores AS (
  SELECT cuts.*, x.n AS l, y.n AS r,
         (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.n AS HUGEINT) * y.n) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN candidates t
  ON t.lang = s.lang AND s.k = 2 AND t.k = 3 AND (t.w[:2] = s.w OR t.w[2:] = s.w) AND 100 * t.a >= 50 * s.a),
ranked AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN covered USING (lang, phrase))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(totals.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP12 = r"""
WITH RECURSIVE
steps AS (
  SELECT i, 0 AS step, i AS v FROM range(256) AS t(i)
  UNION ALL SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
  FROM steps WHERE step < 8),
crc_table AS (SELECT i, v FROM steps WHERE step = 8),
runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents WHERE text IS NOT NULL)
  WHERE length(run) >= 6 GROUP BY ALL),
crcs AS (
  SELECT doc_id, run, hex(encode(doc_id || ':' || run)) AS hx, 0 AS pos, CAST(4294967295 AS BIGINT) AS crc FROM runs
  UNION ALL
  SELECT doc_id, run, hx, pos + 1, xor(crc >> 8, v)
  FROM crcs JOIN crc_table ON i = xor(crc, CAST('0x' || substr(hx, 2 * pos + 1, 2) AS BIGINT)) & 255
  WHERE 2 * pos < length(hx)),
hashed AS (SELECT doc_id, run, xor(crc, 4294967295) AS h FROM crcs WHERE 2 * pos = length(hx)),
results AS (
  SELECT c, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM runs JOIN hashed USING (doc_id, run)),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (
  SELECT word, n, p, left(word, p) || substr(word, p + 2) AS d
  FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
near AS (
  SELECT cuts.word, words.word AS other, words.n AS other_n FROM cuts JOIN words ON words.word = cuts.d
  UNION SELECT words.word, cuts.word, cuts.n FROM cuts JOIN words ON words.word = cuts.d
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN cuts b ON a.d = b.d AND a.p = b.p AND a.word <> b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
         CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
reach AS (
  SELECT word, word AS top, form AS next FROM forms
  UNION ALL SELECT reach.word, forms.word, forms.form FROM reach JOIN forms ON forms.word = reach.next)
SELECT forms.word, form, top AS root, n, n_near, form_n FROM forms JOIN reach ON reach.word = forms.word AND next IS NULL
"""

OP13 = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (
  SELECT doc_id, unnest(regexp_extract_all(h, '..')) AS b, unnest(range(length(h) // 2)) AS p FROM texts),
windows AS (
  SELECT doc_id, p, string_agg(b, '') OVER w AS s, count(*) OVER w AS n
  FROM bytes WINDOW w AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
firsts AS (
  SELECT s, min(doc_id) AS first_id FROM windows WHERE n = 50 GROUP BY s HAVING min(doc_id) < max(doc_id)),
repeats AS (SELECT doc_id, p FROM windows JOIN firsts USING (s) WHERE n = 50 AND doc_id > first_id),
flags AS (
  SELECT doc_id, p, b, count(r.p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM bytes LEFT JOIN repeats r USING (doc_id, p)),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS new FROM flags),
cut AS (
  SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE new) AS n_spans,
         string_agg(b, '' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM edges GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_bytes, 0) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""
