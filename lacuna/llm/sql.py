"""DuckDB statements for the queries of this subpackage that SQL can state."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = {
    "op2_top_k": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op3_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
ne AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS nr FROM l WHERE line <> ''),
w AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY nr) AS next_line FROM ne),
g AS (
  SELECT *, min({'d': doc_id, 'a': nr}) OVER (PARTITION BY line, next_line) AS source
  FROM w WHERE next_line IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, unnest([nr, nr + 1]) AS nr FROM g WHERE source <> {'d': doc_id, 'a': nr}),
marked AS (
  SELECT l.doc_id, l.pos, l.line, gone.nr IS NOT NULL AS deleted
  FROM l LEFT JOIN ne ON l.doc_id = ne.doc_id AND l.pos = ne.pos
         LEFT JOIN gone ON ne.doc_id = gone.doc_id AND ne.nr = gone.nr),
d AS (
  SELECT doc_id, count(*) FILTER (WHERE line <> '') AS n_lines, count(*) FILTER (WHERE deleted) AS n_deleted,
         string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT deleted) AS cleaned
  FROM marked GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
       CASE WHEN text IS NULL THEN NULL WHEN coalesce(n_lines, 0) = coalesce(n_deleted, 0) THEN sha256('')
            ELSE sha256(cleaned) END AS text_sha256
FROM documents LEFT JOIN d ON documents.doc_id = d.doc_id
""",
    "op8_minhash": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach AS (
  SELECT a, b FROM link
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, w.doc_id) AS component_id,
       coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
""",
    "op12_phrases": rf"""
WITH p AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(part, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS part
        FROM documents)),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang),
one AS (SELECT lang, piece, unnest(ws) AS w1, unnest(range(len(ws))) AS pos FROM p),
four AS (
  SELECT lang, w1, lead(w1, 1) OVER (PARTITION BY piece ORDER BY pos) AS w2,
         lead(w1, 2) OVER (PARTITION BY piece ORDER BY pos) AS w3, lead(w1, 3) OVER (PARTITION BY piece ORDER BY pos) AS w4
  FROM one),
g AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM four
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM four WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM four WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM four WHERE w4 IS NOT NULL),
f AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g
  GROUP BY lang, k, phrase HAVING count(*) >= 30),
held AS (
  SELECT lang, f, array_to_string(ws[i:i + s - 1], ' ') AS phrase
  FROM f, (SELECT unnest([2, 2, 2, 3, 3]) AS s, unnest([1, 2, 3, 1, 2]) AS i) WHERE s < k AND i + s - 1 <= k),
most AS (SELECT lang, phrase, max(f) AS most FROM held GROUP BY lang, phrase),
c AS (
  SELECT f.* FROM f LEFT JOIN most ON f.lang = most.lang AND f.phrase = most.phrase
  WHERE k >= 2 AND (most IS NULL OR 100 * most < 80 * f)),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, j, h.f AS l, t.f AS r,
         CAST((CAST(2000000 AS HUGEINT) * c.f) // (h.f + t.f) AS BIGINT) AS score
  FROM c, (SELECT unnest([1, 2, 3]) AS j)
  JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.ws[1:j], ' ')
  JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.ws[j + 1:c.k], ' ')
  WHERE j < c.k),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nr FROM cut),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest WHERE nr = 1)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
""",
    "op13_lexical": rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
size AS (SELECT count(*) AS whole, CAST(sum(len(ts)) AS BIGINT) AS total FROM d WHERE len(ts) > 0),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ts) AS term FROM d) GROUP BY row, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * whole + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, size),
i AS (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT item, term, count(*) AS c FROM (SELECT item, unnest(ts) AS term FROM i) GROUP BY item, term),
s AS (
  SELECT item, tf.row,
         CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(ts) * whole) // total)))) AS BIGINT) AS score
  FROM q JOIN weight ON q.term = weight.term JOIN tf ON tf.term = q.term JOIN d ON d.row = tf.row, size
  GROUP BY item, tf.row),
r AS (
  SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, s.row) AS rank
  FROM s JOIN d ON d.row = s.row WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r JOIN i ON i.item = r.item WHERE rank <= 10
""",
}
