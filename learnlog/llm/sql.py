"""DuckDB SQL of the queries that SQL can express, over whole tables and texts."""

_WORDS = "list_filter(regexp_split_to_array(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format(text="text")} AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM docs WHERE len(ws) >= 20),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(list_slice(ws, s, s + 19), ' ') ORDER BY doc_id, s) AS r FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE r > 1),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM docs),
kept AS (SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.p) AS t, count(*) AS n FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id"""

NGRAM_JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                      ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(list_slice(ws, i, i + 2), ' ')))) END AS s
  FROM docs),
classes AS (SELECT s, min(doc_id) AS class_id, count(*) AS copies FROM sets WHERE len(s) > 0 GROUP BY s),
grams AS (SELECT class_id, copies, len(s) AS n, unnest(s) AS g FROM classes),
links AS (
  SELECT a.class_id AS a, b.class_id AS b, any_value(b.copies) AS copies
  FROM grams a JOIN grams b ON a.g = b.g AND a.class_id <> b.class_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.class_id, b.class_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT class_id AS a, class_id AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS class_id, min(b) AS component_id FROM reach GROUP BY a),
degrees AS (SELECT a AS class_id, sum(copies) AS n FROM links GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(r.component_id, s.doc_id) AS component_id, coalesce(c.class_id, s.doc_id) AS class_id,
       CAST(coalesce(c.copies - 1 + coalesce(d.n, 0), 0) AS BIGINT) AS n_links
FROM sets s LEFT JOIN classes c ON s.s = c.s LEFT JOIN roots r ON c.class_id = r.class_id LEFT JOIN degrees d ON c.class_id = d.class_id"""

# Repeated windows of a document, joined to spans; what is kept lies between them.
SUFFIX_DEDUP = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, s, substring(h, 2 * s + 1, 100) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS s FROM docs WHERE len(h) >= 100) t),
firsts AS (SELECT w, min(doc_id) AS first FROM starts GROUP BY w HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM starts JOIN firsts USING (w) WHERE first < doc_id),
numbered AS (SELECT doc_id, s, sum(CASE WHEN before >= s - 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM gone),
spans AS (SELECT doc_id, k, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY doc_id, k),
between_spans AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM spans),
kept AS (SELECT d.doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed,
                string_agg(substring(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) || substring(any_value(h), 2 * max(b) + 1) AS h
         FROM between_spans x JOIN docs d ON x.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id"""

# Counts by language of all runs of 1 to 3 words of a piece.
PHRASE_MINING = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
runs AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3], lambda k: list_transform(range(1, len(w) - k + 2), lambda i: {'k': k, 'phrase': array_to_string(list_slice(w, i, i + k - 1), ' ')})))) AS r FROM words),
f AS (SELECT lang, r.k AS k, r.phrase AS phrase, count(*) AS f FROM runs GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3) t GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase) WHERE longer.a IS NULL OR 100 * longer.a < 50 * c.a),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
scores AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cuts.cut, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:cut], ' ') JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""

# crc32 byte by byte: its remainders as a list, a run's letters as one or two bytes. Words are near if they
# lose a letter at the same place and are then equal, or if one loses a letter and is then the other.
SPELLING_VARIANTS = """
WITH RECURSIVE crc_table AS (
  SELECT list(r ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) AS r FROM range(256) x(i)) y),
found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END))),
           lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1]))) AS h
  FROM counted, crc_table),
altered AS (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, CAST(h % length(run) AS INT)) || substring(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM altered WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shorter AS (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS s FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words) x),
near AS (
  SELECT a.word AS word, a.n AS n, b.word AS other, b.n AS m FROM shorter a JOIN shorter b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.s = b.word UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.s = b.word),
best AS (SELECT word, n, other, m, count(*) OVER (PARTITION BY word) AS n_near FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1),
formed AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 2 * w.n THEN b.other END AS form, CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n FROM words w LEFT JOIN best b ON w.word = b.word),
reach AS (SELECT word, word AS root, form AS ahead FROM formed UNION ALL SELECT r.word, r.ahead, f.form FROM reach r JOIN formed f ON f.word = r.ahead)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n FROM formed f JOIN reach r ON r.word = f.word AND r.ahead IS NULL"""
