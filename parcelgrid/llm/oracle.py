"""DuckDB SQL for the corpus queries that SQL can express, over whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP4 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
pos AS (SELECT rid, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM docs),
uni AS (SELECT word, count(*) AS n FROM pos GROUP BY word),
pairs AS (SELECT b.rid, b.i, a.word AS v, b.word AS w FROM pos b LEFT JOIN pos a ON a.rid = b.rid AND b.i = a.i + 1),
big AS (SELECT v, w, count(*) AS n FROM pairs WHERE v IS NOT NULL GROUP BY v, w),
scored AS (SELECT p.rid, CASE WHEN p.v IS NULL THEN ln(cw.n) - ln((SELECT count(*) FROM pos)) ELSE ln(g.n) - ln(cv.n) END AS s
           FROM pairs p JOIN uni cw ON cw.word = p.w LEFT JOIN uni cv ON cv.word = p.v LEFT JOIN big g ON g.v = p.v AND g.w = p.w),
sums AS (SELECT rid, sum(s) AS s FROM scored GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, round(coalesce(s.s, 0.0), 4) AS log_score,
       CASE WHEN len(d.w) > 0 THEN round(s.s / len(d.w), 6) END AS mean_log_score
FROM docs d LEFT JOIN sums s ON d.rid = s.rid"""

_MARGIN = "chr(32) || chr(9) || chr(11) || chr(12) || chr(13)"
_OP5 = f"""
WITH lines AS (SELECT doc_id, coalesce(text, '') AS text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS ln,
                      unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
seen AS (SELECT doc_id, ln, trim(line, {_MARGIN}) AS line, row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS p0
         FROM lines WHERE trim(line, {_MARGIN}) <> ''),
win AS (SELECT doc_id, p0, line AS a, lead(line) OVER o AS b, lead(line, 2) OVER o AS c FROM seen WINDOW o AS (PARTITION BY doc_id ORDER BY p0)),
later AS (SELECT doc_id, p0 FROM (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p0) AS nth FROM win WHERE c IS NOT NULL) WHERE nth > 1),
cut AS (SELECT DISTINCT doc_id, p0 + k AS p0 FROM later, (VALUES (0), (1), (2)) AS t(k)),
kept AS (SELECT l.doc_id, l.ln, l.line FROM lines l LEFT JOIN seen s ON s.doc_id = l.doc_id AND s.ln = l.ln
         LEFT JOIN cut ON cut.doc_id = s.doc_id AND cut.p0 = s.p0 WHERE cut.p0 IS NULL),
texts AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY ln) AS text FROM kept GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t.text, '')) AS text_sha256
FROM documents d LEFT JOIN texts t ON t.doc_id = d.doc_id LEFT JOIN removed r ON r.doc_id = d.doc_id"""

_OP9 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT rid, p0, md5(array_to_string(w[p0:p0 + 34], ' ')) AS h FROM (
          SELECT rid, w, unnest(range(1, len(w) - 33)) AS p0 FROM docs WHERE len(w) >= 35)),
rep AS (SELECT rid, p0 FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
pos AS (SELECT rid, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM docs),
near AS (SELECT p.rid, p.i, p.word, max(r.p0) OVER (PARTITION BY p.rid ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS last
         FROM pos p LEFT JOIN rep r ON r.rid = p.rid AND r.p0 = p.i),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM near WHERE last IS NULL GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.rid = d.rid"""

# fixed values: characters that no search term holds
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP12 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
size AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM docs WHERE len(t) > 0),
asked AS (SELECT item_id, text, list_distinct({_TERMS}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
wanted AS (SELECT item_id, text, unnest(t) AS term FROM asked),
tf AS (SELECT rid, doc_id, len(t) AS n, term, count(*) AS f FROM (SELECT rid, doc_id, t, unnest(t) AS term FROM docs)
       WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT n FROM size) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY term),
impact AS (SELECT rid, doc_id, term, (1000000000 * f) // (1000 * f + 20 * (100 - 50 + ((50 * n * (SELECT n FROM size)) // (SELECT l FROM size)))) AS x FROM tf),
scores AS (SELECT item_id, text, rid, doc_id, CAST(sum(w.w * x) AS BIGINT) AS score
           FROM wanted JOIN w USING (term) JOIN impact USING (term) GROUP BY item_id, text, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0) WHERE rank <= 50"""

_OP13 = """
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
dots AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
         FROM e a, e b WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM dots WHERE same AND other_id <> anchor_id
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
neg AS (SELECT p.*, d.other_id AS negative_id, d.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY d.score DESC, d.other_id) AS rank
        FROM pos p JOIN dots d ON d.anchor_id = p.anchor_id AND NOT d.same
         AND 30 * positive_score <= 100 * d.score AND 100 * d.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op4_stupid_backoff": _OP4, "op5_line_dedup": _OP5, "op9_substring_dedup": _OP9, "op12_ranked_search": _OP12, "op13_hard_negatives": _OP13}
