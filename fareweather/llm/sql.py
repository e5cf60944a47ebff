"""DuckDB SQL for the rows of the operators that SQL can express."""

from __future__ import annotations

_WIDTH = 4  # components of a part: 64 / 16


def _nearest(name: str, books: str) -> str:
    apart = " + ".join(f"(a.x{k} - b.x{k}) * (a.x{k} - b.x{k})" for k in range(_WIDTH))
    return f"""{name} AS (
  SELECT rid, p, e, d, x0, x1, x2, x3 FROM (
    SELECT a.*, b.e, {apart} AS d,
           row_number() OVER (PARTITION BY a.rid, a.p ORDER BY {apart}, b.e) AS place
    FROM parts a JOIN {books} b ON a.p = b.p)
  WHERE place = 1)"""


def _moved(name: str, books: str, nearest: str) -> str:
    means = ", ".join(f"coalesce(n.m{k}, b.x{k}) AS x{k}" for k in range(_WIDTH))
    sums = ", ".join(f"CAST(floor(sum(x{k}) / count(*)) AS BIGINT) AS m{k}" for k in range(_WIDTH))
    return f"""{name} AS (
  SELECT b.p, b.e, {means} FROM {books} b
  LEFT JOIN (SELECT p, e, {sums} FROM {nearest} GROUP BY p, e) n ON b.p = n.p AND b.e = n.e)"""


OP11 = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
         list_transform(embedding, lambda x : CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR isnan(x) OR isinf(x))) = 0),
parts AS (
  SELECT rid, p, {", ".join(f"v[p * {_WIDTH} + {k + 1}] AS x{k}" for k in range(_WIDTH))}
  FROM kept, (SELECT unnest(generate_series(0, 15)) AS p)),
book0 AS (SELECT p, rid - 1 AS e, x0, x1, x2, x3 FROM parts WHERE rid <= 64),
{_nearest("near0", "book0")},
{_moved("book1", "book0", "near0")},
{_nearest("near1", "book1")},
{_moved("book2", "book1", "near1")},
{_nearest("near2", "book2")},
coded AS (
  SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near2 GROUP BY rid),
sums AS (
  SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (rid) GROUP BY label),
digest AS (
  SELECT sha256(string_agg(concat_ws(',', x0, x1, x2, x3), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT k.vec_id, c.code, c.error, s.label_error, digest.codebooks_sha256
FROM kept k JOIN coded c USING (rid) JOIN sums s ON k.label IS NOT DISTINCT FROM s.label, digest
"""

_TERMS = r"""regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP12 = f"""
WITH held AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n FROM held WHERE len(terms) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
asked AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL)),
posted AS (
  SELECT rid, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT rid, unnest(terms) AS term FROM held)
  WHERE term IN (SELECT term FROM asked) GROUP BY rid, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM posted GROUP BY term), whole),
impacts AS (
  SELECT rid, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // whole.terms))) AS impact
  FROM posted JOIN weights USING (term) JOIN sizes USING (rid), whole),
scores AS (
  SELECT item_id, rid, CAST(sum(impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY item_id, rid),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores JOIN sizes USING (rid) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"

OP2 = f"""
WITH held AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, {_WORD}) END AS words FROM documents),
placed AS (SELECT doc_id, words, CAST(unnest(generate_series(1, len(words))) AS BIGINT) AS pos FROM held),
windows AS (
  SELECT doc_id, pos, hash(array_to_string(words[pos : pos + 49], ' ')) AS print
  FROM placed WHERE pos + 49 <= len(words)),
firsts AS (SELECT print, min(doc_id) AS first_doc FROM windows GROUP BY print),
covered AS (
  SELECT DISTINCT doc_id, pos + unnest(generate_series(0, 49)) AS pos
  FROM windows JOIN firsts USING (print) WHERE first_doc < doc_id),
kept AS (
  SELECT p.doc_id, string_agg(p.words[p.pos], ' ' ORDER BY p.pos) AS text
  FROM placed p ANTI JOIN covered c ON p.doc_id = c.doc_id AND p.pos = c.pos GROUP BY p.doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM held LEFT JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)
"""

OP5 = f"""
WITH RECURSIVE held AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all({_LOWER}, {_WORD}) END AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i : array_to_string(w[i : i + 2], ' '))) END AS s
  FROM held),
grams AS (SELECT doc_id, n, hash(gram) AS gram FROM (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM sets)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) c USING (doc_id)
"""

SQL = {"op2_substring_dedup": OP2, "op5_ngram_join": OP5, "op11_vector_codes": OP11, "op12_ranked_search": OP12}
