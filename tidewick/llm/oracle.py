"""SQL that gives the same rows as registered queries."""

from __future__ import annotations

from tidewick.llm import licenses


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_scan() -> str:
    known = ", ".join(f"({i}, {_quoted(a)}, {_quoted(b)})" for i, (a, b) in enumerate(licenses.TEMPLATES))
    line, term = _quoted(licenses.LINE), _quoted(licenses.TERM)
    return f"""
WITH known(template, licence, text) AS (VALUES {known}),
own_terms AS (SELECT template, term, count(*) AS n FROM (
  SELECT template, unnest(regexp_extract_all(lower(text), {term})) AS term FROM known) GROUP BY ALL),
files AS (
  SELECT doc_id, regexp_matches(text, {line}) AS speaks, source || '/' || lang AS top,
    source || '/' || lang || '/' || (doc_id // 100) AS block,
    array_to_string(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {line})), ' ') AS said
  FROM documents),
placed AS (
  SELECT doc_id, speaks, said,
    CASE WHEN speaks AND doc_id % 3 = 0 THEN top ELSE block END AS directory FROM files),
terms AS (SELECT doc_id, term, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(said), {term})) AS term FROM placed WHERE speaks) GROUP BY ALL),
total AS (SELECT count(*) AS n FROM placed WHERE speaks),
seen AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
weighted AS (SELECT doc_id, term, t.n * (ln((total.n + 1.0) / (df + 1.0)) + 1.0) AS w
  FROM terms t JOIN seen USING (term), total),
own AS (SELECT template, term, o.n * (ln((total.n + 1.0) / (coalesce(df, 0) + 1.0)) + 1.0) AS v
  FROM own_terms o LEFT JOIN seen USING (term), total),
length AS (SELECT doc_id, sqrt(sum(w * w)) AS length FROM weighted GROUP BY doc_id),
norm AS (SELECT template, sqrt(sum(v * v)) AS norm FROM own GROUP BY template),
dots AS (SELECT doc_id, template, sum(w * v) AS dot FROM weighted JOIN own USING (term) GROUP BY ALL),
scored AS (SELECT doc_id, template, round(dot / (length * norm), 9) AS cosine
  FROM dots JOIN length USING (doc_id) JOIN norm USING (template)),
best AS (SELECT doc_id, template, cosine FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, template) AS k
  FROM scored WHERE cosine >= {licenses.LEAST}) WHERE k = 1),
rows AS (SELECT p.doc_id, directory || '/' || p.doc_id || '.txt' AS path, directory, speaks, licence, cosine
  FROM placed p LEFT JOIN (SELECT b.doc_id, licence, cosine FROM best b JOIN known USING (template)) f
  ON p.doc_id = f.doc_id),
votes AS (SELECT directory, licence, count(*) AS n FROM rows WHERE speaks AND licence IS NOT NULL GROUP BY ALL),
licensed AS (SELECT directory, licence FROM (
  SELECT *, row_number() OVER (PARTITION BY directory ORDER BY n DESC, licence) AS k FROM votes) WHERE k = 1),
near AS (SELECT doc_id, coalesce(own.directory, up.directory) AS above, coalesce(own.licence, up.licence) AS of_directory
  FROM rows LEFT JOIN licensed own ON rows.directory = own.directory
  LEFT JOIN licensed up ON up.directory = array_to_string(string_split(rows.directory, '/')[1:2], '/'))
SELECT doc_id, path, coalesce(licence, of_directory) AS licence, round(cosine, 6) AS cosine,
  CASE WHEN licence IS NULL THEN above END AS inherited_from,
  CASE WHEN licence IS NOT NULL THEN 'own' WHEN of_directory IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin
FROM rows JOIN near USING (doc_id)
"""


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
