"""SQL that gives the rows of registered queries, for DuckDB."""

from yearloom.llm import decontamination, line_dedup

_BLANKS = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"


# Placements are those of any equal word, so no seed can be missed.
SPACED_SEEDS = f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL),
b AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
  FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
bs AS (SELECT item_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS pos FROM b),
placed AS (
  SELECT doc_id, item_id, ds.pos - bs.pos AS shift FROM ds JOIN bs USING (word) GROUP BY ALL
  HAVING count(*) >= least({decontamination.STRETCH}, any_value(n)) - {decontamination.SUBSTITUTIONS}),
beside AS (
  SELECT doc_id, item_id, len(b.w) AS item_words, least({decontamination.STRETCH}, len(b.w)) AS needed,
    CASE WHEN len(b.w) >= {decontamination.STRETCH} THEN {decontamination.SUBSTITUTIONS}
      WHEN len(b.w) >= {decontamination.HALVED} THEN 1 ELSE 0 END AS allowed,
    list_transform(range(greatest(0, -shift), least(len(b.w), len(d.w) - shift)),
      lambda i: CAST(b.w[i + 1] = d.w[i + shift + 1] AS integer)) AS equal
  FROM placed JOIN d USING (doc_id) JOIN b USING (item_id)),
good AS (
  SELECT *, list_filter(range(0, len(equal) - needed + 1),
    lambda s: list_sum(equal[s + 1:s + needed]) >= needed - allowed) AS starts
  FROM beside)
SELECT doc_id, item_id, CAST(max(item_words) AS bigint) AS item_words,
  CAST(max(list_sum(equal[list_min(starts) + 1:list_max(starts) + needed])) AS bigint) AS equal_words
FROM good WHERE len(starts) > 0 GROUP BY doc_id, item_id"""

THREE_LINE_WINDOWS = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents),
filled AS (
  SELECT doc_id, pos, trim(line, {_BLANKS}) AS content FROM l WHERE trim(line, {_BLANKS}) <> ''),
w AS (
  SELECT doc_id, pos AS head, lead(pos, {line_dedup.WINDOW - 1}) OVER own AS tail, content AS a,
    lead(content, 1) OVER own AS b, lead(content, 2) OVER own AS c
  FROM filled WINDOW own AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT doc_id, head, tail FROM (
    SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, head) AS nth
    FROM w WHERE tail IS NOT NULL) WHERE nth > 1),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM l JOIN later ON l.doc_id = later.doc_id AND l.pos BETWEEN head AND tail),
marked AS (SELECT l.*, gone.pos IS NOT NULL AS out FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos)
SELECT doc_id, CAST(count(*) FILTER (out) AS bigint) AS n_removed,
  coalesce(string_agg(CAST(pos AS varchar), ',' ORDER BY pos) FILTER (out), '') AS removed_lines,
  md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT out), '')) AS kept_md5
FROM marked GROUP BY doc_id"""

_WHOLE = """
  SELECT row_number() OVER () AS n, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS double)) AS bigint)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

TOP_MATCHES = f"""
WITH v AS ({_WHOLE}),
scored AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(
    range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])) AS bigint) AS score
  FROM v q JOIN v c ON q.n <> c.n WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS integer) AS rank FROM scored)
WHERE rank <= 10"""


def _nearest(r: int) -> str:
    return f"""a{r} AS MATERIALIZED (SELECT n, c, distance FROM (
  SELECT n, c, distance, row_number() OVER (PARTITION BY n ORDER BY distance, c) AS nth FROM (
    SELECT x.n, c.c, sum((x.v - c.v) * (x.v - c.v)) AS distance FROM x JOIN c{r} c USING (d) GROUP BY 1, 2))
  WHERE nth = 1)"""


def _means(r: int) -> str:
    return f"""c{r + 1} AS MATERIALIZED (SELECT old.c, old.d,
    coalesce(CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS bigint), old.v) AS v
  FROM c{r} old LEFT JOIN (
    SELECT a.c, x.d, sum(x.v) AS s, count(*) AS n FROM x JOIN a{r} a USING (n) GROUP BY 1, 2) m
  ON old.c = m.c AND old.d = m.d)"""


_ROUNDS = 10
CENTROIDS = f"""
WITH v AS ({_WHOLE} AND len(embedding) = 64),
x AS MATERIALIZED (SELECT n, unnest(e) AS v, unnest(range(1, 65)) AS d FROM v),
first AS (SELECT n, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS varchar)), e) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT c, d, v FROM first JOIN x USING (n) WHERE c < 8),
{", ".join(f"{_nearest(r)}, {_means(r)}" for r in range(_ROUNDS))},
{_nearest(_ROUNDS)},
names AS (SELECT c, sha256(string_agg(CAST(v AS varchar), ',' ORDER BY d)) AS centroid_sha256 FROM c{_ROUNDS} GROUP BY 1)
SELECT vec_id, CAST(c AS integer) AS cluster, CAST(distance AS bigint) AS distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS bigint) AS cluster_inertia,
  CAST(sum(distance) OVER () AS bigint) AS inertia, centroid_sha256
FROM a{_ROUNDS} JOIN v USING (n) JOIN names USING (c)"""

COLLOCATIONS = """
WITH p AS (
  SELECT row_number() OVER () AS piece, lang, w FROM (
    SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
      FROM documents WHERE text IS NOT NULL))),
t AS (SELECT piece, lang, unnest(w) AS w, unnest(range(len(w))) AS pos FROM p),
g AS MATERIALIZED (
  SELECT lang, w AS w1, lead(w, 1) OVER own AS w2, lead(w, 2) OVER own AS w3
  FROM t WINDOW own AS (PARTITION BY piece ORDER BY pos)),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS a FROM g GROUP BY 1, 2),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS a FROM g WHERE w2 IS NOT NULL GROUP BY 1, 2, 3),
f3 AS MATERIALIZED (
  SELECT lang, w1, w2, w3, count(*) AS a FROM g WHERE w3 IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.w1, c.w2, NULL AS w3, 1 AS k, c.a, l.a AS l, r.a AS r
  FROM f2 c JOIN f1 l ON l.lang = c.lang AND l.w1 = c.w1 JOIN f1 r ON r.lang = c.lang AND r.w1 = c.w2
  WHERE c.a >= 10
  UNION ALL
  SELECT c.*  EXCLUDE (a), 1, c.a, l.a, r.a
  FROM f3 c JOIN f1 l ON l.lang = c.lang AND l.w1 = c.w1
  JOIN f2 r ON r.lang = c.lang AND r.w1 = c.w2 AND r.w2 = c.w3
  UNION ALL
  SELECT c.*  EXCLUDE (a), 2, c.a, l.a, r.a
  FROM f3 c JOIN f2 l ON l.lang = c.lang AND l.w1 = c.w1 AND l.w2 = c.w2
  JOIN f1 r ON r.lang = c.lang AND r.w1 = c.w3),
scored AS (
  SELECT *, CAST((CAST(1000000 AS hugeint) * a * a) // (CAST(l AS hugeint) * r) AS bigint) AS score FROM cuts),
lowest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, w1, w2, w3 ORDER BY score, k) AS nth FROM scored) WHERE nth = 1),
held AS (
  SELECT lang, w1, w2, max(a) AS longer FROM (
    SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY 1, 2, 3),
kept AS (
  SELECT s.*, concat_ws(' ', s.w1, s.w2, s.w3) AS phrase
  FROM lowest s LEFT JOIN held h ON s.lang = h.lang AND s.w1 = h.w1 AND s.w2 = h.w2 AND s.w3 IS NULL
  WHERE h.longer IS NULL OR 100 * h.longer < 50 * s.a),
totals AS (SELECT lang, CAST(sum(a) AS bigint) AS n FROM f1 GROUP BY 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= 2000"""

SQL = {
    "op5_spaced_seed_decontamination": SPACED_SEEDS,
    "op9_three_line_windows": THREE_LINE_WINDOWS,
    "op11_toivonen_phrases": COLLOCATIONS,
    "op12_three_phase_threshold": TOP_MATCHES,
    "op13_dimension_sharded_lloyd": CENTROIDS,
}
