"""SQL with the same results, for the queries that it can express."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
),
e AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * c >= 80 * (a.n + b.n - c)
),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT a, y FROM reach JOIN both_ways ON b = x
)
SELECT a AS doc_id, coalesce(max(n), 0) AS n_shingles, min(b) AS component_id,
  a = min(b) AS kept
FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a"""

NEAR_LINES = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(0, len(string_split(text, chr(10))))) AS number
  FROM documents WHERE text IS NOT NULL
),
c AS (
  SELECT line, min({'d': doc_id, 'k': number}) AS place, length(line) AS n
  FROM l WHERE line <> '' GROUP BY line
),
k AS (
  SELECT line, place, n, b, left(line, b // 2) AS kept, 0 AS side
  FROM (SELECT *, unnest([n, n - 1]) AS b FROM c WHERE n >= 20) WHERE b >= 20
  UNION ALL
  SELECT line, place, n, b, right(line, b - b // 2), 1
  FROM (SELECT *, unnest([n, n - 1]) AS b FROM c WHERE n >= 20) WHERE b >= 20
),
near AS (
  SELECT DISTINCT y.line
  FROM k x JOIN k y ON x.b = y.b AND x.side = y.side AND x.kept = y.kept AND x.place < y.place
  WHERE CASE
    WHEN x.n = y.n THEN list_has_any(
      list_transform(range(0, x.n), lambda i: left(x.line, i) || chr(10) || substr(x.line, i + 2)),
      list_transform(range(0, y.n), lambda i: left(y.line, i) || chr(10) || substr(y.line, i + 2)))
    WHEN x.n < y.n THEN list_contains(
      list_transform(range(0, y.n), lambda i: left(y.line, i) || substr(y.line, i + 2)), x.line)
    ELSE list_contains(
      list_transform(range(0, x.n), lambda i: left(x.line, i) || substr(x.line, i + 2)), y.line)
    END
),
gone AS (
  SELECT l.doc_id, number FROM l JOIN c USING (line) LEFT JOIN near USING (line)
  WHERE near.line IS NOT NULL OR place <> {'d': l.doc_id, 'k': l.number}
)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0) AS n_lines,
  count(number) AS n_removed,
  coalesce(string_agg(CAST(number AS VARCHAR), ',' ORDER BY number), '') AS removed
FROM documents d LEFT JOIN gone g ON g.doc_id = d.doc_id GROUP BY d.doc_id, text"""

NEIGHBOURS = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(
    list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])),
    lambda x, y: x + y)) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place FROM d)
WHERE place <= 10"""

ORACLES = {"op3_minhash": NEAR_DUPLICATES, "op4_lines": NEAR_LINES, "op13_neighbours": NEIGHBOURS}
