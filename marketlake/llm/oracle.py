"""DuckDB SQL over the whole tables, by query, for the operators that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op4_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM g
"""

# A run is three lines; blank lines don't count. A line goes if a run with it occurred earlier.
ORACLE["op5_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), numbered AS (
  SELECT *, regexp_replace(line, '^[ \t\x0B\x0C\r]+|[ \t\x0B\x0C\r]+$', '', 'g') AS bare FROM split
), counted AS (
  SELECT *, CASE WHEN bare <> '' THEN sum(CASE WHEN bare <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) END AS k FROM numbered
), runs AS (
  SELECT doc_id, k, bare AS a, lead(bare) OVER w AS b, lead(bare, 2) OVER w AS c
  FROM counted WHERE bare <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS nth FROM runs WHERE c IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, k + j AS k FROM ranked, (VALUES (0), (1), (2)) AS s(j) WHERE nth > 1
)
SELECT l.doc_id, count(l.k) AS lines, count(g.k) AS deleted,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE g.k IS NULL), '')) AS kept_sha256
FROM counted l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.k = g.k
GROUP BY l.doc_id
"""

# Components by place; rows with a component that is no finite number go.
_WHOLE = r"""
c AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS x, len(embedding) // 16 AS width FROM v
), bad AS (
  SELECT DISTINCT vec_id FROM c WHERE x IS NULL OR isnan(x) OR isinf(x)
), q AS (
  SELECT vec_id, label, pos, pos // width AS part, CAST(floor(256 * x) AS BIGINT) AS k FROM c WHERE vec_id NOT IN (SELECT vec_id FROM bad)
)"""

ORACLE["op11_hard_negatives"] = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
), {_WHOLE}, s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(sum(a.k * r.k) AS BIGINT) AS score
  FROM q a JOIN q r ON a.pos = r.pos AND a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
  GROUP BY a.vec_id, r.vec_id, a.label, r.label
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id
  WHERE p.nth <= 5 AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def _coded(n: int) -> str:
    """Codes of all parts for the n-th codebook: of equal distances, the lower index."""
    return f"""near{n} AS (
  SELECT q.vec_id, q.part, b.entry, sum((q.k - b.k) * (q.k - b.k)) AS d FROM q JOIN book{n} b ON q.pos = b.pos GROUP BY q.vec_id, q.part, b.entry
), code{n} AS (
  SELECT vec_id, part, min(d * 64 + entry) % 64 AS entry, min(d * 64 + entry) // 64 AS error FROM near{n} GROUP BY vec_id, part
)"""


def _moved(n: int) -> str:
    """The codebook after the n-th: means rounded down; entries that no part has stay."""
    return f"""sums{n} AS (
  SELECT c.entry, q.pos, sum(q.k) AS s, count(*) AS n FROM q JOIN code{n} c ON q.vec_id = c.vec_id AND q.part = c.part GROUP BY c.entry, q.pos
), book{n + 1} AS (
  SELECT b.entry, b.pos, coalesce((s.s - ((s.s % s.n) + s.n) % s.n) // s.n, b.k) AS k
  FROM book{n} b LEFT JOIN sums{n} s ON b.entry = s.entry AND b.pos = s.pos
)"""


ORACLE["op13_vector_codes"] = f"""
WITH v AS (
  SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
), {_WHOLE}, first AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT DISTINCT vec_id FROM q)
), book0 AS (
  SELECT f.entry, q.pos, q.k FROM first f JOIN q ON f.vec_id = q.vec_id WHERE f.entry < 64
), {_coded(0)}, {_moved(0)}, {_coded(1)}, {_moved(1)}, {_coded(2)}, coded AS (
  SELECT c.vec_id, string_agg(format('{{:02x}}', CAST(c.entry AS INTEGER)), '' ORDER BY c.part) AS code, CAST(sum(c.error) AS BIGINT) AS error
  FROM code2 c GROUP BY c.vec_id
)
SELECT r.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(k AS VARCHAR), ',' ORDER BY pos // (SELECT max(width) FROM c), entry, pos)) FROM book2) AS codebooks_sha256
FROM coded r JOIN v ON r.vec_id = v.vec_id
"""
