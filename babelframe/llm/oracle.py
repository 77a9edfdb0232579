"""DuckDB SQL for the queries that SQL can express; the others are tested
against brute force, round trips or held-out labels in ``tests/llm``."""

ORACLE = {
    "op8_pivot_topk": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op10_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), l AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM w
), s AS (
  SELECT doc_id, unnest(g) AS g FROM l
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM p JOIN l a ON a.doc_id = x JOIN l b ON b.doc_id = y
  WHERE 100 * c >= 85 * (len(a.g) + len(b.g) - c)
), t AS (
  SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM l UNION SELECT t.y, r.root FROM r JOIN t ON t.x = r.doc_id
), m AS (
  SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1
)
SELECT l.doc_id, CAST(len(l.g) AS BIGINT) AS n_shingles, m.component_id, l.doc_id = m.component_id AS kept
FROM l JOIN m ON m.doc_id = l.doc_id
""",
    "op11_subspace_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS norm FROM v
), e AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
), r(vec_id, root) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.vec_id
), m AS (
  SELECT vec_id, min(root) AS component_id FROM r GROUP BY 1
), d AS (
  SELECT x, count(*) AS n_links FROM e GROUP BY 1
)
SELECT t.vec_id, coalesce(d.n_links, 0) AS n_links, m.component_id, t.vec_id = m.component_id AS kept
FROM embeddings t JOIN m ON m.vec_id = t.vec_id LEFT JOIN d ON d.x = t.vec_id
""",
    "op12_importance_resampling": r"""
WITH RECURSIVE bits(b, k, c) AS (
  SELECT b, 0, b FROM (SELECT unnest(range(256)) AS b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8
), w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), d AS (
  SELECT doc_id, unnest(w) AS f FROM w
), y AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM benchmark
), u AS (
  SELECT DISTINCT f FROM (SELECT f FROM d UNION ALL SELECT f FROM y)
), h AS (
  SELECT f, hex(encode(f)) AS x FROM u
), k AS (
  SELECT f, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM h, crc
), s AS (
  SELECT bucket, count(*) AS s FROM d JOIN k ON k.f = d.f GROUP BY 1
), t AS (
  SELECT bucket, count(*) AS t FROM y JOIN k ON k.f = y.f GROUP BY 1
), g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM d) + 10000)
    / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM y) + 10000)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
), p AS (
  SELECT d.doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM d JOIN k ON k.f = d.f JOIN g ON g.bucket = k.bucket GROUP BY 1
), z AS (
  SELECT w.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || w.doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN p ON p.doc_id = w.doc_id
), o AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM z WHERE n_features >= 20
)
SELECT z.doc_id, n_features, weight, score,
  CASE WHEN r <= (SELECT count(*) FROM o) * 10 // 100 THEN r END AS rank
FROM z LEFT JOIN o ON o.doc_id = z.doc_id
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same
), h AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  WHERE p.r <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM h WHERE rank <= 3
""",
}
