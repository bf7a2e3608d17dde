"""DuckDB counterparts of the corpus queries, where SQL can express them."""

ORACLE = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE["op1_line_dedup"] = f"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM parts
), keyed AS (
  SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') AS k FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, line, pos, coalesce(doc_id < last_doc, false) AS gone FROM keyed LEFT JOIN frequent USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE["op4_decontamination"] = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), bs AS (
  SELECT item_id, w, least(13, len(w)) AS n, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
  FROM bw WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM bs
), sizes AS (
  SELECT DISTINCT n FROM windows
), ds AS (
  SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n
), found AS (
  SELECT doc_id, i, ds.n, item_id FROM ds JOIN windows
  ON windows.n = ds.n AND windows.gram = array_to_string(w[i : i + ds.n - 1], ' ')
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op7_near_dedup"] = f"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM dw
), items AS (
  SELECT doc_id, unnest(s) AS x FROM sets
), shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT u, v FROM shared JOIN sets a ON a.doc_id = u JOIN sets b ON b.doc_id = v
  WHERE 100 * n >= 80 * (len(a.s) + len(b.s) - n)
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT reach.doc_id, v FROM reach JOIN links ON u = r
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

ORACLE["op8_nearest_neighbours"] = """
WITH valid AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM valid q JOIN valid c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
)
SELECT query_id, CAST(r AS INT) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""

ORACLE["op12_hard_negatives"] = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM valid a JOIN valid c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""
