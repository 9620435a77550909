"""Expected results as DuckDB SQL, of the operators on pairs whose results are exact."""

#: Cosines over all pairs of a label, and what their links reach. The operator
#: may miss links between vectors that stand apart in all its passes; on tables
#: of this size it misses none.
SORTED_PROJECTIONS = """
WITH RECURSIVE able AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able AS a JOIN able AS b USING (label)
  WHERE a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.seen = links.a
), found AS (
  SELECT node AS vec_id, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
  component_id, e.vec_id = component_id AS kept
FROM embeddings AS e JOIN found USING (vec_id)
"""

#: Shared shingles of all pairs of documents that share one, and what their links reach.
GROUP_PREFIX_JOIN = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.seen = links.a
), found AS (
  SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents JOIN found USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
