"""DuckDB SQL of the queries of this subpackage that SQL can express, over whole tables and texts."""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scores AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""

NGRAM_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')))) END AS grams
  FROM words),
sets AS MATERIALIZED (SELECT min(doc_id) AS id, grams, len(grams) AS n FROM shingles WHERE len(grams) > 0 GROUP BY grams),
grams AS MATERIALIZED (SELECT id, n, unnest(grams) AS gram FROM sets),
links AS MATERIALIZED (
  SELECT a.id AS x, b.id AS y FROM grams a JOIN grams b ON a.gram = b.gram AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT id AS x, id AS y FROM sets UNION SELECT r.x, k.y FROM reach r JOIN links k ON r.y = k.x),
least_of AS (SELECT x, min(y) AS component FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, coalesce(component, s.doc_id) AS component_id
FROM shingles s LEFT JOIN sets ON s.grams = sets.grams LEFT JOIN least_of ON least_of.x = sets.id
"""

WINDOW_DEDUP = """
WITH docs AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS s FROM docs WHERE len(h) >= 100),
windows AS MATERIALIZED (SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS w FROM starts),
least_of AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
repeats AS (SELECT doc_id, s FROM windows JOIN least_of USING (w) WHERE doc_id > first),
marked AS (SELECT doc_id, s, CAST(s > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50, -1) AS INTEGER) AS opens FROM repeats),
numbered AS (SELECT doc_id, s, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM marked),
spans AS MATERIALIZED (SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL SELECT doc_id, max(b) AS a, NULL AS b FROM spans GROUP BY doc_id),
kept AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * a + 1, 2 * coalesce(b, len(h) // 2) - 2 * a), '' ORDER BY a) AS h
  FROM gaps g JOIN docs USING (doc_id) GROUP BY g.doc_id),
counts AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN counts USING (doc_id) LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
LEXICAL = f"""
WITH words AS MATERIALIZED (SELECT doc_id, {_TERMS} AS w FROM documents),
sizes AS MATERIALIZED (SELECT doc_id, len(w) AS n FROM words WHERE len(w) > 0),
whole AS MATERIALIZED (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM sizes),
asked AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words) GROUP BY ALL),
df AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // l))))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

SQL: dict[str, str] = {"op2_topk": TOPK, "op9_ngram_join": NGRAM_JOIN, "op10_window_dedup": WINDOW_DEDUP, "op11_lexical": LEXICAL}
