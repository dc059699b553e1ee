"""DuckDB SQL for the operators on pairs: all pairs counted, components by following links."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (doc_id, n_shingles, component_id) of the n-gram Jaccard join.
NGRAM_JOIN = rf"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
),
words AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM texts),
windows AS (
    SELECT r, i, lead(w, 4) OVER o IS NOT NULL AS five,
           concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS x
    FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
),
distinct_windows AS (SELECT DISTINCT r, x FROM windows WHERE five OR i = 1),
shingles AS (SELECT r, count(*) OVER (PARTITION BY r) AS n, hash(x) AS x FROM distinct_windows),
shared AS (
    SELECT a.r AS a, b.r AS b, count(*) AS both_have, any_value(a.n + b.n) AS n
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.r <> b.r GROUP BY a.r, b.r
),
links AS (SELECT a, b FROM shared WHERE 100 * both_have >= 80 * (n - both_have)),
reached AS (
    SELECT r AS start, r AS place FROM texts UNION SELECT start, b FROM reached JOIN links ON a = place
),
smallest AS (SELECT start, min(doc_id) AS component_id FROM reached JOIN texts ON r = place GROUP BY start),
sizes AS (SELECT r, count(*) AS n FROM distinct_windows GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM texts JOIN smallest ON start = texts.r LEFT JOIN sizes ON sizes.r = texts.r
"""

#: (vec_id, n_links, component_id, kept) of the embedding near-duplicates.
EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
),
sound AS (
    SELECT * FROM vectors WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) > 0
        AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
links AS (
    SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reached AS (
    SELECT r AS start, r AS place FROM vectors UNION SELECT start, b FROM reached JOIN links ON a = place
),
smallest AS (SELECT start, min(vec_id) AS component_id FROM reached JOIN vectors ON r = place GROUP BY start)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM vectors LEFT JOIN counted ON a = r JOIN smallest ON start = r
"""
