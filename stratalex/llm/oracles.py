"""DuckDB SQL for the operators that SQL expresses."""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS m, array_to_string(w[i : i + 9], ' ') AS said FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
places AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m),
hit AS (SELECT doc_id, i, a.m, item FROM places a JOIN win ON a.m = win.m AND array_to_string(a.w[i : i + a.m - 1], ' ') = win.said),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

BACKOFF = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
u AS (SELECT r, i, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a, total - len(w) AS others
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT sum(len(w)) AS total FROM d)),
m AS (SELECT r, i, others, count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY r, c) AS n1,
        CASE WHEN i > 1 THEN count(*) OVER (PARTITION BY b, c) - count(*) OVER (PARTITION BY r, b, c) ELSE 0 END AS n2,
        CASE WHEN i > 2 THEN count(*) OVER (PARTITION BY a, b, c) - count(*) OVER (PARTITION BY r, a, b, c) ELSE 0 END AS n3 FROM u),
k AS (SELECT *, lag(n1) OVER (PARTITION BY r ORDER BY i) AS before2, lag(n2) OVER (PARTITION BY r ORDER BY i) AS before3, least(i, 3) - CASE WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 ELSE 1 END AS steps FROM m),
s AS (SELECT r, steps, steps * ln(0.4) + CASE WHEN n3 > 0 THEN ln(n3 / before3) WHEN n2 > 0 THEN ln(n2 / before2) ELSE ln(greatest(n1, 1) / greatest(others, 1)) END AS score FROM k),
t AS (SELECT r, count(*) AS n, count(*) FILTER (steps > 0) AS backed, sum(score) AS total FROM s GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(backed, 0) AS n_backoff, round(coalesce(total, 0), 4) AS log_score, round(total / n, 6) AS mean_log FROM d LEFT JOIN t USING (r)
"""

ORACLES = {"op2_decontaminate": DECONTAMINATE, "op8_ngrams": BACKOFF}
