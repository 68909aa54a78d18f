"""DuckDB SQL for the queries that SQL can express on whole tables."""

ORACLE_SQL: dict[str, str] = {}

# A window joins on its words, so that equal words are equal windows.
ORACLE_SQL["op8_decontaminate"] = """
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS said
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
    FROM documents
), doc_windows AS (
    SELECT row_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS said
    FROM (SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
    SELECT d.row_id, d.i, d.n, m.item_id FROM doc_windows d JOIN item_windows m ON d.n = m.n AND d.said = m.said
), hit_words AS (
    SELECT row_id, count(DISTINCT k) AS n_hit FROM (SELECT row_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY row_id
), hit_items AS (
    SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
    FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(named, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (row_id) LEFT JOIN hit_items USING (row_id)
"""

# Within a source all documents have one inclusion probability, so that the order of
# their ranks is the order of their random numbers.
ORACLE_SQL["op6_mix_sources"] = """
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
           (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS chance
    FROM documents
), sources AS (
    SELECT source, sum(size) AS source_size,
           [3, 1, 2][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INT)] AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, ((SELECT sum(source_size) FROM sources) * 1.5
               - coalesce(sum(source_size * 2) OVER (ORDER BY source_size / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY source_size / weight, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
), aims AS (
    SELECT source, source_size,
           CASE WHEN source_size * 2 <= level * weight THEN CAST(source_size * 2 AS DOUBLE)
                ELSE (SELECT arg_min(level, source_size / weight) FROM levels WHERE source_size * 2 > level * weight) * weight END AS target
    FROM levels
), due AS (
    SELECT s.*, a.source_size, a.target, CASE WHEN a.source_size > 0 THEN least(2.0, a.target / a.source_size) ELSE 0 END AS due
    FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
), run AS (
    SELECT *, target - floor(due) * source_size AS room,
           sum(size) OVER (PARTITION BY source ORDER BY chance, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2 AS middle
    FROM due
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST((floor(due) + CASE WHEN due > floor(due) AND room > 0 AND middle <= room THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM run
"""
