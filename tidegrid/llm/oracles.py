"""SQL for a second engine: the queries whose results SQL can express."""

from __future__ import annotations

# All pairs of different texts that share an n-gram; classes by closure over the links.
OP2_NGRAM_JOIN = r"""
WITH RECURSIVE source AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(lower(coalesce(text, '')), '[0-9A-Za-z_\x{80}-\x{10FFFF}]+') AS w
    FROM documents),
texts AS (
    SELECT w, min(rid) AS node, count(*) AS copies, min(doc_id) AS least FROM source WHERE len(w) > 0 GROUP BY w),
grams AS (
    SELECT DISTINCT node, unnest(
        [md5(array_to_string(w[p:p + 4], ' ')) for p in generate_series(1, greatest(1, len(w) - 4))]) AS gram
    FROM texts),
sizes AS (SELECT node, count(*) AS n FROM grams GROUP BY node),
shared AS (
    SELECT x.node AS a, y.node AS b, count(*) AS n
    FROM grams x JOIN grams y ON x.gram = y.gram AND x.node < y.node GROUP BY ALL),
pairs AS (
    SELECT a, b FROM shared JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b
    WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (
    SELECT node AS a, node AS b FROM texts
    UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
classes AS (
    SELECT a AS node, min(least) AS class_id FROM reached JOIN texts ON texts.node = reached.b GROUP BY a),
counts AS (SELECT a AS node, sum(copies) AS n FROM links JOIN texts ON texts.node = links.b GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(copies, 1) AS copies,
       CAST(coalesce(copies - 1 + coalesce(counts.n, 0), 0) AS BIGINT) AS n_links
FROM source LEFT JOIN texts ON texts.w = source.w
LEFT JOIN classes ON classes.node = texts.node LEFT JOIN counts ON counts.node = texts.node
"""

# Every window of 35 words, those that occur twice, and the words that none of them covers.
OP9_SUBSTRING_DEDUP = r"""
WITH source AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
windows AS (
    SELECT rid, unnest(generate_series(1, len(w) - 34)) AS p,
           unnest([md5(array_to_string(w[p:p + 34], ' ')) for p in generate_series(1, len(w) - 34)]) AS h
    FROM source WHERE len(w) >= 35),
seen AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT rid, p FROM windows SEMI JOIN seen USING (h)),
gone AS (SELECT DISTINCT rid, unnest(generate_series(p, p + 34)) AS p FROM hits),
words AS (SELECT rid, unnest(generate_series(1, len(w))) AS p, unnest(w) AS word FROM source),
kept AS (
    SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS rest FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM source LEFT JOIN kept USING (rid)
"""

ORACLES: dict[str, str] = {"op2_ngram_join": OP2_NGRAM_JOIN, "op9_substring_dedup": OP9_SUBSTRING_DEDUP}
