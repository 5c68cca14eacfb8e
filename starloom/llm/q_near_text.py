"""Query of near-duplicate texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.near_text import near_text_components
from starloom.llm.registry import query, table


@query("op3_near_dedup", r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words),
shingles AS (SELECT doc_id, hash(unnest(s)) AS h FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (h)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sets sa ON sa.doc_id = a JOIN sets sb ON sb.doc_id = b
    WHERE 100 * n >= 75 * (len(sa.s) + len(sb.s) - n)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)""")
def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_text_components(table(spark, folder, "documents"))
