"""Query of near-duplicate vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.near_vectors import near_vector_links
from starloom.llm.registry import query, table


@query("op4_near_vectors", """
WITH RECURSIVE good AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)""")
def op4_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vector_links(table(spark, folder, "embeddings"))
