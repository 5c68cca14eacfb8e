"""Query of ranked lexical search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.blocked_search import search_documents
from starloom.llm.registry import query, table

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query("op11_blocked_search", f"""
WITH words AS (SELECT doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT doc_id, len(w) AS n FROM words WHERE len(w) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
counted AS (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted, total GROUP BY term, n_docs),
scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))
        AS BIGINT) AS score
    FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), total GROUP BY ALL),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""")
def op11_blocked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
