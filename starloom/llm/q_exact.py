"""Query of exact duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.exact import exact_groups
from starloom.llm.registry import query, table


@query("op9_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))
