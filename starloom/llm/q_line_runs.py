"""Query of repeated lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.line_runs import dedup_lines
from starloom.llm.registry import query, table


@query("op13_line_dedup", """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split),
keyed AS (
    SELECT doc_id, pos, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
    SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, largest IS NOT NULL AND doc_id <> largest AS lost FROM keyed k LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
