"""Query of quality scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.quality import fit_rules, quality_scores
from starloom.llm.registry import query, table


def held_out() -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit_rules(docs, table(spark, folder, "labels").where(~held_out()))
    return quality_scores(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
