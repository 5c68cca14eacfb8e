"""Query of toxicity grades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.registry import query, table
from starloom.llm.toxicity import fit_toxicity, toxicity_scores


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity_scores(docs, fit_toxicity(docs, table(spark, folder, "labels")))
