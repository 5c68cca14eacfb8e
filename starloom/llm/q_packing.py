"""Query of packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.packing import pack_documents
from starloom.llm.registry import query, table


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))
