"""Query of the main texts of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.main_text import main_texts
from starloom.llm.registry import query, table


@query("op1_main_text")
def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(table(spark, folder, "pages"))
