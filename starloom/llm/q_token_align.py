"""Query of aligned tokenizers; its result comes from two vocabularies, so there is no SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.registry import query, table
from starloom.llm.token_align import align_tokenizers


@query("op12_token_align")
def op12_token_align(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokenizers(table(spark, folder, "documents"))
