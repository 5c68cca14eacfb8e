"""Query of token totals, kept up to date by four batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.registry import query, table
from starloom.llm.rollup import Rollup, count_tokens
from starloom.session import scratch_path, stage

VERSION = "byte_bpe_50k/1"


@query("op5_token_rollup")
def op5_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of all documents after inserts with estimates, a repeated batch, revised counts and deletions.

    Documents arrive with a quarter of their characters as an estimate. The counts of whole texts then revise them,
    and documents without any word are deleted.
    """
    docs = table(spark, folder, "documents")
    counted = stage(count_tokens(docs, VERSION), "counted")
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    first = docs.select(
        F.lit("insert").alias("op"), F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
        F.lit(VERSION).alias("tokenizer"),
        F.floor(F.coalesce(F.length("text"), F.lit(0)) / 4).alias("tokens"), F.lit(0).cast("long").alias("seq"))
    revised = counted.select(F.lit("revise").alias("op"), "doc_id", "source", "lang", "tokenizer", "tokens",
                             F.lit(1).cast("long").alias("seq"))
    gone = docs.where("text IS NULL OR NOT text RLIKE '[^ \\t\\n\\r\\x0B\\f]'").select(
        F.lit("delete").alias("op"), F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
        F.lit(VERSION).alias("tokenizer"), F.lit(0).cast("long").alias("tokens"), F.lit(2).cast("long").alias("seq"))
    for batch, events in (("arrivals", first), ("arrivals", first), ("counts", revised), ("deletions", gone)):
        rollup.apply(batch, events)
    return rollup.totals()
