"""A corpus in five stages: toxicity, quality, exact copies, near copies, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, folder of the tables) and gives the rows that
go on. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.exact import drop_exact
from starloom.llm.near_text import drop_near
from starloom.llm.packing import pack_documents
from starloom.llm.quality import fit_rules, keep_good
from starloom.llm.registry import table
from starloom.llm.toxicity import drop_toxic, fit_toxicity
from starloom.session import stage

ORACLE_SQL = None  # toxicity and quality are fitted, tokens come from a tokenizer


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are graded as toxic go."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score below one half go."""
    return keep_good(docs, fit_rules(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest identifier."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest identifier."""
    return drop_near(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces placed in sequences."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("quality", quality), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
