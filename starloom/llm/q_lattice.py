"""Query of text likelihoods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.lattice import lattice_scores
from starloom.llm.registry import query, table


@query("op10_lattice_likelihood")
def op10_lattice_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_scores(table(spark, folder, "documents"))
