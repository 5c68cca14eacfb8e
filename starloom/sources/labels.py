"""Code tables out of label definition texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.text import strip


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``source`` (path) and ``text``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")
    )


def parse_label_block(
    texts: DataFrame, marker: str, key: str, value: str, source: str = "source", text: str = "text"
) -> DataFrame:
    """``source``, ``key``, ``value`` from the block behind ``marker`` in each text.

    A block runs to the next ``;``. Its first line is the marker's own; each
    other line of the form ``'code' = 'label'`` gives a row. Quotes, tabs and
    white space around both parts are dropped. The last label of a repeated
    code wins. A text without the marker gives no rows.
    """
    plain = F.replace(F.col(text), F.lit("\t"), F.lit(""))
    start = F.position(F.lit(marker), plain)
    block = F.substring_index(F.substring(plain, start, F.length(plain)), ";", 1)
    found = texts.where(start > 0).select(source, F.posexplode(F.split(block, "\n")).alias("line", "content"))
    parts = F.split(F.replace(F.col("content"), F.lit("'"), F.lit("")), "=")
    pairs = found.where((F.col("line") > 0) & (F.size(parts) == 2)).select(
        source, "line", strip(parts[0]).alias(key), strip(parts[1]).alias(value)
    )
    return pairs.groupBy(source, key).agg(F.max_by(value, "line").alias(value))
