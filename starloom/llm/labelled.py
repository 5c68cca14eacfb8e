"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000


def hash_sample(df: DataFrame, key: str, count: int, rows: int) -> DataFrame:
    """The same share of the ``count`` rows on every run, so that about ``rows`` remain; all if there are no more."""
    parts = 1 << 30
    return df if count <= rows else df.where(F.pmod(F.xxhash64(key), F.lit(parts)) < int(parts * rows / count))


def labelled_sample(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, id_col: str = "doc_id") -> DataFrame:
    """About ``rows`` labelled identifiers (doc_id, label) or all if there are fewer, chosen by a hash of the identifier.

    Rows with a NULL identifier or label are left out; of several labels of one identifier the largest counts.
    The result is small enough to be broadcast whatever the size of ``labels``.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    one = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    chosen = hash_sample(one, "doc_id", one.count(), rows).collect()
    return labels.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in chosen], "doc_id long, label int")


def labelled_texts(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, label, text`` of a labelled sample, one row for each identifier however often it occurs."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
