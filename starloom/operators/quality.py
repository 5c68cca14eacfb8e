"""Data quality: declared checks, one pass per dataset, a stored report, a gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom import schema
from starloom.functions.clean import soft_cast
from starloom.operators import joins, profile
from starloom.sinks import is_missing


class QualityGateFailed(Exception):
    """At least one check of a stored report failed."""


@dataclass(frozen=True)
class Dataset:
    """A dataset and its checks.

    It has rows; the ``not_null`` fields hold no NULL; the ``unique`` fields are
    unique; no two rows agree in all ``distinct_in`` fields; each of the
    ``references`` (field, dimension, key) exists. ``path`` is read as parquet
    unless ``frame`` is given. ``where`` picks the tested rows, for example one
    period; partitions it excludes are not read.
    """

    path: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    distinct_in: Sequence[str] = ()
    where: str | None = None
    references: Sequence[tuple[str, DataFrame, str]] = ()
    frame: DataFrame | None = None

    def load(self, spark: SparkSession) -> DataFrame | None:
        if self.frame is not None:
            df = self.frame
        else:
            try:
                df = spark.read.parquet(self.path)
            except AnalysisException as error:
                if not is_missing(error):
                    raise
                return None
        return df.where(self.where) if self.where else df


def _report(counts: DataFrame, test: str, passed, year, month, path: str) -> DataFrame:
    """Report rows from ``(field, num_recs)``."""
    return counts.select(
        F.lit(str(year)).alias("year"),
        F.lit(str(month)).alias("month"),
        F.lit(path).alias("path"),
        F.lit(test).alias("test"),
        F.when(passed, "passed").otherwise("failed").alias("result"),
        F.col("field").cast("string").alias("field"),
        F.col("num_recs").cast("string").alias("num_recs"),
    )


def _row_and_null_checks(df: DataFrame, fields: Sequence[str], year, month, path: str) -> DataFrame:
    """Row count and all NULL counts from one aggregate over the dataset."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in fields)
    )

    def result(test, field, count, passed):
        return F.struct(F.lit(test).alias("test"), F.lit(field).cast("string").alias("field"),
                        count.alias("num_recs"), passed.alias("ok"))

    rows = [result("has_rows", None, F.col("rows"), F.col("rows") > 0)]
    rows += [result("has_nulls", f, F.col(f"null_{f}"), F.col(f"null_{f}") == 0) for f in fields]
    return counted.select(F.inline(F.array(*rows))).select(
        F.lit(str(year)).alias("year"),
        F.lit(str(month)).alias("month"),
        F.lit(path).alias("path"),
        "test",
        F.when(F.col("ok"), "passed").otherwise("failed").alias("result"),
        "field",
        F.col("num_recs").cast("string").alias("num_recs"),
    )


def _unique_check(df: DataFrame, field: str, year, month, path: str) -> DataFrame:
    # A NULL is no key: ``has_nulls`` counts it.
    groups = df.where(F.col(field).isNotNull()).groupBy(field).agg(F.count(F.lit(1)).alias("n"))
    surplus = groups.agg(
        F.lit(field).alias("field"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("num_recs")
    )
    return _report(surplus, "is_unique", F.col("num_recs") == 0, year, month, path)


def unique_across_check(repeated: DataFrame, field: str, year, month, path: str) -> DataFrame:
    """Report of the different keys that ``repeated`` names, none of which should be in other periods."""
    found = repeated.where(F.col("field") == field).agg(
        F.lit(field).alias("field"), F.countDistinct("value").alias("num_recs"))
    return _report(found, "is_unique_across", F.col("num_recs") == 0, year, month, path)


def _duplicate_check(df: DataFrame, fields: Sequence[str], year, month, path: str) -> DataFrame:
    surplus = profile.surplus_rows(df, fields).select(
        F.lit(", ".join(fields)).alias("field"), F.col("surplus").alias("num_recs")
    )
    return _report(surplus, "no_duplicates", F.col("num_recs") == 0, year, month, path)


def _reference_check(df: DataFrame, field: str, dim: DataFrame, key: str, year, month, path: str) -> DataFrame:
    """Rows whose key is missing in the dimension; keys are counted before they are joined."""
    per_key = df.where(F.col(field).isNotNull()).groupBy(field).agg(F.count(F.lit(1)).alias("n"))
    dangling = joins.unmatched(per_key, dim, {field: key}).agg(
        F.lit(field).alias("field"), F.coalesce(F.sum("n"), F.lit(0)).alias("num_recs")
    )
    return _report(dangling, "fk_exists", F.col("num_recs") == 0, year, month, path)


def run_checks(
    spark: SparkSession, datasets: Sequence[Dataset], year, month, on_missing: str = "fail"
) -> DataFrame:
    """Report of all checks: one row per test, all columns text.

    A dataset that cannot be read fails ``has_rows`` without a count;
    ``on_missing='skip'`` leaves it out of the report.
    """
    parts = []
    for dataset in datasets:
        df = dataset.load(spark)
        if df is None:
            if on_missing == "fail":
                nothing = spark.range(1).select(F.lit(None).alias("field"), F.lit(None).alias("num_recs"))
                parts.append(_report(nothing, "has_rows", F.lit(False), year, month, dataset.path))
            continue
        parts.append(_row_and_null_checks(df, dataset.not_null, year, month, dataset.path))
        parts += [_unique_check(df, f, year, month, dataset.path) for f in dataset.unique]
        if dataset.distinct_in:
            parts.append(_duplicate_check(df, dataset.distinct_in, year, month, dataset.path))
        parts += [_reference_check(df, f, d, k, year, month, dataset.path) for f, d, k in dataset.references]
    if not parts:
        return spark.createDataFrame([], schema.REPORT)
    return reduce(DataFrame.unionByName, parts)


def model_datasets(root: str, year: int, month: int) -> list[Dataset]:
    """Checks of a whole model for one period: every key and every reference of the fact."""
    period = f"year = {int(year)} AND month = {int(month)}"
    return [
        Dataset(f"{root}/{name}.parquet", fields, where=period if name in schema.PERIOD_TABLES else None)
        for name, fields in schema.NOT_NULL.items()
    ]


def store_report(report: DataFrame, path: str) -> DataFrame:
    """Append the report as one file and return what this run stored."""
    spark = report.sparkSession
    # A few rows per dataset; kept on the driver so that the checks run once.
    rows = spark.createDataFrame(report.collect(), schema.REPORT)
    rows.coalesce(1).write.mode("append").parquet(path)
    return rows


def failed_count(report: DataFrame) -> int:
    return report.where(F.col("result") == "failed").count()


def gate(report: DataFrame) -> None:
    """Raise if a check failed. Call it after the report is stored."""
    failed = failed_count(report)
    if failed:
        raise QualityGateFailed(f"{failed} data quality checks failed")


def cast_failures(raw: DataFrame, target: StructType) -> DataFrame:
    """``field``, ``num_recs``: values present in ``raw`` that the cast to the target types loses, in one pass."""
    types = {f.name: f.dataType for f in raw.schema}
    fields = [f for f in target if f.name in types]
    counted = raw.agg(*(
        F.count_if(
            F.col(f.name).isNotNull() & soft_cast(F.col(f.name), types[f.name], f.dataType).isNull()
        ).alias(f.name)
        for f in fields
    ))
    return profile.unpivot_row(counted, [f.name for f in fields], "field", "num_recs")
