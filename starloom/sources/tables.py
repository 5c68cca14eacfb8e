"""Delimited files, parquet tables and periods, literal tables, typed extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions.clean import soft_cast


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | None = None, sep: str = ";", header: bool = True
) -> DataFrame:
    """Delimited text. Without a schema all columns are text. ``NA`` is text, an empty field is NULL."""
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """Parquet if the path says so, ``;`` separated text otherwise; ``fmt`` overrides."""
    fmt = fmt or ("parquet" if "parquet" in path else "csv")
    if fmt == "csv":
        return read_delimited(spark, path, schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def in_period(year: int, month: int) -> Column:
    """Condition that picks one period."""
    return (F.col("year") == int(year)) & (F.col("month") == int(month))


def read_period(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """One period of a partitioned table, with its period columns; other partitions are not read."""
    return spark.read.parquet(root).where(in_period(year, month))


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A small table written out in code; made in the JVM, without Python rows."""
    if not rows:
        return spark.createDataFrame([], schema)
    structs = (
        F.struct(*(F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, schema, strict=True)))
        for row in rows
    )
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def conform(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """The columns of ``schema`` by name, cast to its types.

    A value that does not fit is NULL, and so is a column that did not arrive;
    other columns are dropped. ``strict`` raises for a missing column and lets
    a value that does not fit end the job.
    """
    have = {field.name.lower(): field for field in df.schema}
    columns = []
    for field in schema:
        source = have.get(field.name.lower())
        if source is None:
            if strict:
                raise ValueError(f"column {field.name} is missing")
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(f"`{source.name}`")
        value = soft_cast(raw, source.dataType, field.dataType)
        if strict:
            lost = F.raise_error(F.concat(F.lit(f"{field.name}: "), raw.cast("string"))).cast(field.dataType)
            value = F.when(value.isNull() & raw.isNotNull(), lost).otherwise(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)
