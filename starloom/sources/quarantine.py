"""Rows that do not fit their schema, kept aside with the reasons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from starloom.functions.clean import soft_cast

MALFORMED = "row: malformed"
_STATE = "state"


def read_raw_text(spark: SparkSession, path: str, schema: StructType, malformed: str = "_malformed", sep: str = ";",
                  header: bool = True) -> DataFrame:
    """Delimited text with the columns of ``schema`` as text, and a column that holds the whole line if it has too few
    or too many fields."""
    text = StructType()
    for field in schema:
        text.add(field.name, StringType())
    text.add(malformed, StringType())
    reader = spark.read.schema(text).options(sep=sep, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=malformed)
    return reader.csv(path)


def reasons(df: DataFrame, schema: StructType, required: Sequence[str] = (), malformed: str | None = None) -> dict[str, Column]:
    """Condition for each reason to refuse a row: a value lost by its cast, a required one that is missing, a bad line."""
    have = {f.name.lower(): f for f in df.schema}
    found = {} if malformed is None else {MALFORMED: F.col(f"`{malformed}`").isNotNull()}
    for field in schema:
        source = have.get(field.name.lower())
        raw = F.lit(None) if source is None else F.col(f"`{source.name}`")
        if source is not None and source.dataType != field.dataType and not isinstance(field.dataType, StringType):
            lost = soft_cast(raw, source.dataType, field.dataType).isNull()
            found[f"{field.name}: not {field.dataType.simpleString()}"] = raw.isNotNull() & lost
        if field.name in required:
            found[f"{field.name}: missing"] = raw.isNull()
    return found


@dataclass(frozen=True)
class Routed:
    """Rows that fit, in the types of their schema; the others as they came, with ``reasons``; and what was counted."""

    accepted: DataFrame
    refused: DataFrame
    counts: dict[str, int]

    def report(self) -> DataFrame:
        """``reason, num_rows`` of the reasons that occurred, and of ``accepted`` and ``refused``; a row can have several."""
        spark = self.accepted.sparkSession
        return spark.createDataFrame([(k, n) for k, n in self.counts.items() if n], "reason string, num_rows long")


def route(df: DataFrame, schema: StructType, path: str, required: Sequence[str] = (), malformed: str | None = None) -> Routed:
    """Write the rows of ``df`` below ``path``, those that fit and the others apart, from one scan.

    The write is partitioned by the state of a row, so each state is a table of its own, and the counts are observed
    while it runs. A column that did not arrive is NULL, and missing if it is required. Columns that the schema lacks
    are dropped from accepted rows; refused ones keep everything.
    """
    spark = df.sparkSession
    have = {f.name.lower(): f for f in df.schema}
    named = {k: f"__reason_{i}" for i, k in enumerate(reasons(df, schema, required, malformed))}
    marked = df.withColumns({named[k]: F.coalesce(c, F.lit(False)) for k, c in reasons(df, schema, required, malformed).items()})
    why = F.array_compact(F.array(*[F.when(F.col(c), F.lit(k)) for k, c in named.items()]).cast("array<string>"))
    marked = marked.withColumn("__why", why)
    bad = F.size("__why") > 0
    watch = Observation()
    counts = [F.count_if(F.col(c)).alias(c) for c in named.values()]
    marked = marked.observe(watch, F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("refused"), *counts)

    def typed(field) -> Column:
        source = have.get(field.name.lower())
        if source is None:
            return F.lit(None).cast(field.dataType)
        return soft_cast(F.col(f"`{source.name}`"), source.dataType, field.dataType)

    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    both = marked.select(
        F.when(~bad, F.struct(*[typed(f).alias(f.name) for f in schema])).alias("row"),
        F.when(bad, raw).alias("raw"), F.when(bad, F.col("__why")).alias("reasons"),
        F.when(bad, "refused").otherwise("accepted").alias(_STATE),
    )
    both.write.partitionBy(_STATE).parquet(path)
    stored = spark.read.schema(both.schema).parquet(path)
    seen = watch.get
    totals = {k: seen[k] for k in ("accepted", "refused")} | {k: seen[c] for k, c in named.items()}
    accepted, refused = (stored.where(F.col(_STATE) == s) for s in ("accepted", "refused"))
    return Routed(accepted.select("row.*"), refused.select("raw.*", "reasons"), totals)
