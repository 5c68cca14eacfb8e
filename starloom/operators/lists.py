"""Several values in one cell: split, zip, explode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_codes(df: DataFrame, column: str, separators: str, position: str | None = None) -> DataFrame:
    """One row per part of ``column``, split at the regular expression ``separators``.

    Other columns repeat; ``position`` names a column for the part number, from 0.
    A NULL cell gives one row, like a cell without separators.
    """
    parts = F.split(F.col(column), separators)
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    exploded = df.select(*others, F.posexplode_outer(parts).alias("__pos", column))
    order = [F.col(f"`{c}`") for c in df.columns]
    if position:
        order.append(F.coalesce("__pos", F.lit(0)).alias(position))
    return exploded.select(*order)


def lines(text: Column, skip: int = 0, keep_blank: bool = True) -> Column:
    """The lines of a cell, without the first ``skip``, and without empty ones if so asked."""
    parts = F.split(text, "\n")
    if skip:
        parts = F.slice(parts, F.lit(skip + 1), F.greatest(F.size(parts) - skip, F.lit(0)))
    return parts if keep_blank else F.filter(parts, lambda part: part != "")


def zip_explode(df: DataFrame, columns: dict[str, Column], position: str | None = None) -> DataFrame:
    """One row per place of parallel lists, up to the end of the shortest.

    ``columns`` maps output names to list expressions; other columns repeat.
    """
    shortest = F.least(*(F.size(value) for value in columns.values())) if len(columns) > 1 else (
        F.size(next(iter(columns.values()))))
    length = F.greatest(shortest, F.lit(0))
    cut = [F.slice(value, F.lit(1), length).alias(name) for name, value in columns.items()]
    others = [c for c in df.columns if c not in columns]
    zipped = df.select(
        *(F.col(f"`{c}`") for c in others),
        F.posexplode(F.arrays_zip(*cut)).alias("__pos", "__row"),
    )
    names = [c for c in df.columns if c not in columns] + list(columns)
    chosen = [F.col(f"`{c}`") if c in others else F.col("__row")[c].alias(c) for c in names]
    if position:
        chosen.append(F.col("__pos").alias(position))
    return zipped.select(*chosen)


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column a frame lacks is NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def with_unknown_row(df: DataFrame, values: dict, key: str | None = None) -> DataFrame:
    """``df`` plus one row of ``values``; other columns are NULL in it.

    With ``key`` the row is left out if ``df`` has a row with that key, so the key stays unique.
    """
    spark = df.sparkSession
    row = spark.range(1).select(
        *(F.lit(values.get(field.name)).cast(field.dataType).alias(field.name) for field in df.schema)
    )
    if key is None:
        return row.unionByName(df)
    both = row.withColumn("__added", F.lit(True)).unionByName(df.withColumn("__added", F.lit(False)))
    alone = F.every("__added").over(Window.partitionBy(key))
    return both.withColumn("__alone", alone).where(~F.col("__added") | F.col("__alone")).select(*df.columns)
