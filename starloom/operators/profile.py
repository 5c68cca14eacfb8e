"""Profiles of tables: frequencies, NULLs, summaries, distinct values, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from starloom.operators import joins
from starloom.session import stage


def frequencies(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Rows per value, most frequent first, equal counts by value."""
    if out == column:
        raise ValueError(f"{out!r} is the counted column")
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.asc_nulls_first(column))


def top_values(df: DataFrame, column: str, k: int, out: str = "n") -> DataFrame:
    """The ``k`` most frequent values, equal counts by value."""
    return frequencies(df, column, out).limit(k)


def first_rows(df: DataFrame, k: int, order: Sequence[str]) -> DataFrame:
    """The first ``k`` rows in ``order``: a development extract that is the same in every run."""
    return df.orderBy(*order).limit(k)


def sample_rows(df: DataFrame, k: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``k`` rows picked by a hash of their ``key``: random, but the same in every run of a seed."""
    parts = F.concat_ws("|", F.lit(str(seed)), *(F.col(f"`{c}`").cast("string") for c in key))
    return df.orderBy(F.md5(parts), *key).limit(k)


def unpivot_row(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Turn a one-row frame into one row per column."""
    return row.unpivot([], list(columns), name, value)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``field``, ``nulls`` for each column, counted together in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(*(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns))
    return unpivot_row(counted, columns, "field", "nulls")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of number columns, as numbers."""
    def summary(column: str) -> Column:
        value = F.col(f"`{column}`").cast("double")
        return F.struct(
            F.lit(column).alias("field"),
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("minimum"),
            F.max(value).alias("maximum"),
        )

    return df.agg(F.array(*(summary(c) for c in columns)).alias("rows")).select(F.inline("rows"))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column."""
    return df.agg(F.min(column).alias("minimum"), F.max(column).alias("maximum"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``field``, ``n`` distinct values per column, NULL counted as a value.

    One pass turns rows into (field, value); equal pairs meet before the shuffle.
    """
    pairs = F.explode(F.array(*(
        F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ))).alias("pair")
    return (
        df.select(pairs).select("pair.field", "pair.value").distinct()
        .groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    )


def approx_distinct_values(df: DataFrame, columns: Sequence[str], error: float = 0.01) -> DataFrame:
    """Like :func:`distinct_values`, estimated in one pass without a shuffle of values (NULL not counted)."""
    counted = df.agg(*(F.approx_count_distinct(F.col(f"`{c}`"), error).alias(c) for c in columns))
    return unpivot_row(counted, list(columns), "field", "n")


def repeated_rows(df: DataFrame, columns: Sequence[str] | None = None, out: str = "n") -> DataFrame:
    """Groups of rows that agree in ``columns``, with their count, where more than one row agrees."""
    columns = list(columns or df.columns)
    if out in columns:
        raise ValueError(f"{out!r} is a column of the rows")
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def surplus_rows(df: DataFrame, columns: Sequence[str] | None = None, **limits) -> DataFrame:
    """``rows`` in all and ``surplus`` rows that repeat another one in ``columns``; exact.

    Made for wide rows and long texts: rows are counted by a 64-bit hash first,
    and only rows that share a hash are shuffled and compared in full.
    """
    columns = list(columns or df.columns)
    hashed = df.select(F.xxhash64(*columns).alias("__hash"), *columns)
    counts = stage(joins.rows_per_key(hashed, ["__hash"]), "hashes")
    shared = counts.where("__rows > 1").select(F.col("__hash").alias("__shared"))
    suspects = joins.join_on(
        hashed, shared, {"__hash": "__shared"}, "left_semi", right_is_unique=True, left_counts=counts, **limits
    )
    groups = suspects.groupBy("__hash", *columns).agg(F.count(F.lit(1)).alias("__rows"))
    rows = counts.agg(F.coalesce(F.sum("__rows"), F.lit(0)))
    surplus = groups.agg(F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)))
    return df.sparkSession.range(1).select(rows.scalar().alias("rows"), surplus.scalar().alias("surplus"))


def groups_over_one(df: DataFrame, key: str) -> DataFrame:
    """``groups``: how many values of ``key`` (NULL left out) occur more than once."""
    return repeated_rows(df.where(F.col(key).isNotNull()), [key], "__rows").agg(F.count(F.lit(1)).alias("groups"))


def require_no_duplicates(df: DataFrame, ignore: Sequence[str] = ()) -> None:
    """Raise if two rows agree in all columns but the ignored ones."""
    surplus = surplus_rows(df, [c for c in df.columns if c not in ignore]).first()["surplus"]
    if surplus:
        raise ValueError(f"{surplus} duplicate rows")


def mergeable_profile(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """What the rows of each key say of each column, in one pass and in a form that :func:`merge_profiles` adds up.

    ``field, rows, nulls, total, squares, least, largest, least_text, largest_text, distinct``: sums and bounds of
    numbers and dates (as days), bounds of text, and a sketch of the distinct values (some kilobytes a column).
    """
    types = {f.name: f.dataType for f in df.schema}
    counted, rows = [], []
    for i, name in enumerate(columns):
        value, text = F.col(f"`{name}`"), isinstance(types[name], StringType)
        number = F.lit(None).cast("double") if text else (
            F.unix_date(value) if isinstance(types[name], DateType) else value).cast("double")
        words = value if text else F.lit(None).cast("string")
        # Sketches take numbers and text; a float goes in by its hash.
        exact = value if text else F.xxhash64(value) if types[name].typeName() in ("double", "float") else number.cast("long")
        parts = {
            "nulls": F.count_if(value.isNull()), "total": F.sum(number), "squares": F.sum(number * number),
            "least": F.min(number), "largest": F.max(number), "least_text": F.min(words), "largest_text": F.max(words),
            "distinct": F.hll_sketch_agg(F.when(value.isNotNull(), exact)),
        }
        counted += [c.alias(f"{part}_{i}") for part, c in parts.items()]
        rows.append(F.struct(F.lit(name).alias("field"), "rows", *[F.col(f"{part}_{i}").alias(part) for part in parts]))
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *counted)
    return found.select(*keys, F.inline(F.array(*rows)))


def merge_profiles(profiles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Profiles added up by column (and ``keys``): the same sums and bounds as over all rows together."""
    return profiles.groupBy(*keys, "field").agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls", "total", "squares")],
        *[F.min(c).alias(c) for c in ("least", "least_text")], *[F.max(c).alias(c) for c in ("largest", "largest_text")],
        F.hll_union_agg("distinct").alias("distinct"),
    )


def describe_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles in readable form: ``mean``, ``stddev`` (of the sample), bounds, and the estimated ``distinct_values``.

    The estimate is off by about 2 % at most in two of three cases, and exact or nearly so for a few hundred values.
    """
    n = F.col("rows") - F.col("nulls")
    spread = F.greatest(F.lit(0.0), F.col("squares") - F.col("total") * F.col("total") / n)
    return profiles.select(
        "field", "rows", "nulls", F.try_divide("total", n).alias("mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("stddev"), "least", "largest", "least_text", "largest_text",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
    )
