"""Keys and order-dependent columns that do not gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators import joins
from starloom.session import stage

_POSITION_BITS = 33
_IDS = 1 << 31


def _chunked(df: DataFrame, order: Sequence[str | Column], chunks: int | None) -> DataFrame:
    """``df`` with ``__chunk`` and ``__pos``: sorted runs of bounded size, stored as a table.

    All rows of a chunk come before all rows of the next one in ``order``. The
    runs are cut by range over the whole order, so one large group takes many.
    Without ``chunks`` AQE merges neighbouring runs of little data.
    """
    ranged = df.repartitionByRange(chunks, *order) if chunks else df.repartitionByRange(*order)
    place = F.monotonically_increasing_id()
    return stage(
        ranged.sortWithinPartitions(*order)
        .withColumn("__chunk", F.shiftright(place, _POSITION_BITS).cast("int"))
        .withColumn("__pos", place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))),
        "chunks",
    )


def dense_key(
    df: DataFrame, order: Sequence[str | Column], out: str, start: int = 1, chunks: int | None = None
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in a total ``order``."""
    runs = _chunked(df, order, chunks)
    sizes = runs.groupBy("__chunk").agg(F.count(F.lit(1)).alias("__size"))
    # One row per chunk, so this window sees no more rows than there are chunks.
    before = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("__chunk").alias("__of"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    numbered = runs.join(F.broadcast(offsets), F.col("__chunk") == F.col("__of"))
    key = F.col("__offset") + F.col("__pos") + F.lit(start)
    return numbered.withColumn(out, key.cast("bigint")).drop("__chunk", "__pos", "__of", "__offset")


def carry_forward(
    df: DataFrame,
    column: str,
    partition: Sequence[str],
    order: Sequence[str],
    out: str,
    chunks: int | None = None,
) -> DataFrame:
    """Last value of ``column`` that is not NULL, up to and including the row, per partition.

    ``order`` must be total within a partition. A partition may be of any size:
    it is worked on in chunks, and each chunk starts from the last value of the
    chunks before it.
    """
    runs = _chunked(df, [*partition, *order], chunks)
    value = F.col(column)
    tails = runs.groupBy("__chunk", *partition).agg(
        F.max_by(value, F.when(value.isNotNull(), F.col("__pos"))).alias("__tail")
    )
    # One row per chunk and partition; only the first partition of a chunk can
    # have begun in an earlier chunk, so at most one row per chunk remains.
    earlier = Window.partitionBy(*partition).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__group_{i}" for i in range(len(partition))]
    carried = (
        tails.withColumn("__carry", F.last("__tail", ignorenulls=True).over(earlier))
        .where(F.col("__carry").isNotNull())
        .select(F.col("__chunk").alias("__in"), "__carry",
                *(F.col(p).alias(n) for p, n in zip(partition, names, strict=True)))
    )
    match = F.col("__chunk") == F.col("__in")
    for p, n in zip(partition, names, strict=True):
        match = match & F.col(p).eqNullSafe(F.col(n))
    within = Window.partitionBy("__chunk", *partition).orderBy("__pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        runs.withColumn("__here", F.last(value, ignorenulls=True).over(within))
        .join(F.broadcast(carried), match, "left")
        .withColumn(out, F.coalesce("__here", "__carry"))
        .drop("__chunk", "__pos", "__here", "__carry", "__in", *names)
    )


def carry_in_group(df: DataFrame, column: str, partition: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """:func:`carry_forward` for groups whose size has a bound, such as the rows of one page: one shuffle."""
    so_far = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.last(column, ignorenulls=True).over(so_far))


def group_size(df: DataFrame, key: str, out: str, counted: str | None = None, **limits) -> DataFrame:
    """Add the number of rows (or of values of ``counted``) with the same key; NULL for a NULL key.

    Counted with map-side aggregation and joined back, so a frequent key costs
    no more than a rare one. The counts are stored: they also tell which keys
    to spread in the join.
    """
    rows = F.count(F.lit(1))
    size = F.count(F.col(counted)) if counted else rows
    counts = stage(df.groupBy(key).agg(rows.alias("__rows"), size.alias("__size")), "sizes")
    sizes = counts.where(F.col(key).isNotNull()).select(F.col(key).alias("__of"), F.col("__size").alias(out))
    return joins.join_on(
        df, sizes, {key: "__of"}, "left", right_is_unique=True, left_counts=counts.select(key, "__rows"), **limits
    )


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must be total. NULL counts as a key.

    Spark keeps one row per key and task before the shuffle (window group limit),
    so a frequent key arrives with a row per task at most.
    """
    place = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")


def keep_curated(df: DataFrame, key: str, curated: DataFrame, on: Sequence[str], **limits) -> DataFrame:
    """Rows with a unique key, and of the rows with a repeated key only the curated ones.

    A repeated key without a curated row disappears. Rows with a NULL key stay.
    """
    sized = group_size(df, key, "__n", **limits)
    chosen = curated.select(*on).distinct().withColumn("__chosen", F.lit(True))
    # One join with a mark and one filter, so that what lies above is computed once.
    marked = joins.join_on(sized, chosen, dict(zip(on, on, strict=True)), "left", right_is_unique=True, **limits)
    return marked.where((F.coalesce("__n", F.lit(1)) == 1) | F.col("__chosen")).drop("__n", "__chosen")


def period_key(year: Column, month: Column, ident: Column) -> Column:
    """64-bit key that holds period and 32-bit source id, so it never clashes across periods.

    The same source row gets the same key in every load. An id beyond 32 bits
    (signed) has no key of its own: the job fails rather than mix two rows up.
    """
    period = year.cast("bigint") * 12 + month.cast("bigint")
    wide = ident.cast("bigint")
    fits = wide.between(-_IDS, _IDS - 1) | wide.isNull()
    return F.when(fits, F.shiftleft(period, 32).bitwiseOR(wide.bitwiseAND(F.lit(2 * _IDS - 1)))).otherwise(
        F.raise_error(F.concat(F.lit("id does not fit the key: "), wide.cast("string"))))


def stable_key(*columns: str | Column) -> Column:
    """64-bit content hash. Two different rows share one with odds of about n² / 2⁶⁵."""
    return F.xxhash64(*columns)


def load_row_id() -> Column:
    """Row number within one load: starts anew with every load and depends on file splits."""
    return F.monotonically_increasing_id()
