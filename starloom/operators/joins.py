"""Equality joins that hold for any size of either side.

A right side is broadcast only after its rows and bytes were counted. A larger
right side is joined by shuffle; keys that hold many rows of either side are
looked for first and, if there are any, spread over several tasks. Plain joins
of tables that grow with the input take ``shuffled`` or ``counted`` sides.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import stage

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SURELY_LARGE = 16

# A key is spread when it holds more than ROWS_PER_TASK rows and more than
# HOT_SHARE of all rows, so at most 1 / HOT_SHARE keys can ever qualify.
ROWS_PER_TASK = 2_000_000
HOT_SHARE = 1e-5
SAMPLED = 1_000
ROW_BYTES = 32


def text_bytes(df: DataFrame) -> Column:
    """Bytes of a row when its values are written as text."""
    widths = (F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(1)) for name in df.columns)
    return sum(widths, start=F.lit(0))


def is_small(rows: int, size: int, broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int | None = None) -> bool:
    """Whether so many rows and bytes may be copied to every executor."""
    return rows <= broadcast_rows and size <= (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes)


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it, from file sizes and without a job; joins are overestimated."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(
    df: DataFrame, broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int | None = None
) -> bool:
    """Whether ``df`` was counted to be small enough for a broadcast; one aggregate, one row back.

    What the optimizer takes for several times too large is not read to be counted.
    """
    broadcast_bytes = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if broadcast_rows <= 0 or planned_bytes(df) > SURELY_LARGE * broadcast_bytes:
        return False
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(text_bytes(df)).alias("size")).first()
    return is_small(row["rows"], row["size"] or 0, broadcast_rows, broadcast_bytes)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of an equality join by shuffle, whatever the optimizer takes its size for.

    It goes by file sizes, which are compressed, and not by the rows that an explode makes of one. A side that it
    takes for small is collected on the driver, and adaptive execution does not change that once the join would need
    another shuffle.
    """
    return df.hint("merge")


def counted(df: DataFrame) -> DataFrame:
    """``df`` as a side of an inner equality join: copied to all tasks if it was counted to be within the session's
    limit for broadcasts, else shuffled."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    small = limit > 0 and fits_broadcast(df, broadcast_bytes=min(limit, BROADCAST_BYTES))
    return F.broadcast(df) if small else shuffled(df)


def join_on(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
    hot_share: float = HOT_SHARE,
    right_is_small: bool | None = None,
    right_is_unique: bool = False,
    left_counts: DataFrame | None = None,
) -> DataFrame:
    """Join on ``{left column: right column}``; the right key columns are dropped.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. What the
    caller knows already is not measured again: whether the right side is small,
    that its keys are unique, and the rows per left key (``__rows``).
    """
    names = {column: f"__key_{i}" for i, column in enumerate(on.values())}
    keys = dict(zip(on.keys(), names.values(), strict=True))
    right = right.withColumnsRenamed(names).dropna(subset=list(names.values()))
    if how in ("left_semi", "left_anti"):
        right = right.select(*names.values())
        right = right if right_is_unique else right.distinct()
        right_is_unique = True
    if right_is_small is None:
        right_is_small = fits_broadcast(right, broadcast_rows)
    if right_is_small:
        return left.join(F.broadcast(right), _equal(keys), how).drop(*names.values())

    hot_left = _find_hot(left, list(keys), rows_per_task, hot_share, left_counts)
    if right_is_unique:
        joined = _spread_join(left, right, keys, how, hot_left)
        return joined.drop(*names.values())
    hot_right = _find_hot(right, list(names.values()), rows_per_task, hot_share)
    if hot_right is None:
        return _spread_join(left, right, keys, how, hot_left).drop(*names.values())
    # Keys that are frequent on the right do exist there, so for them a left join
    # is an inner join, and both of its sides can be parted.
    cold_rows = (_pick(df, columns, hot_right, "left_anti") for df, columns in ((left, keys), (right, names.values())))
    hot_rows = (_pick(df, columns, hot_right, "left_semi") for df, columns in ((left, keys), (right, names.values())))
    joined = _spread_join(*cold_rows, keys, how, hot_left).unionByName(
        _spread_join(*hot_rows, keys, "inner", hot_left, hot_right)
    )
    return joined.drop(*names.values())


def _equal(keys: Mapping[str, str], null_safe: bool = False) -> Column:
    pairs = [
        F.col(f"`{left}`").eqNullSafe(F.col(right)) if null_safe else F.col(f"`{left}`") == F.col(right)
        for left, right in keys.items()
    ]
    return reduce(lambda a, b: a & b, pairs)


def rows_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``__rows`` per key; NULL counts as a key."""
    return df.groupBy(*(F.col(f"`{key}`") for key in keys)).agg(F.count(F.lit(1)).alias("__rows"))


def hot_keys(counts: DataFrame, rows_per_task: int, hot_share: float) -> DataFrame:
    """Keys that hold too many rows for one task, with the number of tasks each needs (``__parts``).

    The result has at most ``1 / hot_share`` rows, so it may be broadcast.
    """
    floor = counts.agg(F.greatest(F.lit(rows_per_task), F.sum("__rows") * F.lit(hot_share)).alias("floor"))
    return counts.where(F.col("__rows") > floor.scalar()).withColumn(
        "__parts", F.ceil(F.col("__rows") / F.lit(rows_per_task)).cast("int")
    )


def _find_hot(
    df: DataFrame, keys: list[str], rows_per_task: int, hot_share: float, counts: DataFrame | None = None
) -> DataFrame | None:
    """The hot keys of ``df`` as a stored table, or None if there are none.

    Unless the rows per key are known they are estimated from a sample in which
    a hot key has about ``SAMPLED`` rows. What is found only decides how rows
    are spread; the join is exact for any set of keys, as long as both sides use
    the same one, which is why it is stored.
    """
    if counts is None:
        if planned_bytes(df) < rows_per_task * ROW_BYTES:  # too little in all to be too much for a task
            return None
        fraction = min(1.0, SAMPLED / rows_per_task)
        sample = df.select(*(F.col(f"`{key}`") for key in keys))
        counts = rows_per_key(sample.sample(fraction, seed=1) if fraction < 1.0 else sample, keys)
        counts = counts.withColumn("__rows", F.col("__rows") / F.lit(fraction))
    hot = stage(hot_keys(counts, rows_per_task, hot_share), "hot")
    return None if hot.isEmpty() else hot


def _marked(hot: DataFrame, part: str) -> tuple[DataFrame, list[str]]:
    """Hot keys under names that no side of a join has."""
    keys = [c for c in hot.columns if c not in ("__rows", "__parts")]
    names = [f"__hot_{i}" for i in range(len(keys))]
    renamed = (F.col(f"`{key}`").alias(name) for key, name in zip(keys, names, strict=True))
    return hot.select(*renamed, F.col("__parts").alias(part)), names


def _pick(df: DataFrame, keys: Iterable[str], hot: DataFrame, how: str) -> DataFrame:
    """Rows with (``left_semi``) or without (``left_anti``) a hot key."""
    listed, names = _marked(hot, "__parts")
    return df.join(F.broadcast(listed), _equal(dict(zip(keys, names, strict=True)), null_safe=True), how)


def _parts(df: DataFrame, keys: Iterable[str], hot: DataFrame, part: str) -> DataFrame:
    """Add the number of parts of the key of each row."""
    listed, names = _marked(hot, part)
    found = df.join(F.broadcast(listed), _equal(dict(zip(keys, names, strict=True)), null_safe=True), "left")
    return found.withColumn(part, F.coalesce(part, F.lit(1))).drop(*names)


def _one_part(df: DataFrame, keys: Iterable[str], hot: DataFrame, part: str) -> DataFrame:
    """Put each row into one part of its key."""
    # Content and input task are the same when a task is retried, unlike the place
    # of a row within its task; the task number parts exact copies of a row. All
    # columns are read for this, so select what is needed before a large join.
    hashable = (F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString())
    row = F.xxhash64(*hashable, F.spark_partition_id())
    return _parts(df, keys, hot, part).withColumn(part, F.pmod(row, F.col(part)).cast("int"))


def _all_parts(df: DataFrame, keys: Iterable[str], hot: DataFrame, part: str) -> DataFrame:
    """Copy each row into all parts of its key."""
    return _parts(df, keys, hot, part).withColumn(part, F.explode(F.sequence(F.lit(0), F.col(part) - 1)))


def _spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    how: str,
    hot_left: DataFrame | None,
    hot_right: DataFrame | None = None,
) -> DataFrame:
    """Join by shuffle in which each hot key is parted into several keys; a plain join if none is hot.

    A row goes to one part of a key that is hot on its own side, and is copied to
    all parts of a key that is hot on the other side: every pair meets just once.
    """
    ours, theirs = keys.keys(), keys.values()
    match = _equal(keys)
    if hot_left is not None:
        left = _one_part(left, ours, hot_left, "__left_part")
        right = _all_parts(right, theirs, hot_left, "__left_copy")
        match = match & (F.col("__left_part") == F.col("__left_copy"))
    if hot_right is not None:
        left = _all_parts(left, ours, hot_right, "__right_copy")
        right = _one_part(right, theirs, hot_right, "__right_part")
        match = match & (F.col("__right_part") == F.col("__right_copy"))
    return left.join(right, match, how).drop("__left_part", "__left_copy", "__right_part", "__right_copy")


def unmatched(left: DataFrame, right: DataFrame, on: Mapping[str, str], **limits) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``; a NULL key has none."""
    return join_on(left, right, on, "left_anti", **limits)


def drop_listed(df: DataFrame, listed: DataFrame, on: Mapping[str, str], **limits) -> DataFrame:
    """``df`` without the rows whose key is listed."""
    return unmatched(df, listed, on, **limits)


def left_merge(left: DataFrame, right: DataFrame, on: Mapping[str, str], **limits) -> DataFrame:
    """All rows of ``left`` with every partner from ``right``; fans out where the right key repeats."""
    return join_on(left, right, on, "left", **limits)
