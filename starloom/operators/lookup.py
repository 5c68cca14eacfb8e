"""Code lookups: map source codes to dimension keys, with a sentinel for misses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.clean import exact_cast
from starloom.operators import joins

MAP_ROWS = 10_000


class DuplicateKeys(ValueError):
    """A lookup table holds a key more than once, so a lookup would multiply rows."""


def code_table(
    dim: DataFrame, keys: list[str], value: str, on_duplicate: str = "error",
    broadcast_rows: int = joins.BROADCAST_ROWS,
) -> tuple[DataFrame, bool]:
    """Keys and value of ``dim`` without NULLs, and whether they are small enough for a broadcast.

    ``on_duplicate``: ``error`` raises if a key repeats, ``first`` keeps the
    smallest value, ``fanout`` leaves the table as it is. Uniqueness and size
    come from one aggregate.
    """
    if on_duplicate not in ("error", "first", "fanout"):
        raise ValueError(f"on_duplicate: {on_duplicate!r}")
    codes = dim.select(*dict.fromkeys([*keys, value])).dropna()
    if on_duplicate == "first":
        codes = codes.groupBy(*keys).agg(F.min(value).alias(value)) if value not in keys else codes.distinct()
    per_key = codes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(joins.text_bytes(codes)).alias("size")
    )
    found = per_key.agg(F.sum("rows"), F.sum("size"), F.max("rows")).first()
    rows, size, most = (part or 0 for part in found)
    if most > 1 and on_duplicate == "error":
        examples = [tuple(row)[:-2] for row in per_key.where("rows > 1").limit(3).collect()]
        raise DuplicateKeys(f"{keys} repeat, for example {examples}")
    return codes, joins.is_small(rows, size, broadcast_rows)


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    value: str,
    out: str,
    sentinel=None,
    on_duplicate: str = "error",
    **limits,
) -> DataFrame:
    """Add ``out``: the ``value`` of the row of ``dim`` with the same key.

    Misses and NULL keys get ``sentinel``, which is cast to the type of
    ``value``. With a unique key the number of rows does not change.
    """
    return lookup_roles(fact, dim, {out: on}, value, sentinel, on_duplicate, **limits)


def lookup_roles(
    fact: DataFrame,
    dim: DataFrame,
    roles: Mapping[str, Mapping[str, str]],
    value: str,
    sentinel=None,
    on_duplicate: str = "error",
    **limits,
) -> DataFrame:
    """Look up the same dimension once per role: ``{out: {fact key: dim key}}``."""
    value_type = dim.schema[value].dataType
    tables: dict[tuple, tuple[DataFrame, bool]] = {}
    rows = {k: v for k, v in limits.items() if k == "broadcast_rows"}
    for out, on in roles.items():
        keys = tuple(on.values())
        if keys not in tables:
            tables[keys] = code_table(dim, list(keys), value, on_duplicate, **rows)
        codes, small = tables[keys]
        found = joins.join_on(
            fact, codes.select(*keys, F.col(value).alias("__value")), on, "left",
            right_is_small=small, right_is_unique=on_duplicate != "fanout", **limits
        )
        result = F.col("__value")
        if sentinel is not None:
            result = F.coalesce(result, F.lit(sentinel).cast(value_type))
        fact = found.withColumn(out, result).drop("__value")
    return fact


def map_lookup(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, value: str, out: str, sentinel=None
) -> DataFrame:
    """Lookup through a map literal, without a join.

    Only for lists of codes: a table of more than ``MAP_ROWS`` rows is looked up
    with a join instead. Either way a key matches if it has the same value in the
    type of the codes; one that changes in that type (5.7 as a whole number) or
    does not fit it matches nothing.
    """
    codes, _ = code_table(dim, [dim_key], value)
    rows = codes.limit(MAP_ROWS + 1).collect()
    types = codes.schema
    key = exact_cast(F.col(fact_key), fact.schema[fact_key].dataType, types[dim_key].dataType)
    if not rows or len(rows) > MAP_ROWS:
        found = lookup(fact.withColumn("__key", key), dim, {"__key": dim_key}, value, out, sentinel)
        return found.drop("__key")
    entries = [F.lit(part).cast(types[name].dataType)
               for row in rows for part, name in ((row[dim_key], dim_key), (row[value], value))]
    result = F.try_element_at(F.create_map(*entries), key)
    if sentinel is not None:
        result = F.coalesce(result, F.lit(sentinel).cast(types[value].dataType))
    return fact.withColumn(out, result)
