"""Which keys of a period occur in others: digests and Bloom filters kept per period.

A filter is a table, so it is built, stored and probed like any other: its blocks are rows of four 64-bit words, and a
key sets one bit in each word of one block. The number of blocks is a power of two for 16 keys a block, so a filter
takes 2.5 to 5 bytes a key and lets one strange key in 400 pass at most. What passes is compared with the digests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 4
KEYS_PER_BLOCK = 16


def _bits() -> list[Column]:
    """The bit of a digest in each word; these are its upper bits, the block is found by the lower ones."""
    return [F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(digest, {40 + 6 * i}) & 63 AS INT))") for i in range(WORDS)]


def _block() -> Column:
    return F.col("digest").bitwiseAND(F.col("blocks") - 1)


def key_digests(df: DataFrame, fields: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``field, digest`` of the different values of each field, by ``keys``; a NULL is no key."""
    pairs = F.array(*(F.struct(
        F.lit(f).alias("field"), F.when(F.col(f).isNotNull(), F.xxhash64(f)).alias("digest")) for f in fields))
    return df.select(F.inline(pairs), *keys).where("digest IS NOT NULL").distinct()


def key_filters(digests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The filters of :func:`key_digests`: ``field, blocks, block, w0 .. w3`` by ``keys``; blocks without a key are left out."""
    group = ["field", *keys]
    full = F.greatest(F.count(F.lit(1)) / KEYS_PER_BLOCK, F.lit(1.0))
    sizes = digests.groupBy(*group).agg(F.pow(F.lit(2.0), F.ceil(F.log2(full))).cast("long").alias("blocks"))
    sizes = sizes.withColumnsRenamed({c: f"__{c}" for c in group})
    sized = digests.join(sizes, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group])
    words = [bit.alias(f"w{i}") for i, bit in enumerate(_bits())]
    return sized.select(*group, "blocks", _block().alias("block"), *words).groupBy(*group, "blocks", "block").agg(
        *(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))


def probed(digests: DataFrame, filters: DataFrame) -> DataFrame:
    """``digests`` with the columns of the filters that may hold them, a row for each such filter.

    Filters have at most 41 different sizes; a digest is sent to one block of each size.
    """
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]
    sent = digests.withColumn("blocks", F.explode(F.array(*map(F.lit, sizes)).cast("array<bigint>")))
    sent = sent.withColumns({"block": _block(), **{f"bit{i}": bit for i, bit in enumerate(_bits())}})
    held = [F.col(f"w{i}").bitwiseAND(F.col(f"bit{i}")) != 0 for i in range(WORDS)]
    met = sent.join(filters, ["field", "blocks", "block"])
    for condition in held:
        met = met.where(condition)
    return met.drop("blocks", "block", *[f"{c}{i}" for c in ("w", "bit") for i in range(WORDS)])
