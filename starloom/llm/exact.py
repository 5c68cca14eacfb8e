"""Exact duplicates by sorting whole texts, with DataFrame operators only.

Spark samples the input for splitters and deals the rows over ranges of (text, salt), every range is sorted on disk
if need be, and equal texts come to lie side by side: the window compares each text in full with its neighbour's and numbers the rows of equal ones.
The salt is a hash of the identifier, so the rows of one text, however many, are cut into pieces of a bounded size
that go to different tasks. A piece then counts as one narrow row, and the pieces of a text meet through its digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import stage

# There is a salt for so many rows of the table, so a piece holds about as many rows at most.
ROWS_PER_PIECE = 50_000
LEAST_SALTS = 64
# Splitters are samples of the first characters, so the driver never holds whole texts; the sort compares all of them.
HEAD = 64


def _sorted_pieces(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str], salts: int | None) -> DataFrame:
    """One row per document: identifier, salt, digest, its place among its piece's identifiers (the largest has 1), and
    whether it is the last of the piece; so a piece is known from its first and its last row."""
    if salts is None:
        salts = max(LEAST_SALTS, docs.count() // ROWS_PER_PIECE)
    keyed = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("_salt"),
        F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, HEAD).alias("_head"),
        *([F.struct(*[F.col(c) for c in carry]).alias("_row")] if carry else []),
    )
    neighbours = Window.partitionBy("_head", "_salt", "_text").orderBy(F.col("_id").desc_nulls_last())
    return keyed.repartitionByRange("_head", "_salt").withColumns({
        "_place": F.row_number().over(neighbours), "_last": F.lead(F.lit(True)).over(neighbours).isNull(),
    }).select("_id", "_salt", F.sha2("_text", 256).alias("_sha"), "_place", "_last", *(["_row"] if carry else []))


def _per_piece(pieces: DataFrame) -> DataFrame:
    """For each piece the identifier that stays and the size of the whole group; only ends of pieces are read."""
    ends = pieces.where((F.col("_place") == 1) | F.col("_last"))
    piece = ends.groupBy("_sha", "_salt").agg(F.max("_id").alias("_largest"), F.max("_place").alias("_n"))
    group = Window.partitionBy("_sha")  # at most one row per salt
    return piece.select("_sha", "_salt", F.max("_largest").over(group).alias("keep_id"),
                        F.sum("_n").over(group).alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 salts: int | None = None) -> DataFrame:
    """A row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical, without any change; NULL counts as the empty text. Of equal texts the row with
    the largest identifier stays. Rows that repeat an identifier and its text count as members, and one of them
    stays; a NULL identifier stays only in a group without any other. Other columns are ignored, an empty table
    gives an empty result.
    """
    pieces = stage(_sorted_pieces(docs, id_col, text_col, (), salts), "exact")
    return (
        pieces.join(_per_piece(pieces), ["_sha", "_salt"])
        .select(F.col("_id").alias("doc_id"), "keep_id", "group_size",
                ((F.col("_place") == 1) & F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                F.col("_sha").alias("text_sha256"))
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_groups``."""
    pieces = stage(_sorted_pieces(docs, id_col, text_col, docs.columns, salts), "exact")
    first = pieces.where("_place = 1")
    return (
        first.join(_per_piece(pieces.drop("_row")), ["_sha", "_salt"])
        .where(F.col("_id").eqNullSafe(F.col("keep_id")))
        .select("_row.*")
    )
