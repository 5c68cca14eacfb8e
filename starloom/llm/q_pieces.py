"""Query of piece encoding and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.pieces import DIGESTS, encode_pieces, ids_crc32
from starloom.llm.registry import query, table


@query("op6_piece_scan")
def op6_piece_scan(spark: SparkSession, folder: str) -> DataFrame:
    return encode_pieces(table(spark, folder, "documents"), then=ids_crc32, fields=DIGESTS)
