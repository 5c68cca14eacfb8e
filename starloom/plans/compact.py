"""Stored periods of many small files, rewritten as few large ones and swapped through the manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom import schema
from starloom.operators import joins
from starloom.session import stage
from starloom.versions import Manifest, Versions

TARGET_BYTES = 256 << 20
WORTH = 2  # a period is rewritten if it then has so many times fewer files
_PLACE = len(schema.PERIOD) + 1


def _place(path: Column) -> Column:
    """Period folders and file name: the end of a path, however it is written."""
    return F.substring_index(path, "/", -_PLACE)


def stored_files(versions: Versions, table: str, manifest: Manifest | None = None) -> DataFrame:
    """``part, place, bytes`` of the files of a table's current parts, from their listing; contents are not read."""
    parts = (manifest or versions.current()).of(table)
    if not parts:
        return versions.spark.createDataFrame([], "part string, place string, bytes long")
    folders = [f"{versions.root}/v={v}/t={table}/{part}" for part, v in parts.items()]
    files = versions.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders)
    place = _place(F.col("path"))
    return files.select(F.substring_index(place, "/", len(schema.PERIOD)).alias("part"), place.alias("place"),
                        F.col("length").alias("bytes"))


def packed(files: DataFrame, target_bytes: int = TARGET_BYTES, worth: int = WORTH) -> DataFrame:
    """``part, place, bin``: the files of parts that are worth it, in bins of about ``target_bytes``.

    Files are laid end to end, the largest first, and the line is cut every ``target_bytes``; a file belongs to the bin
    its middle lies in. So a bin is at most half a file larger at either end, and no file is split.
    """
    line = Window.partitionBy("part").orderBy(F.col("bytes").desc(), "place").rowsBetween(Window.unboundedPreceding, 0)
    cut = files.withColumn("bin", F.floor((F.sum("bytes").over(line) - F.col("bytes") / 2) / F.lit(target_bytes)).cast("int"))
    sizes = cut.groupBy("part").agg(F.count(F.lit(1)).alias("files"), F.countDistinct("bin").alias("bins"))
    few = sizes.where(F.col("files") >= F.col("bins") * F.lit(worth)).select("part")
    return cut.join(few, "part").select("part", "place", "bin")


def compact(versions: Versions, tables: Sequence[str] = ("i94",), target_bytes: int = TARGET_BYTES,
            worth: int = WORTH) -> dict[str, list[str]]:
    """Rewrite the periods of many small files; returns the parts that were rewritten, by table.

    Rows stay the same, readers of an older version keep their files until ``vacuum``, and a load that replaced such a
    period meanwhile makes this change fail instead of undoing the load.
    """
    change = versions.begin()
    done: dict[str, list[str]] = {}
    for table in tables:
        bins = stage(packed(stored_files(versions, table, change.base), target_bytes, worth), "bins")
        parts = sorted(r["part"] for r in bins.select("part").distinct().collect())  # periods
        if not parts:
            continue
        rows = versions.read(table, change.base, parts, more=[_place(F.col("_metadata.file_path")).alias("__place")])
        numbered = joins.join_on(rows, bins.select("place", "part", "bin"), {"__place": "place"}, "inner", right_is_unique=True)
        # A bin of a period is one range, so one task and one file.
        tasks = bins.select("part", "bin").distinct().count()
        dealt = numbered.repartitionByRange(tasks, "part", "bin").sortWithinPartitions("part", "bin")
        done[table] = change.write_periods(dealt, table, rebalance=False)
    if done:
        change.publish()
    return done
