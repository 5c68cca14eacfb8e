"""Load periods as their files arrive in a landing folder.

The file source keeps in its checkpoint which files it has seen. A batch tells
which periods got new files, and notes which file holds which period; each of
those periods is then rebuilt from all of its files and replaced. A period may
so arrive in several files and in any order, files of other periods are not
read again, and a batch that is repeated after a failure changes nothing.

Notes lie in ``period=<year>_<month>/batch=<number>``, so a batch reads those of the periods it touches and of no
others. Where a period has notes of many batches, they are merged into one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from starloom.plans.load import LoadOptions, Staged, load_fact

_PERIOD = ["i94yr", "i94mon"]
_NONE = "none"
MERGE_AT = 32  # a period with notes of so many batches has them merged


def _same(left: DataFrame, right: DataFrame, prefix: str = "") -> Column:
    """Rows of one period; one without a year or month is a period as well, so no row is lost."""
    year, month = (left[f"{prefix}{c}"].eqNullSafe(right[f"{prefix}{c}"]) for c in _PERIOD)
    return year & month


class Notes:
    """Which file holds rows of which period."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _batches(self, period: str, batch: str = "*") -> list[str]:
        found = self._files.globStatus(self._path(f"{self.root}/period={period}/batch={batch}")) or ()
        return [str(s.getPath()) for s in found]

    def add(self, arrived: DataFrame, batch: int) -> list[str]:
        """Note ``file, i94yr, i94mon`` and return the periods. The rows stay on the executors; adding a batch again replaces it."""
        for old in self._batches("*", str(batch)):
            self._files.delete(self._path(old), True)
        named = F.concat_ws("_", *(F.coalesce(F.col(c).cast("string"), F.lit(_NONE)) for c in _PERIOD))
        noted = arrived.select("file", named.alias("period"), F.lit(batch).alias("batch")).distinct()
        noted.write.mode("append").partitionBy("period", "batch").parquet(self.root)
        return sorted(p.split("/")[-2].removeprefix("period=") for p in self._batches("*", str(batch)))

    def adopt(self) -> None:
        """Take in notes that lie in the folder itself, as they did before there were periods; they come as batch -1."""
        loose = [str(s.getPath()) for s in self._files.globStatus(self._path(f"{self.root}/*.parquet")) or ()]
        if loose:
            self.add(self.spark.read.schema("file STRING, i94yr INT, i94mon INT").parquet(*loose), -1)
            for path in loose:
                self._files.delete(self._path(path), False)

    def read(self, periods: list[str]) -> DataFrame:
        """``file`` of these periods; the folders of others are not listed."""
        folders = [f"{self.root}/period={p}" for p in periods]
        found = self.spark.read.schema("file STRING, period STRING, batch STRING").option("basePath", self.root)
        return found.parquet(*folders).select("file").distinct()

    def merge(self, period: str, batch: int) -> None:
        """One folder for the notes of all batches up to this one, the newest; what is read twice after a failure is the same file."""
        old = self._batches(period)
        if len(old) < MERGE_AT:
            return
        merged = f"{self.root}/period={period}/batch={batch}_merged"
        self.read([period]).coalesce(1).write.mode("overwrite").parquet(merged)
        for folder in old:
            if not folder.endswith(f"/batch={batch}_merged"):
                self._files.delete(self._path(folder), True)


def _as_rows(spark: SparkSession, periods: list[str]) -> DataFrame:
    """The periods as ``i94yr, i94mon``: a row for each one a batch touches."""
    values = [tuple(None if v == _NONE else int(v) for v in p.split("_")) for p in periods]
    return spark.createDataFrame(values, "i94yr INT, i94mon INT")


def load_arrivals(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    staged: Callable[[], Staged],
    root: str,
    checkpoint: str,
    options: LoadOptions = LoadOptions(),
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a query that loads every period with files not seen yet, then stops.

    ``schema`` is that of the files as they arrive; ``staged`` gives the code
    tables and is asked once per batch. Notes on files are kept beside the
    checkpoint, in ``<checkpoint>-files``; see :class:`Notes`. Each period is written
    anew as a whole, so ``options`` must not say ``append``. The names of the files
    of the touched periods go through the driver, which is how Spark is told what
    to read; ``files_per_batch`` bounds how many periods a batch can touch.
    """
    if options.mode != "replace":
        raise ValueError("arrivals replace the periods they touch")
    place = f"{checkpoint.rstrip('/')}-files"
    Notes(spark, place).adopt()

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        notes = Notes(session, place)
        periods = [F.col(c).try_cast("double").try_cast("int").alias(c) for c in _PERIOD]
        names = notes.add(batch.select("file", *periods), number)
        if not names:
            return
        files = [r["file"] for r in notes.read(names).collect()]
        rows = session.read.schema(schema).format(fmt).load(files)
        whole = rows.withColumns({f"__{c}": p for c, p in zip(_PERIOD, periods, strict=True)})
        wanted = F.broadcast(_as_rows(session, names).withColumnsRenamed({c: f"__{c}" for c in _PERIOD}))
        same = _same(whole, wanted, "__")
        load_fact(whole.join(wanted, same, "left_semi").drop(*[f"__{c}" for c in _PERIOD]), staged(), root, options)
        for name in names:
            notes.merge(name, number)

    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(landing)
        .withColumn("file", F.col("_metadata.file_path"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
