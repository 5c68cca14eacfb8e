"""Repeated lines by levelled sorted runs of line hashes.

A line's key is 128 bits of hash. What is stored for a key are the largest identifiers of documents that hold it, as
many as make a line a repeated one; so two states merge to the same state in any order, and a batch that is added
twice changes nothing. A batch is aggregated by key, merge-anti-joined with the sorted runs (what cannot change the
stored state is dropped), and the rest becomes a run of the lowest level. ``FANOUT`` runs of a level are compacted into
one run of the next. Runs are bucketed and sorted by key, so a batch meets them without another shuffle of theirs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path, stage

LEAST_LENGTH = 20
LEAST_DOCS = 3
FANOUT = 3
BATCHES = 6

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["_h1", "_h2"]
_NO_ID = -(1 << 63)


def _identifier(id_col: str) -> Column:
    """The identifier; NULL is the smallest of all."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_id")


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              least_length: int = LEAST_LENGTH) -> DataFrame:
    """A row for each line whose key is long enough: ``_id, _t`` (hash of the text), ``_pos, _h1, _h2``.

    The key is the line without ASCII white space at its ends, A-Z in lower case.
    """
    lines = docs.select(
        _identifier(id_col), F.xxhash64(_text(text_col)).alias("_t"),
        F.posexplode(F.split(_text(text_col), "\n")).alias("_pos", "_line"))
    keyed = lines.withColumn("_line", F.translate(F.btrim("_line", F.lit(_SPACE)), _UPPER, _LOWER))
    return keyed.where(F.length("_line") >= least_length).select(
        "_id", "_t", "_pos", F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(1), "_line").alias("_h2"))


def _states(rows: DataFrame, least_docs: int) -> DataFrame:
    """For each key the ``least_docs`` largest identifiers (``_docs``, descending) among rows of one identifier.

    Spark drops all but those before the shuffle, so a line of very many documents sends a few rows per task.
    """
    order = Window.partitionBy(*_KEY).orderBy(F.col("_id").desc())
    top = rows.select(*_KEY, "_id").withColumn("_rank", F.dense_rank().over(order)).where(F.col("_rank") <= least_docs)
    return top.groupBy(*_KEY).agg(F.sort_array(F.collect_set("_id"), asc=False).alias("_docs"))


class LineRuns:
    """The runs below a folder. Opened again, it goes on with the runs whose write had ended.

    A compaction that broke off leaves both its result and what it was made of; together they say the same.
    """

    def __init__(self, spark: SparkSession, root: str, least_docs: int = LEAST_DOCS, fanout: int = FANOUT,
                 buckets: int | None = None):
        self.spark, self.root, self.least_docs, self.fanout = spark, root.rstrip("/"), least_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, dict[str, str]] = {}  # of each level, tables by folder
        for level, folder, buckets_there in self._found():
            name = f"line_run_{uuid.uuid4().hex}"
            spark.sql(f"CREATE TABLE {name} (_h1 BIGINT, _h2 BIGINT, _docs ARRAY<BIGINT>) USING parquet CLUSTERED BY "
                      f"(_h1, _h2) SORTED BY (_h1, _h2) INTO {buckets_there} BUCKETS LOCATION '{folder}'")
            self.levels.setdefault(level, {})[folder] = name

    def _path(self, path: str):
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _found(self) -> Iterator[tuple[int, str, int]]:
        pattern, files = self._path(f"{self.root}/level-*/run-*/_SUCCESS")
        for status in files.globStatus(pattern) or ():
            folder = status.getPath().getParent()
            yield int(folder.getParent().getName()[6:]), folder.toString(), int(folder.getName().rpartition("-")[2])

    def runs(self) -> list[DataFrame]:
        """All runs, each with one row per key."""
        return [self.spark.table(name) for level in sorted(self.levels) for name in self.levels[level].values()]

    def _write(self, states: DataFrame, level: int) -> None:
        unique = uuid.uuid4().hex
        folder, name = f"{self.root}/level-{level}/run-{unique}-{self.buckets}", f"line_run_{unique}"
        states.repartition(self.buckets, *_KEY).write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option(
            "path", folder).saveAsTable(name)
        self.levels.setdefault(level, {})[folder] = name

    def add(self, keys: DataFrame) -> None:
        """Take up a batch of ``line_keys``."""
        new = _states(keys, self.least_docs)
        for run in self.runs():
            # A key is settled if the batch has no identifier that belongs among the largest and isn't there.
            least = F.when(F.size("_docs") == self.least_docs, F.element_at("_docs", -1)).otherwise(_NO_ID)
            old = run.select(*[F.col(k).alias(f"_run{k}") for k in _KEY], F.col("_docs").alias("_old"), least.alias("_least"))
            same = reduce(Column.__and__, [F.col(k) == F.col(f"_run{k}") for k in _KEY])
            larger = F.filter("_docs", lambda i: i >= F.col("_least"))
            new = new.join(old, same & (F.size(F.array_except(larger, "_old")) == 0), "left_anti")
        self._write(new, 0)
        level = 0
        while len(self.levels.get(level, ())) >= self.fanout:
            self._compact(level)
            level += 1

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, runs).select(*_KEY, F.explode("_docs").alias("_id"))
        return _states(rows, self.least_docs)

    def _compact(self, level: int) -> None:
        old = self.levels[level]
        self._write(self._merged([self.spark.table(name) for name in old.values()]), level + 1)
        self.levels[level] = {}
        for folder, name in old.items():
            self.spark.sql(f"DROP TABLE {name}")
            path, files = self._path(folder)
            files.delete(path, True)

    def close(self) -> None:
        """Forget the tables; the runs stay in the folder."""
        for tables in self.levels.values():
            for name in tables.values():
                self.spark.sql(f"DROP TABLE {name}")
        self.levels = {}

    def repeated(self) -> DataFrame:
        """The keys that at least ``least_docs`` documents hold, and the largest identifier among these."""
        return self._merged(self.runs()).where(F.size("_docs") >= self.least_docs).select(
            *_KEY, F.element_at("_docs", 1).alias("_largest"))


def drop_lines(docs: DataFrame, keys: DataFrame, repeated: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated lines: all columns of ``docs`` but the text, then ``n_lines, n_dropped, kept_text``."""
    dropped = stage(
        keys.join(repeated, _KEY).where(F.col("_id") != F.col("_largest"))
        .groupBy("_id", "_t").agg(F.collect_set("_pos").alias("_dropped")), "dropped-lines")
    mine = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), _identifier(id_col),
                       F.xxhash64(_text(text_col)).alias("_t"), F.split(_text(text_col), "\n").alias("_lines"))
    lost = F.coalesce("_dropped", F.array().cast("array<int>"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), lost)
    kept = F.when(F.size(lost) == 0, F.col(f"_row.`{text_col}`")).otherwise(
        F.array_join(F.transform(places, lambda i: F.get("_lines", i)), "\n"))
    return mine.join(dropped, ["_id", "_t"], "left").select(
        *[F.col(f"_row.`{c}`") for c in docs.columns if c != text_col],
        F.size("_lines").cast("long").alias("n_lines"), F.size(lost).cast("long").alias("n_dropped"),
        F.coalesce(kept, F.lit("")).alias("kept_text"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                least_docs: int = LEAST_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """A row per document: ``doc_id, n_lines, n_dropped, kept_text``.

    A key of at least ``least_length`` code points that at least ``least_docs`` documents hold loses all its lines,
    but for those in the document with the largest identifier. The documents go into the runs in ``batches`` parts
    by a hash of the identifier. NULL and empty texts are one empty line. Rows of one identifier are one document: a
    line in several of them counts once and stays in all of them if they have the largest. A NULL identifier
    is smaller than any other, and all rows without one are one document. Other columns are ignored; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    path = scratch_path(spark, "line-keys")
    part = F.pmod(F.xxhash64("_id"), F.lit(batches)).cast("int")
    found = line_keys(named, least_length=least_length).withColumn("_batch", part)
    found.write.partitionBy("_batch").parquet(path)
    keys = spark.read.schema(found.schema).parquet(path)
    runs = LineRuns(spark, scratch_path(spark, "line-runs"), least_docs, fanout)
    for batch in range(batches):
        runs.add(keys.where(F.col("_batch") == batch))
    repeated = stage(runs.repeated(), "repeated-lines")
    runs.close()
    return drop_lines(named, keys.drop("_batch"), repeated)
