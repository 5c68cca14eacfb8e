"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a load or a query of this package relies on. Partition counts and
# memory belong to the cluster and are left alone; AQE sizes shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Files of a load are about this large; below parallelism it is no bound.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    # Pages can be large: keep Arrow batches small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


BATCH_BYTES = 8 << 20

_WRITTEN: list[str] = []


def build_session(app: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with this package's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Bound an Arrow batch of this session by bytes, so that long texts make short batches.

    It is a setting of the session and stays, since frames are computed later; a smaller bound that is set is kept.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
    if not found or int(found[1]) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster, executors on other machines could not see it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="starloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove the scratch tables this process has written; call it when nothing reads them any more."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(hadoop).delete(path, True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a scratch table and read it back.

    The result no longer depends on the lineage of ``df``: rows and generated
    ordinals stay the same when executors are lost, and file sizes give the
    optimizer real statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
