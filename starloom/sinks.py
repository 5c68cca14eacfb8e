"""Writers: full refresh, period load, delimited export, catalog registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starloom import schema
from starloom.operators import joins


def write_full(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Replace a parquet table. ``one_file`` gathers a small table into one file, and a large one into even files."""
    (df.hint("rebalance") if one_file else df).write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Replace a ``;`` separated export with a header; ``one_file`` as in :func:`write_full`."""
    (df.hint("rebalance") if one_file else df).write.mode("overwrite").csv(path, sep=";", header=True)


def load_period(
    df: DataFrame,
    path: str,
    periods: Sequence[str] = schema.PERIOD,
    mode: str = "replace",
    rebalance: bool = True,
) -> None:
    """Write rows into the partitions of their periods.

    ``replace`` overwrites just the periods that occur in ``df``, so a rerun
    changes nothing; ``append`` adds to them. With ``rebalance`` rows are
    gathered by period into files of even size, and a period that is too large
    for one task is split by AQE. Turn it off for an extract of one period,
    where each task holds one period anyway and the shuffle would gain nothing.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode: {mode!r}")
    if rebalance:
        df = df.hint("rebalance", *periods)
    writer = df.write.partitionBy(*periods)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def is_missing(error: AnalysisException) -> bool:
    """Whether the error says that there is no such table, or no file in it; any other one must not pass for that."""
    return (error.getCondition() or "").split(".")[0] in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def append_missing(df: DataFrame, path: str, key: str, periods: Sequence[str] = schema.PERIOD) -> None:
    """Append the rows whose ``key`` is not stored yet; running it again adds nothing."""
    spark = df.sparkSession
    try:
        stored = spark.read.schema(df.schema).parquet(path).select(key)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        new = df
    else:
        new = joins.unmatched(df, stored, {key: key})
    new.hint("rebalance", *periods).write.mode("append").partitionBy(*periods).parquet(path)


def _period_folders(spark: SparkSession, path: str) -> set[str]:
    """Names of the period folders of a partitioned table, such as ``year=2016/month=4``."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/" + "/".join(f"{p}=*" for p in schema.PERIOD))
    files = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {"/".join(str(s.getPath()).split("/")[-len(schema.PERIOD):]) for s in files.globStatus(found) or ()}


def partition_spec(part: str) -> str:
    """A period folder as the catalogue names it."""
    pairs = (p.split("=", 1) for p in part.split("/"))
    return "PARTITION (" + ", ".join(f"{k} = {'NULL' if v == '__HIVE_DEFAULT_PARTITION__' else v}" for k, v in pairs) + ")"


def create_table(name: str, kind: StructType, location: str, partitioned: bool, properties: str = "") -> str:
    """Statement for an external table over stored files."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
    layout = f"PARTITIONED BY ({', '.join(schema.PERIOD)})" if partitioned else ""
    return f"CREATE TABLE {name} ({columns}) USING parquet {layout} LOCATION '{location}' {properties}"


def described(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalogue says of a table beside its columns: location, properties and so on."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    at = next(i for i, (key, _) in enumerate(rows) if key == "# Detailed Table Information")
    return dict(rows[at + 1:])


def qualified(spark: SparkSession, path: str) -> str:
    """A path in the form the catalogue keeps."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return str(found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(found))


def catalog_difference(spark: SparkSession, name: str, kind: StructType, path: str, partitioned: bool) -> list[str]:
    """Statements that bring a catalogued table in line with the files of ``path``; none if nothing changed.

    A table of another place, or whose columns changed their type or went, is made anew (its files are external and
    stay). New columns and partitions are added, partitions without a folder dropped, one by one: the partitions
    that stay are not listed again.
    """
    folders = _period_folders(spark, path) if partitioned else set()
    statements, there = [], set()
    if spark.catalog.tableExists(name):
        old = spark.table(name).schema
        known, wanted = {f.name: f.dataType for f in old}, {f.name: f.dataType for f in kind}
        same_place = described(spark, name).get("Location") == qualified(spark, path)
        if same_place and all(wanted.get(c) == t for c, t in known.items()):
            new = [f for f in kind if f.name not in known]
            if new:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
                statements.append(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            if partitioned:
                there = {r["partition"].replace("=null", "=__HIVE_DEFAULT_PARTITION__")
                         for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        else:
            statements += [f"DROP TABLE {name}", create_table(name, kind, path, partitioned)]
    else:
        statements.append(create_table(name, kind, path, partitioned))
    added = [f"{partition_spec(p)} LOCATION '{path}/{p}'" for p in sorted(folders - there)]
    statements += [f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[i:i + 100])}" for i in range(0, len(added), 100)]
    statements += [f"ALTER TABLE {name} DROP IF EXISTS {partition_spec(p)}" for p in sorted(there - folders)]
    return statements


def register_model(
    spark: SparkSession,
    root: str,
    database: str | None = None,
    suffix: str = "",
    tables: Sequence[str] = tuple(schema.MODEL_TABLES),
) -> list[str]:
    """Make model tables known to SQL and return their names; tables that do not exist are left out.

    Without ``database`` they become temporary views. With it they become
    external tables, changed only where files and catalogue differ.
    """
    names = []
    for table in tables:
        path = f"{root}/{table}.parquet"
        try:
            df = read_model_table(spark, root, table)
        except AnalysisException as error:
            if not is_missing(error):
                raise
            continue
        name = f"{table}{suffix}"
        if database is None:
            df.createOrReplaceTempView(f"`{name}`")
        else:
            name = f"{database}.{name}"
            for statement in catalog_difference(spark, name, df.schema, path, table in schema.PERIOD_TABLES):
                spark.sql(statement)
            spark.catalog.refreshTable(name)
        names.append(name)
    return names


def read_model_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One table of the model with its declared schema; period columns come from the folder names."""
    return spark.read.schema(schema.MODEL_TABLES[table]).parquet(f"{root}/{table}.parquet")
