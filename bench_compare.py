"""Time this package's way of doing a thing next to the plain way; prints a Markdown table.

Same environment as ``bench.py``. The plain ways are written here, for the
comparison only: Python functions per row, a job per check, a second scan.
"""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bench import timed
from starloom import schema, sinks
from starloom.functions import clean, dates
from starloom.operators import names, profile
from starloom.plans import fact
from starloom.session import build_session, scratch_path
from starloom.sources.tables import conform
from starqueries import model
from starqueries.standins import view


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action, runs: int = 3) -> float:
    action()
    return min(timed(action) for _ in range(runs))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("compare", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    typed = conform(view(spark, folder, "x_extract"), schema.EXTRACT)
    codes = model.staged(spark, folder)
    lines = []

    # Dates and cleaning: native expressions, or one Python call per value.
    day = F.udf(lambda n: dt.date(1960, 1, 1) + dt.timedelta(days=n) if n is not None else None, T.DateType())
    gender = F.udf(lambda g: g if g in ("M", "F") else "U", T.StringType())
    age = F.udf(lambda a: a if a is not None and a >= 0 else None, T.IntegerType())
    native = typed.select(
        dates.epoch_day_to_date(F.col("arrdate")), dates.epoch_day_to_date(F.col("depdate")),
        clean.keep_in(F.col("gender"), schema.KNOWN_GENDERS, "U"), clean.keep_range(F.col("i94bir"), low=0))
    python = typed.select(day("arrdate"), day("depdate"), gender("gender"), age("i94bir"))
    lines.append(("dates and cleaning: native, Python per row", best(lambda: drain(native)), best(lambda: drain(python))))

    # NULL counts: one aggregate, or a job per column.
    def per_column():
        for name in schema.EXTRACT.names:
            typed.where(F.col(name).isNull()).count()

    lines.append(("NULL counts of 28 columns: one pass, a job each",
                  best(lambda: profile.null_counts(typed).collect()), best(per_column, 1)))

    # Dates of a load: from the fact just written, or from the extract again.
    rows = fact.build_fact(typed, codes.countries_mapping, codes.visa_categories, codes.us_states)
    path = scratch_path(spark, "fact")
    sinks.load_period(rows, path)
    written = spark.read.schema(schema.FACT).parquet(path)
    lines.append(("dates of a load: written fact, second scan of the extract",
                  best(lambda: drain(fact.date_dimension(written, "arrival_date"))),
                  best(lambda: drain(fact.date_dimension(rows, "arrival_date")))))

    # Partitioned write: gathered by period, or as the tasks come.
    spread = rows.repartition(int(cpus))
    files = {}

    def write(rebalance):
        target = scratch_path(spark, "write")
        sinks.load_period(spread, target, rebalance=rebalance)
        files[rebalance] = sum(1 for _ in Path(target).rglob("*.parquet"))

    lines.append(("partitioned write: rebalanced, as is", best(lambda: write(True), 1), best(lambda: write(False), 1)))

    # Names: pieces as blocking keys, or every pair.
    known = model.nation_names(spark, folder)
    wanted = view(spark, folder, "x_names")

    def all_pairs():
        pairs = wanted.select("name").distinct().crossJoin(F.broadcast(known))
        hits = pairs.where(F.contains(F.lower("country_name"), F.lower(F.trim("name"))))
        drain(hits.groupBy("name").agg(F.min("country_id")))

    lines.append(("names: blocked, all pairs (25 names known)",
                  best(lambda: drain(names.match_names(wanted, "name", known, "country_name", "country_id", "c")), 1),
                  best(all_pairs, 1)))

    print("| Comparison | this package, s | plain, s |\n| --- | --- | --- |")
    for label, ours, plain in lines:
        print(f"| {label} | {ours:.2f} | {plain:.2f} |")
    print(f"\nFiles of the partitioned write: {files[True]} rebalanced, {files[False]} as is.")
    spark.stop()


if __name__ == "__main__":
    main()
