"""Jobs for a scheduler: ``python -m starloom load ...`` and ``python -m starloom check ...``.

Both take the period as ``--year`` and ``--month``; without them it is the
month before today. A failed check ends ``check`` (and ``load``) with an error.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import previous_period
from starloom.plans.load import LoadOptions, Staged, check_quality, run_period
from starloom.plans.publish import publish_period
from starloom.session import build_session, clear_scratch
from starloom.sources.files import list_files, period_files


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load", help="load one month, check it, register it")
    load.add_argument("--raw", required=True, help="folder of raw extracts, named like i94_apr16_sub.parquet")
    load.add_argument("--format", default="parquet", help="format of the extracts: parquet, csv, orc, json")
    load.add_argument("--staging", required=True, help="folder of the staged code tables")
    load.add_argument("--append", action="store_true", help="add to the month instead of replacing it")
    load.add_argument("--publish", action="store_true", help="write a version that is seen after its checks have passed")
    load.add_argument("--csv", action="store_true", help="also write delimited copies of the model")
    check = jobs.add_parser("check", help="check one month of a model")
    for job in (load, check):
        job.add_argument("--model", required=True, help="folder of the model")
        job.add_argument("--year", type=int)
        job.add_argument("--month", type=int)
    return parser.parse_args(argv)


def last_month(spark: SparkSession) -> tuple[int, int]:
    period = previous_period(F.current_date())
    return tuple(spark.range(1).select(period["year"], period["month"]).first())


def main(argv: Sequence[str] | None = None) -> None:
    options = arguments(argv)
    spark = build_session(f"starloom {options.job}")
    year, month = (options.year, options.month) if options.year and options.month else last_month(spark)
    try:
        run(spark, options, year, month)
    finally:
        clear_scratch(spark)


def run(spark: SparkSession, options: argparse.Namespace, year: int, month: int) -> None:
    if options.job == "check":
        check_quality(spark, options.model, year, month)
        return
    found = [r["path"] for r in period_files(list_files(spark, options.raw, options.format), year, month).collect()]
    if not found:
        raise FileNotFoundError(f"no extract of {year}-{month:02d} in {options.raw}")
    reader = spark.read.format(options.format)
    if options.format == "csv":
        reader = reader.options(sep=";", header=True)
    job = publish_period if options.publish else run_period
    job(
        spark, reader.load(found), Staged.read(spark, options.staging), options.model, year, month,
        LoadOptions(mode="append" if options.append else "replace", csv_copies=options.csv),
    )


if __name__ == "__main__":
    main()
