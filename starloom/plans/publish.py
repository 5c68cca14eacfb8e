"""The monthly load as one change: written beside the model, checked, and only then seen by readers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schema, sinks
from starloom.operators import profile, quality
from starloom.operators.key_filters import key_digests, key_filters, probed
from starloom.plans import dimensions, fact
from starloom.plans.analytics import Model
from starloom.plans.load import LoadOptions, OtherPeriods, Staged
from starloom.session import stage
from starloom.sources.tables import conform
from starloom.versions import WHOLE, Change, Manifest, Versions, period_part


def change_dimensions(change: Change, staged: Staged) -> None:
    """Replace all dimension tables but the dates."""
    spark = change.versions.spark
    for name in ("visa_categories", "us_states", "countries", "temperature"):
        change.write_full(getattr(staged, name), name)
    change.write_full(dimensions.mode_dimension(spark), "mode")
    change.write_full(dimensions.purpose_dimension(spark), "purpose")


def _periods_of_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("date"), "month": F.month("date")})


def change_dates(change: Change, periods: Sequence[str]) -> None:
    """Bring the dates up to date with the fact's changed periods; a date goes with its last row.

    Rows are counted per date and period of the fact. The new counts less the old ones are signed changes of the
    totals per date. Only months with a date whose total changes are read and written.
    """
    counted = change.read("i94", periods).where(F.col("arrival_date").isNotNull()).groupBy(
        F.col("arrival_date").alias("date"), *schema.PERIOD).agg(F.count(F.lit(1)).alias("rows"))
    change.write_periods(counted, "date_counts", periods)
    new, old = change.read("date_counts", periods), change.before("date_counts", periods)
    signed = new.select("date", "rows").unionByName(old.select("date", (-F.col("rows")).alias("rows")))
    # A row per date, so it is as small as a calendar.
    delta = _periods_of_dates(signed.groupBy("date").agg(F.sum("rows").alias("rows")).where("rows <> 0"))
    touched = [period_part(*r) for r in delta.select(*schema.PERIOD).distinct().collect()]
    if not touched:
        return
    before = change.before("date_totals", touched)
    after = before.unionByName(delta).groupBy("date").agg(F.sum("rows").alias("rows")).where("rows > 0")
    change.write_periods(_periods_of_dates(after), "date_totals", touched)
    change.write_periods(fact.date_dimension(change.read("date_totals", touched), "date"), "dates", touched)


def change_sums(change: Change, periods: Sequence[str]) -> None:
    """Sum the changed periods of the fact anew, by the keys of each table of sums."""
    rows = change.read("i94", periods)
    for name, keys in schema.SUMS.items():
        sums = rows.groupBy(*keys, *schema.PERIOD).agg(F.sum("count").alias("count"))
        change.write_periods(sums, name, periods)


def change_profiles(change: Change, periods: Sequence[str]) -> None:
    """Profile the changed periods of the fact; those of other periods stay as they are."""
    columns = [c for c in schema.FACT.names if c not in schema.PERIOD]
    found = profile.mergeable_profile(change.read("i94", periods), columns, schema.PERIOD)
    change.write_periods(found, "profiles", periods)


def change_keys(change: Change, periods: Sequence[str]) -> None:
    """Keep the keys of the changed periods, and of those others that have none kept yet."""
    kept = change.candidate().of("key_filters")
    wanted = [*periods, *(p for p in change.candidate().of("i94") if p not in kept and p not in periods)]
    found = key_digests(change.read("i94", wanted), schema.KEYS, schema.PERIOD)
    change.write_periods(found, "key_digests", wanted)
    change.write_periods(key_filters(change.read("key_digests", wanted), schema.PERIOD), "key_filters", wanted)


def repeated_keys(change: Change, periods: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """``field, value, year, month, other_year, other_month``: keys of these periods that other periods hold as well.

    The filters of all other periods are probed; digests are read for the periods that may hold a key, and one column
    of the fact for those whose digests do, so the result is exact. ``change_keys`` has to come first. NULLs are no keys.
    """
    unknown = sorted(set(fields) - set(schema.KEYS))
    if unknown:
        raise ValueError(f"no keys are kept of {', '.join(unknown)}")
    others = {c: f"other_{c}" for c in schema.PERIOD}
    rest = [p for p in change.candidate().of("key_filters") if p not in periods]
    new = change.read("key_digests", periods).where(F.col("field").isin(*fields))
    near = stage(probed(new, change.read("key_filters", rest).withColumnsRenamed(others)), "near-keys")
    at = [period_part(*r) for r in near.select(*others.values()).distinct().collect()]
    old = change.read("key_digests", at).withColumnsRenamed(others)
    same = [near[c].eqNullSafe(old[c]) for c in ("field", "digest", *others.values())]
    met = stage(near.join(old, same, "left_semi"), "met-keys")
    at = [period_part(*r) for r in met.select(*others.values()).distinct().collect()]
    here, there = change.read("i94", periods), change.read("i94", at)
    found = None
    for field in fields:
        digest = F.xxhash64(field).alias("digest")
        left = here.where(F.col(field).isNotNull()).select(F.col(field).alias("value"), digest, *schema.PERIOD).distinct()
        right = there.where(F.col(field).isNotNull()).select(
            F.col(field).alias("value"), digest, *[F.col(c).alias(n) for c, n in others.items()])
        hit = met.where(F.col("field") == field).drop("field")
        right = right.join(hit.select("digest").distinct(), "digest", "left_semi").distinct()
        both = left.join(hit.select("digest").distinct(), "digest", "left_semi").join(right, ["digest", "value"])
        part = both.select(F.lit(field).alias("field"), F.col("value").cast("string").alias("value"),
                           *schema.PERIOD, *others.values())
        found = part if found is None else found.unionByName(part)
    return found


def change_fact(
    change: Change, extract: DataFrame, staged: Staged, options: LoadOptions = LoadOptions(),
    period: tuple[int, int] | None = None,
) -> list[str]:
    """Replace the periods of an extract, which is read once; returns the changed periods.

    ``period`` states that all rows are of one year and month: that month is replaced even if the extract is empty,
    and a row of another month is an error.
    """
    rows = fact.build_fact(
        conform(extract, schema.EXTRACT), staged.countries_mapping, staged.visa_categories, staged.us_states,
        options.key, options.on_duplicate, **options.limits,
    )
    expected = [] if period is None else [period_part(*period)]
    found = change.write_periods(rows, "i94", expected, rebalance=period is None)
    other = [p for p in found if p not in expected]
    if expected and other:
        raise OtherPeriods(f"rows of {', '.join(other)} do not belong to {expected[0]}")
    changed = expected or found
    for table in schema.KEPT_KEYS:
        change.drop_periods(table, changed)
    return changed


def publish_model(spark: SparkSession, extract: DataFrame, staged: Staged, root: str,
                  options: LoadOptions = LoadOptions()) -> Versions:
    """Replace all periods of an extract, and the dimensions, in one change without checks."""
    versions = Versions(spark, root)
    change = versions.begin()
    periods = change_fact(change, extract, staged, options)
    change_dates(change, periods)
    change_sums(change, periods)
    change_profiles(change, periods)
    change_dimensions(change, staged)
    change.publish()
    return versions


def publish_period(
    spark: SparkSession, extract: DataFrame, staged: Staged, root: str, year: int, month: int,
    options: LoadOptions = LoadOptions(), datasets: Sequence[quality.Dataset] = (), unique_across: Sequence[str] = (),
) -> DataFrame:
    """Load one month, check what was written, publish it; returns the quality report.

    The report is stored in any case. If a check fails, or the job ends before the last step, readers go on
    with the version before. ``datasets`` are checked beside the model's own. ``unique_across`` names keys of the fact
    (of ``schema.KEYS``) that no other published month may hold; their digests are kept from then on. A month that is
    published without it has its kept keys removed, and they are made anew when they are asked for.
    """
    if options.mode != "replace":
        raise ValueError("a published period is replaced as a whole")
    versions = Versions(spark, root)
    change = versions.begin()
    periods = change_fact(change, extract, staged, options, (year, month))
    change_dates(change, periods)
    change_sums(change, periods)
    change_profiles(change, periods)
    change_dimensions(change, staged)
    checked = [
        quality.Dataset(
            f"{root}/t={name}", fields,
            frame=change.read(name, periods if name == "i94" else None),
            where=f"year = {int(year)} AND month = {int(month)}" if name == "dates" else None)
        for name, fields in schema.NOT_NULL.items()
    ]
    report = quality.run_checks(spark, [*checked, *datasets], year, month)
    if unique_across:
        change_keys(change, periods)
        repeated = stage(repeated_keys(change, periods, unique_across), "repeated-keys")
        for field in unique_across:
            report = report.unionByName(quality.unique_across_check(repeated, field, year, month, f"{root}/t=i94"))
    report = quality.store_report(report, f"{root}/data_quality.parquet")
    quality.gate(report)
    change.publish()
    return report


class PublishedModel(Model):
    """The tables of one published version; later changes do not show in it."""

    def __init__(self, versions: Versions):
        super().__init__(versions.spark, versions.root)
        self._versions, self._manifest = versions, versions.current()

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in schema.PUBLISHED_TABLES:
            raise AttributeError(name)
        df = self._versions.read(name, self._manifest)
        setattr(self, name, df)
        return df

    def summed(self, *columns: str) -> DataFrame:
        """The smallest table that has ``count`` by all the columns; each table of sums covers every row of the fact."""
        for name, keys in sorted(schema.SUMS.items(), key=lambda item: len(item[1])):
            if set(columns) <= {*keys, *schema.PERIOD}:
                return getattr(self, name)
        return self.i94


_SHOWN = "starloom.manifest"


def register_published(versions: Versions, database: str | None = None, suffix: str = "") -> list[str]:
    """Make the current version known to SQL and return the names of its tables.

    Without ``database`` they become temporary views. With it they become external tables whose partitions lie in
    the folders of their versions. A table notes the manifest it shows, so what two manifests differ in is what is
    added, dropped or relocated; a table without a note, or of another root, is made anew.
    """
    spark, now = versions.spark, versions.current()
    names = []
    for table, kind in versions.tables.items():
        if table not in now.parts:
            continue
        name = f"{table}{suffix}"
        if database is None:
            versions.read(table, now).createOrReplaceTempView(f"`{name}`")
        else:
            name = f"{database}.{name}"
            for statement in _statements(versions, now, name, table, kind):
                spark.sql(statement)
            spark.catalog.refreshTable(name)
        names.append(name)
    return names


def _statements(versions: Versions, now: Manifest, name: str, table: str, kind) -> list[str]:
    spark, partitioned = versions.spark, table in versions.period_tables
    note, root = f"'{_SHOWN}' = '{now.number}'", sinks.qualified(spark, versions.root)
    folder = lambda part: f"{root}/v={now.of(table)[part]}/t={table}" + (f"/{part}" if part else "")
    place = root if partitioned else folder(WHOLE)
    before, statements = None, []
    if spark.catalog.tableExists(name):
        told = sinks.described(spark, name)
        shown = re.search(rf"{re.escape(_SHOWN)}=(\d+)", told.get("Table Properties", ""))
        if shown and told.get("Location", "").startswith(root) and spark.table(name).schema == kind:
            before = versions.manifest(int(shown[1])) if versions.has(int(shown[1])) else None
        if before is None:
            statements.append(f"DROP TABLE {name}")
    if before is None:
        statements.append(sinks.create_table(name, kind, place, partitioned, f"TBLPROPERTIES ({note})"))
        before = Manifest()
    elif before.number == now.number:
        return []
    elif not partitioned and before.of(table) != now.of(table):
        statements.append(f"ALTER TABLE {name} SET LOCATION '{place}'")
    if partitioned:
        for part in sorted({*before.of(table), *now.of(table)}):
            old, new = before.of(table).get(part), now.of(table).get(part)
            if old is None:
                statements.append(f"ALTER TABLE {name} ADD IF NOT EXISTS {sinks.partition_spec(part)} LOCATION '{folder(part)}'")
            elif new is None:
                statements.append(f"ALTER TABLE {name} DROP IF EXISTS {sinks.partition_spec(part)}")
            elif old != new:
                statements.append(f"ALTER TABLE {name} {sinks.partition_spec(part)} SET LOCATION '{folder(part)}'")
    return [*statements, f"ALTER TABLE {name} SET TBLPROPERTIES ({note})"]
