"""The monthly load on five printed rows: fact, reload, quality, catalog, arrivals."""

import dataclasses
import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starloom import __main__ as command
from starloom import schema, sinks
from starloom.operators import quality
from starloom.plans import analytics, dimensions, fact
from starloom.plans.load import LoadOptions, OtherPeriods, Staged, _of_periods, load_fact, run_period
from starloom.sources.tables import conform
from starloom.streaming import arrivals
from starloom.streaming.arrivals import Notes, load_arrivals
from starloom.versions import Versions
from tests.conftest import plan

NAMES = ("cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr", "depdate", "i94bir",
         "i94visa", "count", "dtadfile", "visapost", "biryear", "dtaddto", "gender", "airline", "admnum", "fltno",
         "visatype")
ROWS = [
    (4084316.0, 2016.0, 4.0, 209.0, 209.0, "HHW", 20566.0, 1.0, "HI", 20573.0, 61.0, 2.0, 1.0, "20160422", None,
     1955.0, "07202016", "F", "JL", 56582674633.0, "00782", "WT"),
    (4422636.0, 2016.0, 4.0, 582.0, 582.0, "MCA", 20567.0, 1.0, "TX", 20568.0, 26.0, 2.0, 1.0, "20160423", "MTR",
     1990.0, "10222016", "M", "*GA", 94361995930.0, "XBLNG", "B2"),
    (1195600.0, 2016.0, 4.0, 148.0, 112.0, "OGG", 20551.0, 1.0, "FL", 20571.0, 76.0, 2.0, 1.0, "20160407", None,
     1940.0, "07052016", "M", "LH", 55780468433.0, "00464", "WT"),
    (5291768.0, 2016.0, 4.0, 297.0, 297.0, "LOS", 20572.0, 1.0, "CA", 20581.0, 25.0, 2.0, 1.0, "20160428", "DOH",
     1991.0, "10272016", "M", "QR", 94789696030.0, "00739", "B2"),
    (985523.0, 2016.0, 4.0, 111.0, 111.0, "CHM", 20550.0, 3.0, "NY", 20553.0, 19.0, 2.0, 1.0, "20160406", None,
     1997.0, "07042016", "F", None, 42322572633.0, "LAND", "WT"),
]
TYPES = ", ".join(
    f"{n} {'string' if isinstance(ROWS[1][i], str) else 'double'}" for i, n in enumerate(NAMES))


@pytest.fixture
def extract(spark):
    return spark.createDataFrame(ROWS, TYPES)


@pytest.fixture
def staged(spark):
    make = spark.createDataFrame
    return Staged(
        make([(209, "JAPAN", "JP"), (582, "MEXICO", "MX"), (112, "GERMANY", "DE"), (148, "GERMANY", "DE"),
              (111, "FRANCE", "FR")], schema.COUNTRY_MAPPING),
        make([("Unknown Visa Categories", "Unknown Visa", "Unknown", None, 1), ("Temporary", "Visitor", "Tourist", "B2", 2)],
             schema.VISA_CATEGORIES),
        make([("HI", "Hawaii"), ("TX", "Texas"), ("FL", "Florida"), ("CA", "California"), ("99", "Unknown State")],
             schema.US_STATES),
        make([("JP", "Japan", "Asia"), ("MX", "Mexico", "North America"), ("DE", "Germany", "Europe"),
              ("FR", "France", "Europe"), ("99", "Unknown Country", "Unknown Continent Name")], schema.COUNTRIES),
        make([("DE", 4, 9.04, -1.0, 20.0), ("JP", 4, 12.0, 1.0, 22.0)], schema.TEMPERATURE),
    )


def build(extract, staged, **options):
    return fact.build_fact(conform(extract, schema.EXTRACT), staged.countries_mapping, staged.visa_categories,
                           staged.us_states, **options)


def test_fact_of_the_printed_rows(extract, staged):
    found = {r["cic_id"]: r for r in build(extract, staged).collect()}
    assert [found[i]["arrival_date"].isoformat() for i in (4084316, 4422636, 1195600, 5291768, 985523)] == [
        "2016-04-22", "2016-04-23", "2016-04-07", "2016-04-28", "2016-04-06"]
    assert [found[i]["duration"] for i in (4084316, 4422636, 1195600, 5291768, 985523)] == [7, 1, 20, 9, 3]
    third = found[1195600]
    assert (third["cit_country_id"], third["res_country_id"], third["state_id"], third["visa_id"]) == (
        "DE", "DE", "FL", 1)
    assert (found[5291768]["cit_country_id"], found[5291768]["visa_id"], found[985523]["state_id"]) == ("99", 2, "99")
    assert (third["mode_id"], third["purpose_id"], third["gender"], third["age"], third["count"]) == (1, 2, "M", 76, 1)
    assert [(f.name, f.dataType) for f in build(extract, staged).schema] == [
        (f.name, f.dataType) for f in schema.FACT]


def test_text_keeps_leading_zeros(extract):
    row = conform(extract, schema.EXTRACT).where("cicid = 4084316").first()
    assert (row["fltno"], row["dtaddto"], row["admnum"], row["occup"]) == ("00782", "07202016", 56582674633.0, None)


def test_missing_and_odd_values(spark, staged):
    odd = spark.createDataFrame([(7.0, 2016.0, 4.0, None, -3.0, "m", 20566.0, None)],
                                "cicid double, i94yr double, i94mon double, i94mode double, i94bir double, "
                                "gender string, arrdate double, depdate double")
    row = build(odd, staged).first()
    assert (row["mode_id"], row["purpose_id"], row["age"], row["gender"], row["duration"]) == (9, 9, None, "U", None)
    assert (row["cit_country_id"], row["state_id"], row["visa_id"]) == ("99", "99", 1)


@pytest.mark.parametrize("key, kind", [("period", int), ("hash", int), ("monotonic", int)])
def test_row_keys(extract, staged, key, kind):
    ids = [r["i94_id"] for r in build(extract, staged, key=key).collect()]
    assert len(set(ids)) == 5 and all(isinstance(i, kind) for i in ids)
    with pytest.raises(ValueError):
        build(extract, staged, key="other")


def test_row_count_never_changes(extract, staged):
    assert build(extract, staged, broadcast_rows=0, rows_per_task=1, hot_share=0.01).count() == 5


def model_of(spark, root, table):
    return sinks.read_model_table(spark, root, table)


def test_run_period_twice_gives_the_same_model(spark, extract, staged, tmp_path, rows):
    root = str(tmp_path / "model")
    first = run_period(spark, extract, staged, root, 2016, 4)
    before = {t: rows(model_of(spark, root, t)) for t in schema.MODEL_TABLES}
    run_period(spark, extract, staged, root, 2016, 4)
    assert {t: rows(model_of(spark, root, t)) for t in schema.MODEL_TABLES} == before
    assert len(before["i94"]) == 5 and len(before["dates"]) == 5 and len(before["mode"]) == 4
    assert quality.failed_count(first) == 0 and first.count() == 8 + 18
    assert spark.read.parquet(f"{root}/data_quality.parquet").count() == 2 * 26
    assert (tmp_path / "model/i94.parquet/year=2016/month=4").is_dir()


def test_append_mode_doubles(spark, extract, staged, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        load_fact(extract, staged, root, LoadOptions(mode="append"), (2016, 4))
    assert model_of(spark, root, "i94").count() == 10
    assert model_of(spark, root, "dates").count() == 5


def test_other_periods_are_refused(spark, extract, staged, tmp_path):
    other = extract.withColumn("i94mon", F.when(F.col("cicid") == 985523, 5.0).otherwise(F.col("i94mon")))
    with pytest.raises(OtherPeriods, match="1 rows"):
        run_period(spark, other, staged, str(tmp_path / "m"), 2016, 4)
    assert not (tmp_path / "m").exists()


def test_replacing_a_period_leaves_the_others(spark, extract, staged, tmp_path, rows):
    root = str(tmp_path)
    may = extract.withColumn("i94mon", F.lit(5.0))
    load_fact(extract.unionByName(may), staged, root)
    load_fact(may.limit(0).unionByName(may.where("cicid = 985523")), staged, root, period=(2016, 5))
    counted = model_of(spark, root, "i94").groupBy("month").count()
    assert rows(counted) == [(4, 5), (5, 1)]


def test_gate_closes_when_a_key_is_missing(spark, extract, staged, tmp_path):
    broken = extract.withColumn("arrdate", F.lit(None).cast("double"))
    with pytest.raises(quality.QualityGateFailed):
        run_period(spark, broken, staged, str(tmp_path), 2016, 4)
    stored = spark.read.parquet(f"{tmp_path}/data_quality.parquet")
    failed = {(r["path"].split("/")[-1], r["test"], r["field"]) for r in stored.where("result = 'failed'").collect()}
    assert ("i94.parquet", "has_nulls", "arrival_date") in failed


def test_csv_copies_and_staging_files(spark, extract, staged, tmp_path, rows):
    root, stage = str(tmp_path / "model"), str(tmp_path / "staging")
    staged.write(stage)
    read = Staged.read(spark, stage)
    assert rows(read.countries_mapping) == rows(staged.countries_mapping)
    assert rows(read.visa_categories) == rows(staged.visa_categories)
    run_period(spark, extract, read, root, 2016, 4, LoadOptions(csv_copies=True))
    assert spark.read.csv(f"{root}/i94.csv", sep=";", header=True).count() == 5
    assert spark.read.csv(f"{root}/dates.csv", sep=";", header=True).count() == 5
    assert spark.read.csv(f"{root}/data_quality.csv", sep=";", header=True).count() == 26
    assert rows(spark.read.csv(f"{root}/mode.csv", sep=";", header=True)) == [
        ("1", "Air"), ("2", "Sea"), ("3", "Land"), ("9", "Not reported")]


def test_date_dimension_drops_null_and_repeats(spark, rows):
    frame = spark.sql("SELECT * FROM VALUES (DATE'2016-01-01'), (DATE'2016-01-01'), (NULL) AS t(d)")
    assert rows(fact.date_dimension(frame, "d")) == [(dt.date(2016, 1, 1), 1, 53, 2016, 1)]


@pytest.fixture
def loaded(spark, extract, staged, tmp_path):
    root = str(tmp_path / "model")
    run_period(spark, extract, staged, root, 2016, 4)
    return root


def test_sql_over_views_and_catalogued_tables(spark, loaded, rows):
    people = "SELECT country_name, sum(count) FROM {i} LEFT JOIN {c} ON cit_country_id = country_id GROUP BY 1"
    wanted = [("France", 1), ("Germany", 1), ("Japan", 1), ("Mexico", 1), ("Unknown Country", 1)]
    assert sinks.register_model(spark, loaded) == list(schema.MODEL_TABLES)
    assert rows(spark.sql(people.format(i="i94", c="countries"))) == wanted
    spark.sql("CREATE DATABASE IF NOT EXISTS model_db")
    sinks.register_model(spark, loaded, database="model_db", suffix="_parquet")
    assert rows(spark.sql(people.format(i="model_db.i94_parquet", c="model_db.countries_parquet"))) == wanted
    assert spark.sql("SHOW PARTITIONS model_db.i94_parquet").count() == 1


def test_new_partitions_show_after_registering_again(spark, loaded, extract, staged):
    spark.sql("CREATE DATABASE IF NOT EXISTS model_db")
    sinks.register_model(spark, loaded, database="model_db", suffix="_again", tables=["i94"])
    load_fact(extract.withColumn("i94mon", F.lit(6.0)), staged, loaded, period=(2016, 6))
    sinks.register_model(spark, loaded, database="model_db", suffix="_again", tables=["i94"])
    assert spark.sql("SELECT count(*) FROM model_db.i94_again").first()[0] == 10


def test_sql_with_quoted_names(spark, loaded, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS quoted_db")
    sinks.register_model(spark, loaded, database="quoted_db", suffix="_parquet")
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        found = spark.sql("""
            WITH people AS (
                SELECT c.country_name, s.state_name, f.month, round(t.temperature_mean, 1) AS mean_temperature,
                       sum(CASE WHEN p.purpose_desc = 'Pleasure' THEN count ELSE 0 END) AS tourists, sum(count) AS n
                FROM "quoted_db"."i94_parquet" f
                LEFT OUTER JOIN "quoted_db"."countries_parquet" c ON c.country_id = f.res_country_id
                LEFT OUTER JOIN "quoted_db"."us_states_parquet" s ON s.state_id = f.state_id
                LEFT OUTER JOIN "quoted_db"."purpose_parquet" p ON p.purpose_id = f.purpose_id
                LEFT OUTER JOIN "quoted_db"."temperature_parquet" t
                    ON t.country_id = f.res_country_id AND t.month = f.month
                WHERE c.country_id = 'DE' AND p.purpose_desc IN ('Business', 'Pleasure') AND f.state_id IN ('FL', 'CA')
                GROUP BY 1, 2, 3, 4 ORDER BY cast(f.month AS integer))
            SELECT country_name, state_name, month, mean_temperature, n,
                   round(cast(tourists AS double) / cast(n AS double) * 100, 0) AS rel_tourists FROM people""")
        assert rows(found) == [("Germany", "Florida", 4, 9.0, 1, 100.0)]
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")


def test_register_leaves_out_missing_tables(spark, tmp_path):
    assert sinks.register_model(spark, str(tmp_path)) == []


def test_star_queries(spark, loaded, rows):
    model = analytics.Model(spark, loaded)
    assert rows(analytics.by_citizenship(model))[0] == ("Asia", "Japan", 1)
    assert rows(analytics.tourists_and_business(model, "DE", ["FL", "CA"])) == [
        ("Germany", "Florida", 4, 9.0, 1, 100.0, 0.0)]
    assert rows(analytics.share_of_value(model, "cit_country_id", "DE")) == [(1, 5, 20.0)]
    with pytest.raises(AttributeError):
        model.other
    with pytest.raises(AnalysisException):
        analytics.Model(spark, loaded + "x").i94


def test_arrivals_load_each_period_whole(spark, extract, staged, tmp_path, rows):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "model", "checkpoint"))

    def arrive(frame):
        frame.coalesce(1).write.mode("append").parquet(landing)
        load_arrivals(spark, landing, extract.schema, lambda: staged, root, checkpoint,
                      files_per_batch=1).awaitTermination()

    arrive(extract.where("cicid < 2000000"))
    assert model_of(spark, root, "i94").count() == 2
    arrive(extract.where("cicid >= 2000000"))
    assert rows(model_of(spark, root, "i94")) == rows(build(extract, staged))
    arrive(extract.withColumn("i94mon", F.lit(7.0)))
    assert rows(model_of(spark, root, "i94").groupBy("month").count()) == [(4, 5), (7, 5)]


def test_arrivals_keep_rows_without_a_readable_period(spark, extract, staged, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "model")
    extract.withColumn("i94mon", F.when(F.col("cicid") > 2000000, F.col("i94mon"))).write.parquet(landing)

    def start(options=LoadOptions()):
        return load_arrivals(spark, landing, extract.schema, lambda: staged, root, str(tmp_path / "c"), options)

    with pytest.raises(ValueError, match="replace"):
        start(LoadOptions(mode="append"))
    start().awaitTermination()
    loaded = model_of(spark, root, "i94")
    assert loaded.count() == 5 and loaded.where("month IS NULL").count() == 2
    assert model_of(spark, root, "dates").count() == loaded.select("arrival_date").distinct().count()


def test_notes_of_touched_periods_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrivals, "MERGE_AT", 3)
    early = Notes(spark, str(tmp_path / "early"))
    spark.sql("SELECT 'e' AS file, 2003 AS i94yr, 4 AS i94mon").write.parquet(early.root)
    early.adopt()
    early.adopt()
    assert [r.file for r in early.read(["2003_4"]).collect()] == ["e"]
    notes = Notes(spark, str(tmp_path / "notes"))
    many = spark.range(100_000).selectExpr("concat('f', id) AS file", "2000 + CAST(id % 10 AS INT) AS i94yr", "4 AS i94mon")
    assert notes.add(many, 0) == [f"{2000 + k}_4" for k in range(10)]
    assert notes.add(spark.sql("SELECT 'g' AS file, 2003 AS i94yr, CAST(NULL AS INT) AS i94mon"), 1) == ["2003_none"]
    late = spark.sql("SELECT 'late' AS file, 2003 AS i94yr, 4 AS i94mon")
    for _ in range(2):  # a batch that is repeated
        assert notes.add(late, 2) == ["2003_4"]
    found = notes.read(["2003_4"])
    assert found.count() == 10_001 and all("period=2003_4/" in f for f in found.inputFiles())
    notes.merge("2003_4", 2)
    assert len(list((tmp_path / "notes/period=2003_4").iterdir())) == 2
    notes.add(late.selectExpr("'later' AS file", "i94yr", "i94mon"), 3)
    notes.merge("2003_4", 3)
    assert [p.name for p in (tmp_path / "notes/period=2003_4").iterdir()] == ["batch=3_merged"]
    assert notes.read(["2003_4"]).count() == 10_002
    assert arrivals._as_rows(spark, ["2003_none"]).first() == (2003, None)


def test_append_of_a_month_stores_the_dates_of_other_months(spark, extract, staged, tmp_path):
    root = str(tmp_path / "m")
    mixed = extract.withColumn("i94mon", F.when(F.col("cicid") > 2000000, 4.0).otherwise(5.0))
    load_fact(mixed, staged, root, LoadOptions(mode="append"), (2016, 4))
    assert model_of(spark, root, "dates").count() == model_of(spark, root, "i94").select("arrival_date").distinct().count()


def test_dates_are_read_from_the_touched_partitions_only(spark, extract, staged, tmp_path):
    root = str(tmp_path / "m")
    load_fact(extract, staged, root)
    load_fact(extract.withColumn("i94mon", F.lit(5.0)), staged, root)
    touched = _of_periods(model_of(spark, root, "i94"), spark.createDataFrame([(2016, 5)], "year int, month int"))
    assert len(touched.inputFiles()) < len(model_of(spark, root, "i94").inputFiles()) or "PartitionFilters: [" in plan(touched)
    assert touched.count() == 5


def test_jobs_from_the_command_line(spark, extract, staged, tmp_path, rows):
    raw, staging, root = (str(tmp_path / n) for n in ("raw", "staging", "model"))
    extract.coalesce(1).write.parquet(f"{raw}/one")
    (part,) = (tmp_path / "raw/one").glob("*.parquet")
    (tmp_path / "raw/i94_apr16_sub.parquet").write_bytes(part.read_bytes())
    (tmp_path / "raw/i94_may16_sub.parquet").write_bytes(b"not read")
    staged.write(staging)
    period = ["--model", root, "--year", "2016", "--month", "4"]
    command.main(["load", "--raw", raw, "--staging", staging, *period])
    command.main(["check", *period])
    assert model_of(spark, root, "i94").count() == 5
    assert spark.read.parquet(f"{root}/data_quality.parquet").count() == 2 * 26
    published = str(tmp_path / "published")
    command.main(["load", "--raw", raw, "--staging", staging, "--publish", "--model", published, "--year", "2016", "--month", "4"])
    assert rows(Versions(spark, published).read("i94")) == rows(model_of(spark, root, "i94"))
    with pytest.raises(FileNotFoundError):
        command.main(["load", "--raw", raw, "--staging", staging, "--model", root, "--year", "2016", "--month", "7"])
    with pytest.raises(quality.QualityGateFailed):
        command.main(["check", "--model", root, "--year", "2015", "--month", "7"])


def test_country_mapping_and_dimension(spark, rows):
    labels = spark.createDataFrame(
        [("111", "FRANCE"), ("112", "GERMANY"), ("148", "germany"), ("700", "INVALID: STATELESS"), ("5", "ATLANTIS"),
         ("6", "No Country Code (6)"), ("516", "ST. LUCIA"), ("9", "NAMIBIA")], "i94_code string, i94_desc string")
    countries = spark.createDataFrame(
        [("FR", "France", "Europe"), ("DE", "Germany", "Europe"), ("LC", "Saint Lucia", "North America"),
         ("NA", "Namibia", "Africa"), ("DE", "Germany", "Europe")], schema.COUNTRIES)
    mapping = dimensions.country_mapping(labels, countries)
    assert rows(mapping) == [(111, "FRANCE", "FR"), (112, "GERMANY", "DE"), (148, "germany", "DE"),
                             (516, "SAINT LUCIA", "LC"), (9, "NAMIBIA", "NA")]
    table = dimensions.country_dimension(mapping, countries.distinct())
    assert rows(table) == [
        ("99", "Unknown Country", "Unknown Continent Name"), ("DE", "Germany", "Europe"), ("FR", "France", "Europe"),
        ("LC", "Saint Lucia", "North America"), ("NA", "Namibia", "Africa")]
    assert dimensions.country_dimension(mapping, countries.distinct(), dedupe=False, unknown=False).count() == 5


def test_climatology_merges_names_of_one_country(spark, rows):
    frame = spark.sql("""SELECT * FROM VALUES
        (DATE'2013-09-01', 'Germany', 10D), (DATE'2013-09-02', 'GERMANY', 20D), (DATE'2012-09-01', 'Germany', NULL),
        (DATE'2010-09-01', 'Germany', double('NaN')), (DATE'1993-09-01', 'Germany', 99D),
        (DATE'1994-09-01', 'Germany', 0D), (DATE'2013-09-01', 'Atlantis', 5D) AS t(dt, country, reading)""")
    countries = spark.createDataFrame([("DE", "Germany")], "country_id string, country_name string")
    assert rows(dimensions.climatology(frame, "country", "dt", "reading", countries)) == [("DE", 9, 10.0, 0.0, 20.0)]


def test_visa_dimension_from_a_page(spark, rows):
    page = """<h4 class="tsg-rwd-accordion-header-name-frame">Immigrant</h4>
      <table class="grid"><tbody><tr><td><b>Employment</b></td><td>Visa</td></tr>
      <tr><td>Workers\nheading\nFirst\nSecond</td><td>E1\n\nE2</td></tr>
      <tr><td>Transit\nalien</td><td>C-1, C-2/C-3</td></tr>
      <tr><td>Transit alien of the government</td><td>C-2</td></tr>
      <tr><td>none</td><td>-</td></tr></tbody></table>"""
    pages = spark.createDataFrame([(1, page)], "page int, html string")
    found = dimensions.visa_rows(dimensions.visa_pages(pages, "page", "html"), "page")
    codes = dimensions.visa_codes(dimensions.split_stacked(found, "visa_desc LIKE 'Workers%'"))
    place = ["page", "table_no", "row_no", "line_no", "part_no"]
    assert rows(dimensions.visa_dimension(codes, place), "visa_id", "visa", "visa_desc", "visa_group") == [
        (1, "", "Unknown", "Unknown Visa"), (2, "E1", "First", "Employment"), (3, "E2", "Second", "Employment"),
        (4, "C1", "Transit alien", "Employment"), (5, "C2", "Transit alien", "Employment"),
        (6, "C3", "Transit alien", "Employment")]
    chosen = spark.createDataFrame([("C2", "Transit alien of the government")], "visa string, visa_desc string")
    curated = dimensions.visa_dimension(codes, place, curated=chosen)
    assert rows(curated.where("visa = 'C2'"), "visa_desc") == [("Transit alien of the government",)]
    nothing = dimensions.visa_dimension(codes, place, curated=chosen.where("visa = 'none'"))
    assert nothing.where("visa = 'C2'").count() == 0


def test_state_dimension(spark, rows):
    texts = spark.createDataFrame([("f", "value i94addrl\n'AL'='ALABAMA'\n;")], "source string, text string")
    assert rows(dimensions.state_dimension(texts)) == [("99", "Unknown State"), ("AL", "ALABAMA")]
    assert rows(dimensions.state_dimension(texts, unknown=False)) == [("AL", "ALABAMA")]


def test_state_dimension_with_a_label_for_99(spark, extract, staged, rows):
    texts = spark.createDataFrame(
        [("f", "value i94addrl\n'HI'='HAWAII'\n'99'='All Other Codes'\n;")], "source string, text string")
    states = dimensions.state_dimension(texts)
    assert rows(states) == [("99", "All Other Codes"), ("HI", "HAWAII")]
    built = build(extract, dataclasses.replace(staged, us_states=states))
    assert rows(built.groupBy("state_id").count()) == [("99", 4), ("HI", 1)]
