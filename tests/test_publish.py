"""Published versions: seen as a whole after the checks, in order, and with what belongs to the fact."""

import pytest
from pyspark.sql import functions as F

from starloom import schema
from starloom.operators import quality
from starloom.operators.key_filters import key_digests, key_filters, probed
from starloom.operators.profile import describe_profiles, merge_profiles, mergeable_profile
from starloom.plans import analytics, publish
from starloom.plans.compact import compact, packed, stored_files
from starloom.plans.load import LoadOptions, OtherPeriods
from starloom.plans.publish import PublishedModel, publish_model, publish_period
from starloom.versions import Conflict, Versions, period_part
from tests.conftest import plan
from tests.test_load import build, extract, staged  # noqa: F401


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "model")


def later(extract):  # noqa: F811
    """The same rows a month later."""
    return extract.withColumn("i94mon", F.lit(5.0)).withColumn("arrdate", F.col("arrdate") + 30)


def fact_of(spark, root):
    return Versions(spark, root).read("i94")


def test_a_month_is_seen_after_its_checks(spark, extract, staged, root, rows):  # noqa: F811
    report = publish_period(spark, extract, staged, root, 2016, 4)
    assert quality.failed_count(report) == 0 and report.count() == 8 + 18
    assert rows(fact_of(spark, root)) == rows(build(extract, staged))
    broken = extract.where("cicid < 2000000").withColumn("gender", F.lit(None).cast("string")).withColumn(
        "arrdate", F.when(F.col("cicid") > 1000000, F.col("arrdate")))
    with pytest.raises(quality.QualityGateFailed):
        publish_period(spark, broken, staged, root, 2016, 4)
    assert Versions(spark, root).current().number == 1
    assert rows(fact_of(spark, root)) == rows(build(extract, staged))
    assert spark.read.parquet(f"{root}/data_quality.parquet").count() == 2 * 26
    publish_period(spark, extract.where("cicid < 2000000"), staged, root, 2016, 4)
    assert fact_of(spark, root).count() == 2


def test_a_job_that_ends_before_the_last_step_changes_nothing(spark, extract, staged, root, rows, monkeypatch):  # noqa: F811
    publish_period(spark, extract, staged, root, 2016, 4)
    held = Versions(spark, root)
    before = {t: rows(held.read(t)) for t in schema.PUBLISHED_TABLES}

    def stop(report):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(publish.quality, "gate", stop)
        with pytest.raises(KeyboardInterrupt):
            publish_period(spark, extract.where("cicid < 2000000"), staged, root, 2016, 4)
    assert {t: rows(held.read(t)) for t in schema.PUBLISHED_TABLES} == before
    assert len(held.listed("v=*")) == 2 and len(held.vacuum(keep=1)) == 1
    assert {t: rows(held.read(t)) for t in schema.PUBLISHED_TABLES} == before


def test_readers_of_a_version_do_not_see_the_next(spark, extract, staged, root):  # noqa: F811
    publish_period(spark, extract, staged, root, 2016, 4)
    model = PublishedModel(Versions(spark, root))
    publish_period(spark, extract.where("cicid < 2000000"), staged, root, 2016, 4)
    assert model.i94.count() == 5 and PublishedModel(Versions(spark, root)).i94.count() == 2
    with pytest.raises(AttributeError):
        model.other


def test_rows_of_another_month_are_refused(spark, extract, staged, root):  # noqa: F811
    other = extract.withColumn("i94mon", F.when(F.col("cicid") == 985523, 5.0).otherwise(F.col("i94mon")))
    with pytest.raises(OtherPeriods, match="month=5"):
        publish_period(spark, other, staged, root, 2016, 4)
    with pytest.raises(ValueError, match="replaced"):
        publish_period(spark, extract, staged, root, 2016, 4, LoadOptions(mode="append"))
    assert Versions(spark, root).current().parts == {}
    with pytest.raises(quality.QualityGateFailed):  # an empty month has no rows
        publish_period(spark, extract.limit(0), staged, root, 2016, 4)


def test_changes_of_other_months_stay_and_of_the_same_conflict(spark, extract, staged, root, rows):  # noqa: F811
    versions = Versions(spark, root)
    changes = [versions.begin() for _ in range(3)]
    for change, month in zip(changes, (4, 5, 4), strict=True):
        publish.change_fact(change, extract.withColumn("i94mon", F.lit(float(month))), staged)
    assert changes[0].publish().number == 1
    assert changes[1].publish().number == 2
    with pytest.raises(Conflict, match="month=4"):
        changes[2].publish()
    assert rows(versions.read("i94").groupBy("month").count()) == [(4, 5), (5, 5)]
    assert not versions.put(versions.current())  # a number is given once
    assert len(versions.read("i94").where("month = 4").inputFiles()) <= len(versions.read("i94").inputFiles())


def test_dates_go_with_their_last_row(spark, extract, staged, root, rows):  # noqa: F811
    def same():
        held = Versions(spark, root)
        wanted = held.read("i94").where("arrival_date IS NOT NULL").groupBy("arrival_date").count()
        assert rows(held.read("dates"), "date") == rows(wanted, "arrival_date")
        assert rows(held.read("date_totals"), "date", "rows") == rows(wanted)

    may = extract.where("cicid > 4000000").withColumn("i94mon", F.lit(5.0))
    publish_model(spark, extract.unionByName(may), staged, root)
    same()
    one = extract.where("cicid = 985523")
    publish_period(spark, one, staged, root, 2016, 4)
    same()
    first = Versions(spark, root).current()
    publish_period(spark, one, staged, root, 2016, 4)  # nothing changes, so no date is written
    assert Versions(spark, root).current().of("dates") == first.of("dates")
    publish_model(spark, may.where("cicid = 4084316").withColumn("arrdate", F.lit(None).cast("double")), staged, root)
    same()
    assert Versions(spark, root).read("dates").count() == 1


def test_months_without_a_name_are_parts_as_well(spark, extract, staged, root, rows):  # noqa: F811
    publish_model(spark, extract.withColumn("i94mon", F.when(F.col("cicid") > 2000000, F.col("i94mon"))), staged, root)
    found = Versions(spark, root)
    assert period_part(2016, None) in found.current().of("i94") and found.read("i94").where("month IS NULL").count() == 2
    assert rows(found.read("sums_by_kind").groupBy("month").agg(F.sum("count"))) == [(4, 3), (None, 2)]


def test_star_queries_read_sums_where_they_cover(spark, extract, staged, root, rows):  # noqa: F811
    publish_model(spark, extract, staged, root)
    model = PublishedModel(Versions(spark, root))
    for covered in (analytics.by_citizenship, analytics.by_state_month, analytics.by_state, analytics.share_by_mode,
                    analytics.share_by_purpose, analytics.top_visa, analytics.weather_and_arrivals):
        assert "t=i94" not in plan(covered(model)).replace(", ", " ")
    assert not any("t=i94" in f for f in analytics.by_state_month(model).inputFiles())
    assert any("t=i94" in f for f in analytics.age_gender(model).inputFiles())
    assert model.summed("age") is model.i94 and model.summed("mode_id", "state_id") is model.i94
    assert rows(analytics.share_of_value(model, "cit_country_id", "DE")) == [(1, 5, 20.0)]
    assert rows(analytics.tourists_and_business(model, "DE", ["FL", "CA"])) == [
        ("Germany", "Florida", 4, 9.0, 1, 100.0, 0.0)]
    publish_period(spark, extract.where("cicid < 2000000"), staged, root, 2016, 4)
    again = PublishedModel(Versions(spark, root))
    assert again.sums_by_place.agg(F.sum("count")).first()[0] == again.i94.agg(F.sum("count")).first()[0] == 2


def test_small_files_are_gathered(spark, extract, staged, root, rows):  # noqa: F811
    versions = Versions(spark, root)
    publish_period(spark, extract.repartition(5, "cicid"), staged, root, 2016, 4)
    publish_period(spark, later(extract).coalesce(1), staged, root, 2016, 5)
    before, files = rows(versions.read("i94")), stored_files(versions, "i94")
    many = files.where("part = 'year=2016/month=4'").count()
    assert many > 2 and files.agg(F.sum("bytes")).first()[0] > 0
    assert compact(versions) == {"i94": ["year=2016/month=4"]}
    assert rows(versions.read("i94")) == before and stored_files(versions, "i94").count() == 2
    assert compact(versions) == {} and versions.current().number == 3
    held = versions.begin()
    held.write_periods(versions.read("i94"), "i94")
    publish_period(spark, extract, staged, root, 2016, 4)
    with pytest.raises(Conflict):
        held.publish()


def test_files_are_packed_into_bins(spark, rows):
    sizes = [90, 60, 50, 40, 30, 20, 10]
    files = spark.createDataFrame([("a", f"f{i}", s) for i, s in enumerate(sizes)] + [("b", "x", 500), ("b", "y", 500)],
                                  "part string, place string, bytes long")
    found = rows(packed(files, target_bytes=100))
    assert [b for _, _, b in found] == [0, 1, 1, 2, 2, 2, 2] and {p for p, *_ in found} == {"a"}


def test_profiles_merge(spark, rows):
    frame = spark.sql("""SELECT id % 7 AS p, IF(id % 5 = 0, NULL, CAST(id % 300 AS INT)) AS n, CAST(id AS DOUBLE) / 2 AS d,
        CAST(id % 40 AS STRING) AS s, date_add(DATE'2016-01-01', CAST(id % 31 AS INT)) AS day FROM range(5000)""")
    fields = ["n", "d", "s", "day"]
    by_part = merge_profiles(mergeable_profile(frame, fields, ["p"]))
    whole = mergeable_profile(frame, fields)
    assert rows(by_part.drop("distinct")) == rows(whole.drop("distinct").select(*by_part.drop("distinct").columns))
    found = {r["field"]: r for r in describe_profiles(by_part).collect()}
    exact = frame.agg(F.mean("n"), F.stddev("n"), F.min("n"), F.max("n"), F.count_if(F.col("n").isNull())).first()
    assert (found["n"]["mean"], found["n"]["least"], found["n"]["largest"], found["n"]["nulls"]) == (
        exact[0], exact[2], exact[3], exact[4]) and abs(found["n"]["stddev"] - exact[1]) < 1e-9
    for name in fields:
        distinct = frame.select(name).dropna().distinct().count()
        assert abs(found[name]["distinct_values"] - distinct) <= 0.05 * distinct
    assert (found["s"]["least_text"], found["s"]["largest_text"], found["s"]["mean"]) == ("0", "9", None)
    nothing = describe_profiles(mergeable_profile(frame.limit(0), fields)).collect()
    assert {(r["rows"], r["mean"], r["stddev"], r["distinct_values"]) for r in nothing} == {(0, None, None, 0)}


def test_a_new_month_is_profiled_alone(spark, extract, staged, root, rows):  # noqa: F811
    publish_period(spark, extract, staged, root, 2016, 4)
    publish_period(spark, later(extract.where("cicid < 2000000")), staged, root, 2016, 5)
    model = PublishedModel(Versions(spark, root))
    merged = {r["field"]: r for r in merge_profiles(model.profiles).collect()}
    assert merged["age"]["rows"] == 7 and merged["age"]["total"] == model.i94.agg(F.sum("age")).first()[0]
    assert len({v for v in Versions(spark, root).current().of("profiles").values()}) == 2


def test_keys_of_other_months_fail_a_month(spark, extract, staged, root, rows):  # noqa: F811
    keys = ["cic_id"]
    publish_period(spark, extract, staged, root, 2016, 4)  # keeps no keys: they are made when they are asked for
    fresh = later(extract).withColumn("cicid", F.col("cicid") + 10_000_000)
    publish_period(spark, fresh, staged, root, 2016, 5, unique_across=keys)
    versions = Versions(spark, root)
    assert set(versions.current().of("key_filters")) == {period_part(2016, 4), period_part(2016, 5)}
    mixed = fresh.withColumns({"cicid": F.when(F.col("cicid") < 12_000_000, F.col("cicid") - 10_000_000).otherwise(
        F.col("cicid") + 20_000_000), "i94mon": F.lit(6.0), "arrdate": F.col("arrdate") + 31})
    with pytest.raises(quality.QualityGateFailed):
        publish_period(spark, mixed, staged, root, 2016, 6, unique_across=keys)
    assert versions.current().number == 2
    stored = spark.read.parquet(f"{root}/data_quality.parquet").where("test = 'is_unique_across' AND month = '6'")
    assert rows(stored, "field", "result", "num_recs") == [("cic_id", "failed", "2")]
    change = versions.begin()
    periods = publish.change_fact(change, mixed, staged, period=(2016, 6))
    publish.change_keys(change, periods)
    assert rows(publish.repeated_keys(change, periods, keys)) == [
        ("cic_id", "1195600", 2016, 6, 2016, 4), ("cic_id", "985523", 2016, 6, 2016, 4)]
    publish_period(spark, extract.where("cicid > 2000000"), staged, root, 2016, 4)
    assert period_part(2016, 4) not in versions.current().of("key_filters")
    publish_period(spark, mixed, staged, root, 2016, 6, unique_across=keys)  # the rows have gone from April
    with pytest.raises(ValueError, match="airline"):
        publish.repeated_keys(change, periods, ["airline"])


def test_key_filters_lose_no_key_and_let_few_strange_ones_pass(spark):
    held = spark.range(20000).selectExpr("id AS k", "CAST(id % 3 AS INT) AS year", "IF(id % 2 = 0, NULL, 1) AS month")
    filters = key_filters(key_digests(held, ["k"], ["year", "month"]), ["year", "month"])
    asked = spark.range(40000).selectExpr("id AS k", "0 AS p")
    found = probed(key_digests(asked, ["k"], ["p"]), filters)
    own = held.selectExpr("xxhash64(k) AS digest", "year", "month").exceptAll(found.select("digest", "year", "month"))
    assert own.count() == 0 and found.count() < 20000 + 220000 * 0.005
    assert probed(key_digests(asked, ["k"], ["p"]), filters.limit(0)).count() == 0
