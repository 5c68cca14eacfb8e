"""Readers and parsers on files and texts."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from starloom import schema, sinks
from starloom.sources import files, html, labels, markup, tables


def test_csv_keeps_na_and_reads_empty_as_null(spark, tmp_path, rows):
    (tmp_path / "c.csv").write_text("country_id;country_name;continent_name\nNA;Namibia;Africa\nXX;;\n")
    found = tables.read_delimited(spark, str(tmp_path / "c.csv"), schema.COUNTRIES)
    assert rows(found) == [("NA", "Namibia", "Africa"), ("XX", None, None)]


def test_csv_with_a_comma_and_no_schema(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text("dt,Country\n1743-11-01,Denmark\n")
    assert rows(tables.read_delimited(spark, str(tmp_path / "t.csv"), sep=",")) == [("1743-11-01", "Denmark")]


def test_format_follows_the_path(spark, tmp_path, rows):
    frame = spark.createDataFrame(list(schema.MODE_ROWS), schema.MODE)
    sinks.write_full(frame, str(tmp_path / "mode.parquet"), one_file=True)
    sinks.export_csv(frame, str(tmp_path / "mode.csv"), one_file=True)
    assert rows(tables.read_table(spark, str(tmp_path / "mode.parquet"))) == list(schema.MODE_ROWS)
    assert rows(tables.read_table(spark, str(tmp_path / "mode.csv"), schema=schema.MODE)) == list(schema.MODE_ROWS)


def test_conform(spark):
    raw = spark.sql("SELECT 4084316.0D AS CICID, '5.0' AS i94bir, 'x' AS i94mon, 582.0D AS i94port, 1 AS extra")
    found = tables.conform(raw, schema.EXTRACT)
    assert found.schema == schema.EXTRACT
    row = found.first()
    assert (row["cicid"], row["i94bir"], row["i94mon"], row["i94port"], row["admnum"]) == (
        4084316, 5, None, "582", None)


def test_conform_strict(spark):
    with pytest.raises(ValueError, match="missing"):
        tables.conform(spark.range(1), schema.MODE, strict=True)
    raw = spark.sql("SELECT 'x' AS mode_id, 'Air' AS mode_desc")
    with pytest.raises(Exception, match="mode_id: x"):
        tables.conform(raw, schema.MODE, strict=True).collect()
    good = spark.sql("SELECT '1.0' AS mode_id, 'Air' AS mode_desc")
    assert tuple(tables.conform(good, schema.MODE, strict=True).first()) == (1, "Air")


def test_read_period_prunes_partitions(spark, tmp_path):
    frame = spark.range(24).selectExpr("id", "int(2016 + id % 2) AS year", "int(1 + id % 12) AS month")
    sinks.load_period(frame, str(tmp_path / "t"))
    found = tables.read_period(spark, str(tmp_path / "t"), 2016, 3)
    assert [tuple(r) for r in found.select("id", "year", "month").orderBy("id").collect()] == [
        (2, 2016, 3), (14, 2016, 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(year#" in plan.split("PartitionFilters")[1]


LABELS = """/* header */
value i94cntyl
\t   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'
   236 =  'AFGHANISTAN'
   101 =  'ALBANIA'
   999 =  'A = B'
   no pair
   101 =  'ALBANIA (new)' ;
value i94addrl
\t'AL'='ALABAMA'
\t'99'='All Other Codes'
;
"""


def test_label_block(spark, tmp_path, rows):
    (tmp_path / "labels.txt").write_text(LABELS)
    texts = labels.read_texts(spark, str(tmp_path / "labels.txt"))
    found = labels.parse_label_block(texts, schema.LABEL_COUNTRIES, "k", "v")
    assert rows(found, "k", "v") == [
        ("101", "ALBANIA (new)"), ("236", "AFGHANISTAN"),
        ("582", "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)")]
    assert rows(labels.parse_label_block(texts, schema.LABEL_STATES, "k", "v"), "k", "v") == [
        ("99", "All Other Codes"), ("AL", "ALABAMA")]
    assert labels.parse_label_block(texts, "absent", "k", "v").count() == 0


def test_list_files(spark, tmp_path, rows):
    for name in ("a/i94_apr16_sub.sas7bdat", "a/b/i94_jan99_sub.sas7bdat", "a/b/other.csv"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    found = files.list_files(spark, str(tmp_path), ".sas7bdat")
    assert rows(found, "name") == [("i94_apr16_sub",), ("i94_jan99_sub",)]
    assert all(r[0].startswith("file:") for r in rows(found, "path"))
    assert rows(files.period_files(found), "name", "period") == [
        ("i94_apr16_sub", "2016-04"), ("i94_jan99_sub", "1999-01")]
    assert rows(files.period_files(found, 2016, 4), "period") == [("2016-04",)]


def test_period_from_name(spark):
    names = ["i94_apr16_sub", "i94_JAN99_sub", "i94_dec68_sub", "i94_feb69_sub", "i94_xyz16_sub", "other", None]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in frame.select(files.period_from_name(F.col("n"))).collect()] == [
        dt.date(2016, 4, 1), dt.date(1999, 1, 1), dt.date(2068, 12, 1), dt.date(1969, 2, 1), None, None, None]


PAGE = """<html><h4 class="cap x"> First &amp; one </h4><h4>not a caption</h4>
<table class="other"><tr><td>no</td></tr></table>
<table class="grid wide"><thead><tr><td>head</td></tr></thead><tbody>
<tr><td><p><b>Group A</b></p></td><td></td></tr>
<tr><td>Tourist<br>visit</td><td> B-2 </td>
<tr><td>plain</td><td><b>B-1</b></td></tr></tbody></table>
<h4 class="cap">Second</h4><table class="grid"><tr><td>x<table class="grid"><tr><td>in</td></tr></table></td></tr>"""


def test_html_rows(spark):
    pages = spark.createDataFrame([(7, PAGE), (8, None), (9, "no table")], "id long, html string")
    found = html.html_rows(pages, "id", "html", "grid", ("h4", "cap")).orderBy("table_no", "row_no").collect()
    assert [tuple(r) for r in found] == [
        (7, "First & one", 0, 0, ["Group A", ""], True),
        (7, "First & one", 0, 1, ["Touristvisit", "B-2"], False),
        (7, "First & one", 0, 2, ["plain", "B-1"], False),
        (7, "Second", 1, 0, ["xin"], False),
    ]


def test_html_elements(spark):
    pages = spark.createDataFrame(
        [(1, "<ul><li><a>one</a></li><li class='z'> two </li></ul><h1>T &lt; U</h1><li>open")], "id int, html string")
    found = html.html_elements(pages, "id", "html", ["li", "h1"]).orderBy("tag", "element_no").collect()
    assert [tuple(r) for r in found] == [(1, "h1", 0, "T < U"), (1, "li", 0, "one"), (1, "li", 1, "two"),
                                         (1, "li", 2, "open")]
    assert html.html_elements(pages, "id", "html", ["li"], "z").collect()[0]["text"] == "two"


def test_html_open_items_end_where_the_next_begins(spark):
    page = "<ul><li>a<li>b<ul><li>c</ul>d<li>e</ul><p>f<p>g<h1>h</h1><table><tr><td>x<td>y<tr><td>z</table>"
    pages = spark.createDataFrame([(1, page)], "id int, html string")
    found = html.html_elements(pages, "id", "html", ["li", "p", "td"]).orderBy("tag", "element_no").collect()
    assert [r["text"] for r in found] == ["a", "bcd", "c", "e", "f", "g", "x", "y", "z"]


@pytest.mark.parametrize("page", [
    "<li>x" * 200_000, '<li a="' * 140_000, '<li><a b=">" ' * 70_000 + '<a b="', "<" * 1_000_000, "<ul><li>" * 120_000])
def test_html_of_a_hostile_page_takes_linear_time(page):
    started = time.process_time()
    list(html._elements(page, frozenset(["li"]), None))
    html._table_rows(page, None, ("h4", None))
    assert time.process_time() - started < 12


def test_html_odd_markup(spark):
    page = """<!DOCTYPE html><?x y?><!-- <li>no</li> --><script>if (a<li) "<li>no</li>"</script>
      <LI title="a > b">1 < 2 &lt; 3 &amp x</LI><style>li{}</style><li>open <b>bold</b><li>next</li>
      <table class='a grid'><tfoot><tr><td>foot</tr></tfoot><tr><td>x<br/>y<td>z</table>
      <table class=grid><tbody><tr></tr><tr><td><b>H</b></table><table><tr><td>none</table><h4 class=cap>late"""
    pages = spark.createDataFrame([(1, page)], "id int, html string")
    found = html.html_elements(pages, "id", "html", ["li"]).orderBy("element_no").collect()
    assert [r["text"] for r in found][:1] == ["1 < 2 < 3 & x"] and len(found) == 3
    assert found[1]["text"].startswith("open bold") and found[2]["text"] == "next"
    cells = html.html_rows(pages, "id", "html", "grid", ("h4", "cap")).orderBy("table_no", "row_no").collect()
    assert [tuple(r)[1:] for r in cells] == [("late", 0, 0, ["xy", "z"], False), (None, 1, 0, ["H"], True)]


def test_literal_table(spark, rows):
    found = tables.literal_table(spark, [*schema.MODE_ROWS, (None, "none")], schema.MODE)
    assert rows(found)[:4] == list(schema.MODE_ROWS) and rows(found)[4] == (None, "none")
    assert [f.dataType for f in found.schema] == [f.dataType for f in schema.MODE]
    assert tables.literal_table(spark, [], schema.MODE).count() == 0


def grid(body):
    return [r[3] for r in html._table_rows(f"<table><tbody>{body}</tbody></table>", None, None)]


@pytest.mark.parametrize("body, wanted", [
    ("<tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr>", [["a", "b"], ["a", "c"]]),
    ("<tr><td>a</td><td rowspan='2'>b</td></tr><tr><td>c</td></tr><tr><td>d</td><td>e</td></tr>",
     [["a", "b"], ["c", "b"], ["d", "e"]]),
    ("<tr><td colspan=2>a</td><td>b</td></tr><tr><td>c</td><td>d</td><td>e</td></tr>", [["a", "", "b"], ["c", "d", "e"]]),
    ("<tr><td ROWSPAN=\"2\" colspan=\"2\">a</td><td>b</td></tr><tr><td>c</td></tr>", [["a", "", "b"], ["a", "", "c"]]),
    ("<tr><td rowspan=0>a</td><td>b</td></tr><tr><td>c</td></tr><tr><td>d</td></tr>", [["a", "b"], ["a", "c"], ["a", "d"]]),
    ("<tr><td>a</td><td>b</td><td rowspan=2>c</td></tr><tr><td>d</td></tr>", [["a", "b", "c"], ["d", "", "c"]]),
    ("<tr><td rowspan=2>a</td><td>b</td></tr></tbody><tbody><tr><td>c</td></tr>", [["a", "b"], ["c"]]),
    ("<tr><td rowspan=3>a</td><td>b</td></tr><tr></tr><tr><td>c</td></tr><tr><td>d</td></tr>", [["a", "b"], ["a", "c"], ["d"]]),
    ("<tr><td rowspan=x colspan=-1>a</td></tr><tr><td>b</td></tr>", [["a"], ["b"]]),
    ("<tr><td>a<td>b<tr><td>c <table><tr><td rowspan=2>in</td></tr></table></td></tr>", [["a", "b"], ["c in"]]),
])
def test_spanned_cells(body, wanted):
    assert grid(body) == wanted


def test_only_the_first_column_of_its_own_row_makes_a_header():
    page = "<table><tr><td rowspan=2><b>g</b></td><td>x</td></tr><tr><td><b>y</b></td></tr></table>"
    assert [(r[3], r[4]) for r in html._table_rows(page, None, None)] == [(["g", "x"], True), (["g", "y"], False)]


@pytest.mark.parametrize("depth", [700, 1500, 3000])
def test_deep_pages_keep_all_text(depth):
    page = "".join(f"<div>{i} " for i in range(depth)) + "</div>" * depth
    found = list(html._elements(page, frozenset(["div"]), None))
    assert len(found) == depth and all(text for *_, text in found[::97])
    assert found[-1] == ("div", depth - 1, str(depth - 1))
    assert found[-2][2] == f"{depth - 2} {depth - 1}"


def test_open_items_below_many_elements_take_linear_time():
    page = "<ul><li>" + "<div>" * 50_000 + "<ul>" + "<div>" * 50_000 + "<li>x</li>" * 50_000
    started = time.perf_counter()
    assert sum(1 for _ in html._elements(page, frozenset(["li"]), None)) == 50_001
    assert time.perf_counter() - started < 20


def test_pages_of_one_file_go_to_many_tasks(spark, tmp_path):
    pages = spark.range(400).selectExpr("id", "'<table><tr><td>a</td></tr></table>' html").coalesce(1)
    pages.write.parquet(str(tmp_path / "pages"))
    found = html.html_rows(spark.read.parquet(str(tmp_path / "pages")), "id", "html")
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.count() == 400 and max(r["count"] for r in sizes) < 100


ODD_TAGS = ["<", ">", '"', "'", "=", " ", "a", "li", "<a", "</a>", "<li ", '="', "='", 'b="x"', "<!--", "-->", "&amp;",
            "<script>", "</script>", '<a href="x>y" b=\'"\'>', "= \"y\"", "<br/>", "a=5", "<A"]


def test_the_short_way_through_tags_equals_the_long_way(monkeypatch):
    chosen = random.Random(3)
    pages = ["".join(chosen.choices(ODD_TAGS, k=chosen.randint(1, 25))) for _ in range(20_000)]
    found = [list(markup.scan(page)) for page in pages]
    monkeypatch.setattr(markup, "_MISSES", 0)
    assert found == [list(markup.scan(page)) for page in pages]


def test_hostile_attributes_take_linear_time():
    for page in ("<a b='<a \"" * 150_000 + ">", '<a b="<a =\'" ' * 100_000 + ">", "<a b=\"" + "x" * 10 ** 6 + "<a " * 100_000 + ">"):
        started = time.process_time()
        list(markup.scan(page))
        assert time.process_time() - started < 12
