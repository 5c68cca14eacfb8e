"""Cases that operators once got wrong: other white space, marked wrappers, deep pages, shared identifiers, two writers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import main_text
from starloom.llm.exact import exact_groups
from starloom.llm.labelled import labelled_texts
from starloom.llm.main_text import main_texts, page_text
from starloom.llm.near_vectors import near_vector_links
from starloom.llm.quality import RuleModel, STATISTICS, _statistics, fit_rules, quality_scores
from starloom.llm.rollup import Overtaken, Rollup
from starloom.llm.toxicity import fit_toxicity
from starloom.session import scratch_path
from tests.conftest import plan
from tests.llm.helpers import ODD, components, documents

OTHER_WHITE = [" ", "　", "\u0085", " ", "\x1c", " \n　", "   "]
LONG = "Some sentence of the article that is long enough to matter here. " * 6


@pytest.mark.parametrize("text", [*ODD, *OTHER_WHITE])
def test_statistics_of_odd_texts_are_finite(text):
    found = _statistics(text)
    assert len(found) == len(STATISTICS) and np.isfinite(found).all()


def test_quality_of_texts_of_other_white_space(spark):
    found = quality_scores(documents(spark, list(enumerate([*ODD, *OTHER_WHITE]))), RuleModel(0.0, ()))
    assert found.count() == len(ODD) + len(OTHER_WHITE) and found.where("score = 0.5").count() == found.count()


def test_rules_do_not_depend_on_the_partitions(spark):
    rows = [(i, ("word " * (i % 17 + 1) + "UP! $ ") * (i % 3 + 1)) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    docs = documents(spark, rows)
    assert fit_rules(docs.repartition(7), labels) == fit_rules(docs.repartition(2), labels)


def test_an_identifier_is_learnt_from_once(spark, rows):
    docs = documents(spark, [(1, "b"), (1, "a"), (2, None), (3, "x")] + [(1, f"c{i}") for i in range(500)])
    sample = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    assert rows(labelled_texts(docs, sample)) == [(1, 1, "a"), (2, 0, None)]
    assert fit_toxicity(docs, sample.withColumnRenamed("label", "toxic"), rows=100).weights == {}


@pytest.mark.parametrize("page", [
    '<body><div class="site has-sidebar"><article><p>{}</p></article></div></body>',
    '<body class="page-modal-closed"><div class="no-sidebar"><article><p>{}</p></article></div></body>',
    '<form action="x"><div id="page"><main><p>{}</p></main></div></form>',
    '<div class="social-science"><p>{}</p></div>',
    '<div class="site has-sidebar"><div class="no-comments"><article><p>{}</p></article></div></div>',
])
def test_a_mark_takes_no_page_away(page):
    assert page_text(page.format(LONG), set()) == LONG.strip()


def test_marked_parts_still_go():
    page = (f'<body><article><p>{LONG}</p></article><div class="comments"><article>first! {LONG}</article></div>'
            '<form>name</form><div class="sidebar">links</div></body>')
    assert page_text(page, set()) == LONG.strip()
    page = f'<div><p>{LONG}</p></div><article>A teaser</article>'
    assert page_text(page, set()) == f"{LONG.strip()}\nA teaser"


@pytest.mark.parametrize("depth", [20, 511, 600, 3000])
def test_deep_pages_lose_their_menus_only(depth):
    page = "<article>" + "<div>" * depth + "<nav>Menu</nav><p>one</p><aside>x<b>y</b></aside><p>two</p>" + "</div>" * depth
    assert page_text(page + "</article><p>after</p>", set()) == "one\ntwo"


@pytest.mark.parametrize("listed", [main_text.LISTED, 0])
def test_a_template_does_not_depend_on_the_size_of_the_host(spark, monkeypatch, listed):
    monkeypatch.setattr(main_text, "LISTED", listed)  # 0: pages meet their templates by a join
    notice = "<div class='box'>The same notice on some pages of a site</div>"
    for others in (10, 150):
        pages = [(i, f"http://h/{i}", f"<body>{notice if i < 5 else ''}<div><p>{LONG} number {i}</p></div></body>")
                 for i in range(others)]
        found = main_texts(spark.createDataFrame(pages, "page_id long, url string, html string"))
        assert found.where("text LIKE '%notice%'").count() == 0 and found.where("n_chars > 100").count() == others


def brute_vectors(given):
    valid = [(i, np.array(v, dtype=float)) for i, v in given if v is not None and i is not None and any(v)]
    linked = [(a, b) for a, (_, x) in enumerate(valid) for b, (_, y) in enumerate(valid)
              if a != b and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95]
    names = components({i for i, _ in given if i is not None}, [(valid[a][0], valid[b][0]) for a, b in linked])
    out = [(i, sum(a == k for a, _ in linked), names[i], names[i] == i) for k, (i, _) in enumerate(valid)]
    rest = [(i, v) for i, v in given if v is None or i is None or not any(v)]
    return sorted([*out, *((i, 0, names.get(i), i is None or names[i] == i) for i, _ in rest)], key=repr)


@pytest.mark.parametrize("given", [
    [(3, [1, 0, 0]), (5, [1, 0, 0]), (5, [0, 1, 0]), (9, [0, 1, 0])],
    [(5, [1, 0, 0]), (5, [0, 1, 0]), (7, [1, 0.01, 0])],
    [(1, [1, 0, 0]), (2, [1, 0, 0]), (2, None), (2, [0, 0, 0]), (4, None), (None, [1, 0, 0]), (None, None), (2, [0, 0, 1])],
])
def test_vectors_that_share_an_identifier(spark, rows, given):
    frame = spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in given],
                                  "vec_id long, embedding array<double>")
    assert rows(near_vector_links(frame), "vec_id", "n_links", "component_id", "kept") == brute_vectors(given)


def test_two_writers_commit_a_batch_once(spark, monkeypatch):
    folder = scratch_path(spark, "rollup")
    events = spark.createDataFrame([("insert", 1, "s", "en", "t", 10, 1)],
                                   "op string, doc_id long, source string, lang string, tokenizer string, tokens long, seq long")
    slow, fast = Rollup(spark, folder), Rollup(spark, folder)
    commit = slow._commit

    def late(number, batch, attempt):
        assert fast.apply(batch, events)
        commit(number, batch, attempt)

    monkeypatch.setattr(slow, "_commit", late)
    with pytest.raises(Overtaken):
        slow.apply("b1", events)
    assert not slow.apply("b1", events)
    assert [tuple(r) for r in slow.totals().collect()] == [("s", "en", "t", 1, 10)]


def test_exact_groups_come_from_sorted_neighbours(spark, rows):
    docs = documents(spark, [(i % 40, f"text {i % 3}") for i in range(200)] + [(None, "text 0"), (7, None), (7, "")])
    found = exact_groups(docs, salts=5)
    sizes = {r["text_sha256"]: r["group_size"] for r in found.collect()}
    assert sorted(sizes.values()) == [2, 66, 67, 68]
    assert found.where("kept").count() == 4
    shown = plan(found)
    assert "_place" in shown and "MapInArrow" not in shown
    assert found.where(F.col("kept") & (F.col("doc_id") != F.col("keep_id"))).count() == 0
