"""Quality, toxicity, vectors, pages, pieces, totals and the pipeline."""

import random
import re
import sys

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from starloom.llm import main_text, near_vectors, pieces, quality, rollup, toxicity
from starloom.llm.main_text import main_texts, page_text
from starloom.session import stage as stored
from starloom.sources.markup import scan
from tests.conftest import SMALL, plan
from tests.llm.helpers import ODD, components, documents

MIDDLE = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    found = entry.queries()["op2_quality_rules"](spark, MIDDLE)
    held = found.join(labels, "doc_id").where("held_out").select("predicted", "quality").toPandas()
    assert found.count() == 1000 and (held.predicted == held.quality).mean() > 0.93
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_quality_rules_are_columns(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_rules(docs, labels)
    assert model.rules and all(w for _, w in model.rules)
    row = {s: 0.5 for s in quality.STATISTICS}
    total = model.intercept + sum(w for r, w in model.rules if all(
        row[s] <= t if sign == "<=" else row[s] > t for s, sign, t in r))
    got = spark.createDataFrame([row]).select(model.score()).first()[0]
    assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_odd_rows(spark):
    docs = documents(spark, [*enumerate(ODD), (3, "again"), (None, "x")])
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    constant = quality.fit_rules(docs, none)
    assert {r.score for r in quality.quality_scores(docs, constant).collect()} == {0.5}
    one = quality.fit_rules(docs, spark.createDataFrame([(3, 1), (4, 1)], "doc_id long, quality int"))
    assert not one.rules and quality.quality_scores(docs, one).where("predicted = 1").count() == len(ODD) + 2
    assert quality.quality_scores(docs.limit(0), one).count() == 0
    kept = quality.keep_good(docs, one)
    assert kept.columns == docs.columns and kept.count() == len(ODD) + 2


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels.where("doc_id % 3 != 1"))
    assert list(model.thresholds) == sorted(model.thresholds) and len(set(model.thresholds)) == 3
    held = toxicity.toxicity_scores(docs, model).withColumnRenamed("toxic", "found").join(
        labels.where("doc_id % 3 = 1"), "doc_id").toPandas()
    assert held.found[held.toxic == 0].mean() < 0.02 and held.found[held.toxic == 1].mean() > 0.8
    assert held.severity.between(0, 3).all()


def test_ordinal_fit_orders_grades():
    rows = [[0]] * 30 + [[1]] * 30 + [[2]] * 30 + [[]] * 30
    grades = np.array([1] * 30 + [2] * 30 + [3] * 30 + [0] * 30)
    weights, thresholds = toxicity.fit_ordinal(rows, grades, 3, 3)
    assert weights[0] < weights[1] < weights[2] and (np.diff(thresholds) > 0).all()


def test_toxicity_odd_rows(spark):
    docs = documents(spark, [*enumerate(ODD), (3, "again"), (None, "x")], more=("toxic", "grade"))
    model = toxicity.fit_toxicity(docs, spark.createDataFrame([(3, 0), (4, None)], "doc_id long, toxic int"))
    found = toxicity.toxicity_scores(docs, model).collect()
    assert len(found) == len(ODD) + 2 and not any(r.toxic for r in found)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(ODD) + 2
    assert toxicity.toxicity_scores(docs.limit(0), model).count() == 0


def _vectors():
    r = np.random.default_rng(4)
    base = r.normal(size=(60, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 20] + r.normal(size=16) * 0.12).tolist()) for i in range(120)]
    rows += [(300 + i, base[0].tolist()) for i in range(30)] + [(400, (base[0] * 7).tolist())]
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [1.0] * 3),
             (505, [None] + [1.0] * 15), (506, [float("inf")] + [1.0] * 15)]
    return rows


@pytest.mark.parametrize("block,per_cell", [(512, 500), (8, 15)])
def test_vectors_against_brute_force(spark, monkeypatch, block, per_cell):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    rows = _vectors()
    good = {i: np.array(v, dtype=float) for i, v in rows if i < 500}
    linked = [(i, j) for i in good for j in good
              if i < j and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= 0.95]
    name = components([i for i, _ in rows], linked)
    n = {i: 0 for i, _ in rows}
    for i, j in linked:
        n[i] += 1
        n[j] += 1
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS weight")
    found = near_vectors.near_vector_links(frame, per_cell=per_cell, reach=None)
    assert sorted(map(tuple, found.collect())) == sorted((i, n[i], name[i], name[i] == i) for i, _ in rows)
    assert near_vectors.near_vector_links(frame.limit(0)).count() == 0
    assert [tuple(r) for r in near_vectors.near_vector_links(frame.where("vec_id = 500")).collect()] == [(500, 0, 500, True)]


@pytest.mark.parametrize("sampled", [20_000, 40])
def test_vectors_of_several_lengths(spark, monkeypatch, sampled):
    monkeypatch.setattr(near_vectors, "SAMPLE_VECTORS", sampled)
    r, rows = np.random.default_rng(6), []
    for size, many in ((16, 60), (8, 40), (5, 3)):
        base = r.normal(size=(20, size))
        rows += [(1000 * size + i, (base[i % 20] * (1 + i // 20) + r.normal(size=size) * 0.05).tolist()) for i in range(many)]
    rows += [(9000 + i, [1.0, 2.0, float(i // 2)]) for i in range(4)]
    good = {i: np.array(v) for i, v in rows}
    linked = [(i, j) for i in good for j in good if i < j and len(good[i]) == len(good[j])
              and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= 0.95]
    name, n = components(good, linked), dict.fromkeys(good, 0)
    for pair in linked:
        for i in pair:
            n[i] += 1
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = near_vectors.near_vector_links(frame, per_cell=15, reach=None)
    assert sorted(map(tuple, found.collect())) == sorted((i, n[i], name[i], name[i] == i) for i in good)


def test_vectors_recall_with_the_narrow_reach(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.array([v for v in table.toPandas().embedding], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    wanted = int((x @ x.T >= 0.95).sum()) - len(x)
    found = near_vectors.near_vector_links(table, per_cell=50).agg(F.sum("n_links")).first()[0]
    assert wanted * 0.99 <= found <= wanted


PAGE = """<html><head><title>t</title><script>var x="</p><p>no";</script></head><body><nav><a href=/>Home</a></nav>
<div>Our site offers all you need every day</div><p>{}<p>Second&nbsp; &amp; last<br>line</body>"""


def test_main_text_deletes_what_recurs_on_a_host(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(f"Story number {i}")) for i in range(30)]
    rows += [(100, "http://b.example/1", PAGE.format("Alone")), (101, None, None), (None, "x", ""), (30, "http://a.example/0", rows[0][2])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS key", "2 AS host")
    found = {r.page_id: r for r in main_texts(frame).collect()}
    assert found[3].text == "Story number 3"
    assert found[100].text == "Our site offers all you need every day\nAlone\nSecond & last line"
    assert found[101].text == "" and found[None].text == "" and all(r.n_chars == len(r.text) for r in found.values())
    assert main_texts(frame.limit(0)).count() == 0


def test_main_text_of_copies_and_mirrors(spark):
    article = "<div class=w><article><h1>Shared</h1><p>One story of many words</article></div>"
    links = "<main><ul><li><a href=/1>One long link</a><li><a href=/2>Another long link</a></ul></main>"
    plain = "<div class=c><p>Plain prose without any content element, long enough to matter</p><p>Its end of it</p></div>"
    rows = [(i, "http://a.example/1", f"<html><body>{article}</body></html>") for i in range(5)]  # stored again
    rows += [(10 + i, f"http://b.example/{i}", f"<html><body>{article}<p>Chrome {i}</p></body></html>") for i in range(6)]
    rows += [(20 + i, f"http://c.example/{i}", f"<html><body>{links}<p>Chrome {i}</p></body></html>") for i in range(6)]
    rows += [(30 + i, f"http://d.example/{i}", f"<html><body>{plain}</body></html>") for i in range(6)]  # mirrors
    rows += [(40 + i, f"http://e.example/{i}", f"<html><body>{plain}<i>{i}</i></body></html>") for i in range(6)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    prose = "Plain prose without any content element, long enough to matter\nIts end of it"
    wanted = {0: "Shared\nOne story of many words", 1: "Shared\nOne story of many words",
              2: "One long link\nAnother long link", 3: prose}
    for r in main_texts(frame).collect():
        assert r.text == wanted.get(r.page_id // 10, f"{prose}\n{r.page_id % 10}"), r


def test_main_text_of_one_page():
    page = """<body><header><h1>Site</h1></header><div class="cookie-notice">c</div><main><article><header><h1>T &lt;1&gt;</h1>
    </header><p>one\n two<p>three<ul><li>a<li>b</ul><!-- <p>no --><div class="comments"><p>bad</div><table><tr><td>x<td>y
    </table><form>f</form><p hidden>h</p><p>a &lt; b</article><aside>s</aside></main><footer>f</footer>"""
    assert page_text(page, set()) == "T <1>\none two\nthree\na\nb\nx\ny\na < b"
    assert page_text("plain < text & more", set()) == "plain < text & more"


def test_main_text_equals_the_articles(spark):
    docs = {r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("text").collect()}
    found = entry.queries()["op1_main_text"](spark, MIDDLE).collect()
    assert len(found) == 250 and all(r.text.partition("\n")[2] in docs for r in found)


@pytest.mark.parametrize("page", [
    "<p>" * 30000 + "<b>x" * 30000, '<a href="' * 60000, "<ul>" + "<li>a" * 60000, '<a b=">" ' * 30000 + '<a b="', "<" * 300000,
    "<!--" * 100000, "<script>" * 50000, "<p><button>" + "<b>" * 20000 + "<h1>x" * 20000])
def test_main_text_of_hostile_pages_takes_linear_time(page):
    assert isinstance(page_text(page, set()), str)


def plain_score(text):
    """Best sum of scores, from the vocabulary file alone, a place at a time."""
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)
    special = {i for i in range(model.get_piece_size()) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if i not in special}
    longest, bare, reached = max(map(len, scores)), min(scores.values()) - 10, [0.0]
    for j in range(1, len(text) + 1):
        ways = [reached[i] + scores[text[i:j]] for i in range(max(0, j - longest), j) if text[i:j] in scores]
        reached.append(max([*ways, *([] if text[j - 1] in scores else [reached[j - 1] + bare])]))
    return reached[-1]


def test_pieces_against_one_pass(spark):
    r = random.Random(1)
    texts = [t for t in ODD if t] + ["".join(r.choice("abcde  \n") for _ in range(900)), "a" * 700, "x" + " " * 300 + "y",
                                     "thnertionble" * 60]
    rows = [*enumerate(texts), (700, None), (701, ""), (None, "nobody"), (3, "again")]
    vocabulary = pieces.vocabulary(pieces.VOCABULARY)
    for chunk in (13, 64):
        encoded = pieces.encode_pieces(documents(spark, rows), chunk=chunk)
        found = {}
        for row in pieces.decode_pieces(encoded).orderBy("chunk").collect():
            found.setdefault(row.doc_id, []).append(row)
        for i, text in enumerate(texts):
            if i != 3:
                whole = pieces.marked(text)
                score, _ = vocabulary.best(whole, 0, len(whole))
                assert sum(p.score for p in found[i]) == pytest.approx(score[-1], abs=1e-3)
                if chunk == 13 and len(whole) < 3000:
                    assert score[-1] == pytest.approx(plain_score(whole), abs=1e-3)
                assert pieces.unmarked("".join(p.decoded for p in found[i])) == text.replace("▁", " ")
        assert [p.n_ids for p in found[700] + found[701]] == [0, 0] and len(found[3]) >= 2 and found[None]
    assert pieces.encode_pieces(documents(spark, rows).limit(0)).count() == 0


def test_pieces_round_trip_of_all_documents(spark):
    assert entry.queries()["op6_piece_scan"](spark, MIDDLE).where("NOT round_trip").count() == 0


def test_rollup_is_signed_and_idempotent(spark, tmp_path):
    total = rollup.Rollup(spark, str(tmp_path / "r"))
    assert total.totals().count() == 0

    def events(*rows):
        return spark.createDataFrame(list(rows), rollup.EVENTS).selectExpr("*", "1 AS live", "2 AS version")

    def totals():
        return sorted(((r.source or "", r.lang or "", r.tokenizer, r.documents, r.tokens) for r in total.totals().collect()))

    one = events(("insert", 1, "a", "en", "t", 10, 0), ("insert", 2, "a", "en", "t", 5, 0), ("insert", 3, None, None, "t", None, 0),
                 ("insert", None, "a", "en", "t", 99, 0), ("insert", 2, "a", "en", "t", 7, 1), ("insert", 1, "a", "en", "u", 4, 0))
    assert total.apply("one", one) and not total.apply("one", one)
    assert totals() == [("", "", "t", 1, 0), ("a", "en", "t", 2, 17), ("a", "en", "u", 1, 4)]
    two = events(("revise", 1, "b", "en", "t", 12, 0), ("delete", 2, None, None, "t", None, 0), ("delete", 77, "a", "en", "t", 1, 0))
    assert total.apply("two", two)
    assert totals() == [("", "", "t", 1, 0), ("a", "en", "u", 1, 4), ("b", "en", "t", 1, 12)]
    assert total.apply("three", events(("insert", 2, "a", "en", "t", 3, 0), ("delete", 2, "a", "en", "t", 3, 1)))
    assert total.apply("none", one.limit(0)) and len(total.commits()) == 4
    assert totals() == [("", "", "t", 1, 0), ("a", "en", "u", 1, 4), ("b", "en", "t", 1, 12)]


def test_rollup_query_equals_a_plain_sum(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    docs["tokens"] = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in docs.text]
    wanted = docs.groupby(["source", "lang"]).tokens.agg(["size", "sum"])
    found = entry.queries()["op5_token_rollup"](spark, SMALL).collect()
    assert sorted((r.source, r.lang, r.documents, r.tokens) for r in found) == sorted(
        (s, g, int(n), int(t)) for (s, g), n, t in wanted.itertuples())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "exact dedup", "near dedup", "packing"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), "test")
        assert docs.columns == columns
        assert docs.count() < before, name
        before = docs.count()
    clean = labels.where("quality = 1 AND toxic = 0")
    assert docs.join(clean, "doc_id").count() > 0
    assert docs.groupBy("text").count().where("count > 1").count() == 0
    packed = corpus_pipeline.packing(spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == before
    assert "CartesianProduct" not in plan(packed)


def test_matrices_search_the_ends_of_a_chunk_only(monkeypatch):
    vocabulary = pieces.Vocabulary(pieces.VOCABULARY)
    text = pieces.marked("some words of a text that is cut " * 20)
    size = 400

    def all_of_it(part):
        raise AssertionError("searched by itself, and again when the chunk is traced")

    monkeypatch.setattr(vocabulary, "whole", all_of_it)
    step = vocabulary.matrix(text[:size + vocabulary.longest], size)
    for enter in range(3):
        score, _ = vocabulary.best(text[:size + vocabulary.longest], enter, size)
        wanted = np.array(score[size:size + vocabulary.longest])
        known = np.isfinite(wanted)
        assert (np.isfinite(step[enter]) == known).all()
        assert np.ptp(wanted[known] - step[enter][known]) < 1e-9  # but for a constant, that of the words between


def test_groups_of_matrices_go_over_batches():
    rows = pd.DataFrame([(row, at, bytes([row])) for row in range(3) for at in range(150)], columns=["row", "at", "matrix"])
    for size in (1, 7, 64, 450):
        batches = iter([rows[i:i + size] for i in range(0, len(rows), size)])
        found = [x for some in pieces._groups(batches, lambda g: [(g[0][0], g[0][1], g[-1][1], len(g))]) for x in some]
        assert found == [(row, *part) for row in range(3) for part in ((0, 63, 64), (64, 127, 64), (128, 149, 22))]
    assert list(pieces._groups(iter([]), len)) == [[]]


def test_a_page_is_walked_once_for_its_text(monkeypatch):
    walked = []
    monkeypatch.setattr(main_text, "scan", lambda page: walked.append(page) or scan(page))
    page = ("<body><header>top</header><div class='ad x'>buy</div><p>one <b>bold</b><br>two<p>three<hr>four"
            + "<div>" * 600 + "deep<p>deeper" + "</div>" * 600 + "<nav><a>menu</a></nav></body>")
    assert main_text.page_text(page, set()) == "one bold two\nthree\nfour\ndeep\ndeeper" and len(walked) == 1
    inside = "<nav>n</nav><article><header>head</header>text<aside>a</aside></article>outside"
    assert main_text.page_text(inside, set()) == "head\ntext"


def test_pieces_keep_one_worker_for_each_task(spark):
    """One vocabulary and one cache of words a task: encoding and digests aren't mapInPandas on mapInPandas."""
    found = plan(entry.queries()["op6_piece_scan"](spark, SMALL))
    assert len(re.findall(r"^\(\d+\) MapInPandas", found.partition("== Initial Plan ==")[0], re.MULTILINE)) == 2  # whole and cut
    rows = [*enumerate(t for t in ODD if t), (700, None), (701, ""), (None, "nobody"), (3, "again"), (3, "again")]
    frame = documents(spark, rows)
    for chunk in (13, pieces.CHUNK):
        apart = pieces.encode_pieces(frame, chunk=chunk).mapInPandas(pieces.ids_crc32, pieces.DIGESTS)
        at_once = pieces.encode_pieces(frame, chunk=chunk, then=pieces.ids_crc32, fields=pieces.DIGESTS)
        assert sorted(map(repr, at_once.collect())) == sorted(map(repr, apart.collect()))
        assert at_once.where("NOT round_trip").count() == 0 and at_once.count() >= len(rows)
        nobody = pieces.encode_pieces(frame.limit(0), chunk=chunk, then=pieces.ids_crc32, fields=pieces.DIGESTS)
        assert nobody.count() == 0


def test_pieces_take_a_batch_in_parts(monkeypatch):
    monkeypatch.setattr(pieces, "PART", 100)
    texts = [None, "", "a" * 30, "b" * 60, "c" * 30, "d" * 1000, None, "e" * 10]
    batch = pd.DataFrame({"doc_id": range(8), "text": texts})
    found = list(pieces._parts(iter([batch, batch.iloc[:0], batch.iloc[:2]])))
    assert [list(p.doc_id) for p in found] == [[0, 1, 2, 3], [4], [5, 6, 7], [], [0, 1]]
    assert [t for p in found for t in p.text] == [*texts, None, ""]
    assert all(list(p.index) == list(range(len(p))) for p in found)


def test_remembered_words_are_bounded_by_their_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "_KEPT", 20_000)
    vocabulary = pieces.Vocabulary(pieces.VOCABULARY)
    texts = [pieces.marked(f"{chr(0x4E00 + i) * 60} w{i}") for i in range(500)]
    found = [vocabulary.whole(t) for t in texts]
    held = sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in vocabulary.words.items())
    assert 10_000 < held < 21_000
    assert found == [vocabulary.whole(t) for t in texts] and all(vocabulary.decode(i) == t for (_, i), t in zip(found, texts, strict=True))
