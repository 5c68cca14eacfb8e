"""Copies, near copies, packing, likelihood: against brute force, on odd rows, empty tables and hot groups."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from starloom import session
from starloom.llm import components as graph
from starloom.llm import lattice, near_text, packing
from starloom.llm.components import connected_components
from starloom.llm.exact import drop_exact, exact_groups
from starloom.llm.shingles import shingle_set
from starqueries.compare import actual, connect, expected
from tests.conftest import SMALL, plan
from tests.llm.helpers import ODD, components, documents, shingles, variants, words


@pytest.mark.parametrize("name", ["op3_near_dedup", "op4_near_vectors", "op9_exact_dedup"])
def test_queries_equal_their_sql(spark, name):
    assert actual(entry.queries()[name](spark, SMALL)) == expected(connect(SMALL), entry.oracle_sql()[name])


def test_exact_groups(spark):
    texts = [*ODD, *["hot"] * 200, "Hot", "hot "]
    frame = exact_groups(documents(spark, list(enumerate(texts))), salts=4)
    by_text = {}
    for i, t in enumerate(texts):
        by_text.setdefault(t or "", []).append(i)
    wanted = sorted((i, max(by_text[t or ""]), len(by_text[t or ""]), i == max(by_text[t or ""]),
                     hashlib.sha256((t or "").encode()).hexdigest()) for i, t in enumerate(texts))
    assert sorted(map(tuple, frame.collect())) == wanted
    assert not any(n in plan(frame) for n in ("Python", "Pandas", "Arrow"))


def test_exact_repeated_rows_nulls_and_no_rows(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (2, "c")]
    frame = exact_groups(documents(spark, rows))
    assert sorted(((r.doc_id or 0), r.keep_id or 0, r.group_size, r.kept) for r in frame.collect()) == [
        (0, 0, 1, True), (0, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True), (2, 2, 1, True)]
    docs = documents(spark, rows)
    kept = drop_exact(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [
        (0, "b"), (1, "a"), (2, "c")]
    assert exact_groups(docs.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (5, 4)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def _plans_of_stages(monkeypatch, module):
    """The plan of each table that the module stores, by its label."""
    plans = {}

    def kept(df, label):
        plans.setdefault(label, []).append(plan(df))
        return session.stage(df, label)

    monkeypatch.setattr(module, "stage", kept)
    return plans


def test_components_of_many_links_are_not_copied_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(graph, "COPIED_LINKS", 40)
    plans = _plans_of_stages(monkeypatch, graph)
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.node: r.component for r in connected_components(links).collect()} == {
        **dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert "SortMergeJoin" in plans["links"][1] and "BroadcastHashJoin" not in plans["links"][1]


def _near_wanted(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    linked = [(i, j) for n, (i, a) in enumerate(sets) for j, b in sets[:n]
              if a and b and 100 * len(a & b) >= 75 * len(a | b)]
    name = components([i for i, _ in rows], linked)
    return sorted((i, len(s), name[i], name[i] == i) for i, s in sets)


def test_near_text_against_brute_force(spark):
    texts = [*ODD, *variants(1, 120), *variants(2, 60, edits=14), *variants(3, 40, 12, 2)]
    rows = list(enumerate(texts, start=10))
    frame = near_text.near_text_components(documents(spark, rows))
    assert sorted(map(tuple, frame.collect())) == _near_wanted(rows)


def test_near_text_in_blocks_of_two(spark, monkeypatch):
    monkeypatch.setattr(near_text, "BLOCK", 2)
    rows = list(enumerate(variants(5, 60, edits=12)))
    assert sorted(map(tuple, near_text.near_text_components(documents(spark, rows)).collect())) == _near_wanted(rows)


def test_near_text_joins_do_not_go_by_guessed_sizes(spark, monkeypatch):
    """A set has 40 keys, which the optimizer takes for one row: at 0.6 GB it collected 9.6 million on the driver."""
    plans = _plans_of_stages(monkeypatch, near_text)
    rows = list(enumerate(variants(7, 40, edits=12)))
    assert sorted(map(tuple, near_text.near_text_components(documents(spark, rows)).collect())) == _near_wanted(rows)
    for label in ("buckets", "hubs", "open"):
        assert all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in plans[label]), label


def test_near_text_same_identifier_null_identifier_no_rows(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a), (5, b), (7, a), (9, b), (None, a), (11, "else")]
    docs = documents(spark, rows)
    found = sorted(((r.doc_id or 0), r.component_id or 0, r.kept) for r in near_text.near_text_components(docs).collect())
    assert found == [(0, 0, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (11, 11, True)]
    kept = near_text.drop_near(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 5, 5, 11]
    assert near_text.near_text_components(docs.limit(0)).count() == 0


def test_shingles_count_like_the_definition():
    for text in [*ODD, *variants(4, 5)]:
        assert len(shingle_set(text)) == len(shingles(text))


def _check_packing(rows, found):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter()
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start:start + 2048], dtype="<u4")
            wanted[(i, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places)


def test_packing_keeps_every_token_in_place(spark):
    texts = [*ODD, *["same words here"] * 50, "long words " * 3000, *variants(6, 40, 300)]
    rows = [*enumerate(texts), (3, "again"), (3, "again"), (None, "nobody")]
    found = packing.pack_documents(documents(spark, rows)).collect()
    count = _check_packing(rows, found)
    rooms = []  # best fit, the longest first, one after the other
    for n in sorted((r.length for r in found), reverse=True):
        best = min((r for r in rooms if r >= n), default=None)
        if best is None:
            rooms.append(2048 - n)
        else:
            rooms.remove(best)
            rooms.append(best - n)
    assert count <= len(rooms) + 1
    assert packing.pack_documents(documents(spark, rows).limit(0)).count() == 0


def test_packing_does_not_copy_the_counts_of_lengths_to_all_tasks(spark):
    found = packing.pack_documents(documents(spark, list(enumerate(variants(8, 30)))))
    assert "SortMergeJoin" in plan(found) and len({(r.doc_id, r.piece) for r in found.collect()}) == 30


@pytest.mark.parametrize("histogram", [
    {2048: 3, 1: 10}, {1024: 5, 1025: 4, 1023: 4}, {700: 9}, {683: 7, 682: 7}, {2047: 2, 1: 1}, {1500: 3, 600: 2, 549: 5},
    {1: 5000}, {}, {1366: 2, 683: 1, 682: 3}])
def test_plans_hold_each_piece_once(histogram):
    patterns = packing.plan_sequences(histogram)
    held = Counter()
    for pattern, count in patterns:
        assert count > 0 and sum(pattern) <= 2048 and sum(n > 682 for n in pattern) <= 2
        for n in pattern:
            held[n] += count
    assert held == Counter(histogram)


def test_word_table_gives_the_ids_of_whole_texts():
    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    texts = [t or "" for t in ODD] + ["İstanbul ΣΑΣ", "a\u0085b \x1cc", "<|endoftext|>x", "foo...bar,,baz!!", "ª º µ ß",
                                      "'tis x's", "é ́b", "--- - -"]
    for text, ids in zip(texts, packing.words_of(packing.VOCABULARY).ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_lattice_sums_over_all_segmentations():
    pieces = lattice.normalised([b"a", b"ab", b"b", b"c"], np.array([1., 2., 0., 1.]), np.array([1., 3., 2., 1.]), .5, 4.)
    first, further = dict(zip(pieces.strings, np.exp(pieces.first))), dict(zip(pieces.strings, np.exp(pieces.further)))

    def rest(word):
        return 1.0 if not word else sum(further[word[:n]] * rest(word[n:]) for n in range(1, 3) if word[:n] in further and len(word) >= n)

    def whole(word):
        begin = sum(first[word[:n]] * rest(word[n:]) for n in (1, 2) if word[:n] in first and len(word) >= n)
        return (begin + math.exp(pieces.bare) * rest(word)) * math.exp(pieces.stop)

    for word in (b"a", b"ab", b"abab", b"cab", b"bbca", b"aabbc"):
        assert lattice.word_scores([word], pieces)[0] == pytest.approx(math.log(whole(word)))
    counts = lattice.expected_counts([b"ab"], pieces)
    direct = {"ab": first[b"ab"], "a+b": first[b"a"] * further[b"b"],
              "bare": math.exp(pieces.bare) * (further[b"ab"] + further[b"a"] * further[b"b"])}
    total = sum(direct.values())
    assert counts[0].tolist() == pytest.approx([direct["a+b"] / total, direct["ab"] / total, 0, 0])
    assert counts[2] == pytest.approx(direct["bare"] / total)


def test_lattice_scores_base_and_odd_rows(spark):
    rows = [*enumerate([*ODD, *variants(8, 30)]), (4, "again again"), (None, "nobody home")]
    found = lattice.lattice_scores(documents(spark, rows)).collect()
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    counts, ends = Counter(), 0
    for i, t in rows:
        if not held[i]:
            counts.update(words(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    wanted = sorted(((i or -1), held[i], len(words(t)) + 1, sum(w in counts for w in words(t)) + 1, n, round(sum(
        math.log10((counts[w] + .5) / (n + .5 * (v + 1))) for w in words(t)) + math.log10((ends + .5) / (n + .5 * (v + 1))), 6))
        for i, t in rows)
    assert sorted(((-1 if r.doc_id is None else r.doc_id or -1), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6)) for r in found) == wanted
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert lattice.lattice_scores(documents(spark, rows).limit(0)).count() == 0


def _lattice_wanted(rows, fitted, log10):
    """Score of each (doc_id, text, lang) by the documented formula, with plain sums; ``log10`` of words by class."""
    names = [n for n, _ in sorted(Counter(l for i, _, l in rows if not _held(i)).items(), key=lambda c: (-c[1], c[0]))]
    many = len(names) + 1
    counts, ends = [Counter() for _ in range(many)], [0] * many
    for i, t, lang in rows:
        if not _held(i):
            counts[names.index(lang)].update(words(t))
            ends[names.index(lang)] += 1
    share = (sum(ends) + .5) / (sum(ends) + sum(sum(c.values()) for c in counts) + 1)
    prior = [(e + .5) / (sum(ends) + .5 * many) for e in ends]
    tokens = [sum(c.values()) + e for c, e in zip(counts, ends, strict=True)]
    distinct = [len(c) + (e > 0) for c, e in zip(counts, ends, strict=True)]
    everywhere = sum(counts, Counter())

    def word(w, k):
        lattices = [math.exp(log10(w, p) * math.log(10)) * (1 - share) for p in fitted]
        whole = (max(everywhere[w] - .75, 0) + (.75 * (len(everywhere) + 1) + 1) * sum(
            p * x for p, x in zip(prior, lattices, strict=True))) / (sum(tokens) + 1)
        q = .9 * lattices[k] + .1 * whole
        return math.log10((max(counts[k][w] - .75, 0) + (.75 * distinct[k] + 1) * q) / (tokens[k] + 1))

    def document(t, k):
        end = (max(ends[k] - .75, 0) + (.75 * distinct[k] + 1) * share) / (tokens[k] + 1)
        return math.log10(prior[k]) + math.log10(end) + sum(word(w, k) for w in words(t))

    return {i: math.log10(sum(10 ** document(t, k) for k in range(many))) for i, t, _ in rows}


def _held(i):
    return zlib.crc32(str(i).encode()) % 5 == 1


def test_lattice_scores_of_words_that_classes_share(spark, monkeypatch):
    fits = []
    fit = lattice.fit_pieces
    monkeypatch.setattr(lattice, "fit_pieces", lambda *a: fits.append(fit(*a)) or fits[-1])
    texts = {"de": ["der hund bellt laut", "das haus paris", "ein hund"], "fr": ["le chien", "la maison paris paris", "un garage"]}
    rows = [(10 * j + 2 * k + n, t, lang) for j in range(4) for k, (lang, ts) in enumerate(texts.items())
            for n, t in enumerate(ts[j % 3].split(" : "))] + [(101, "garage hund unbekannt", "de"), (102, "le hund garage", "fr")]
    assert len({_held(i) for i, _, _ in rows}) == 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.score for r in lattice.lattice_scores(frame).collect()}
    wanted = _lattice_wanted(rows, fits[0], lambda w, p: _plain(w.encode(), p) / math.log(10))
    assert found == pytest.approx(wanted, abs=1e-6)


def _plain(word, pieces):
    """The forward recursion, a word and a place at a time."""
    number = {s: i for i, s in enumerate(pieces.strings)}
    forward = [0.0]
    for j in range(1, len(word) + 1):
        terms = []
        for n in range(1, min(lattice.LONGEST, j) + 1):
            if (i := number.get(word[j - n:j])) is not None:
                terms.append(forward[j - n] + (pieces.further[i] if n < j else np.logaddexp(
                    pieces.first[i], pieces.bare + pieces.further[i])))
        top = max(terms)
        forward.append(top + math.log(sum(math.exp(t - top) for t in terms)))
    return forward[-1] + pieces.stop


def test_lattice_scores_of_a_very_long_word(spark, monkeypatch):
    fits = []
    fit = lattice.fit_pieces
    monkeypatch.setattr(lattice, "fit_pieces", lambda *a: fits.append(fit(*a)) or fits[-1])
    held = next(i for i in range(100) if _held(i))
    word = "".join(chr(97 + k * k * 7919 % 26) for k in range(5000))
    rows = [(i, "some words to learn from", "en") for i in range(8) if not _held(i)]
    frame = spark.createDataFrame([*rows, (held, word, "en")], "doc_id long, text string, lang string")
    found = next(r.score for r in lattice.lattice_scores(frame).collect() if r.held_out)
    n, distinct, ends = 6 * len(rows), 6, len(rows)
    n0, share, prior = 0, (ends + .5) / (n + 1), np.array([ends + .5, .5]) / (ends + 1)
    logs = np.array([_plain(word.encode(), p) for p in fits[0]]) + math.log(1 - share)
    whole = math.log(.75 * distinct + 1) + np.logaddexp(*(logs + np.log(prior))) - math.log(n + 1)
    q = np.logaddexp(math.log(.9) + logs, math.log(.1) + whole)
    own = np.array([.75 * distinct + 1, 1.0])
    end = (np.array([ends - .75, 0]) + own * share) / np.array([n + 1, n0 + 1])
    each = np.log(prior) + np.log(end) + np.log(own) + q - np.log([n + 1, n0 + 1])
    assert found < -1000
    assert found == pytest.approx(np.logaddexp(*each) / math.log(10), rel=1e-9)


def test_class_scores_of_a_word_in_several_portions():
    pieces = lattice.read_pieces(lattice.VOCABULARY)
    word = bytes(97 + k * k * 7919 % 26 for k in range(40_000))
    assert lattice.class_scores([word], [pieces, pieces])[0].tolist() == pytest.approx([_plain(word, pieces)] * 2)


def test_lattice_beats_the_base_on_held_out_documents(spark):
    found = [r for r in entry.queries()["op10_lattice_likelihood"](spark, "/root/testdata/sf0.1").collect() if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
