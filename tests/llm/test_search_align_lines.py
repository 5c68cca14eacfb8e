"""Ranked search, aligned tokenizers and repeated lines against brute force on small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import token_align
from starloom.llm.blocked_search import BlockIndex, search_documents, turns
from starloom.llm.line_runs import LineRuns, dedup_lines, line_keys
from starloom.llm.token_align import align_tokenizers, pair_of, shared_cuts
from starloom.session import scratch_path
from tests.llm.helpers import LOWER, ODD, documents

OTHER_WHITE = [" ", "　\u0085", " ", "\x1c"]


# --- repeated lines -------------------------------------------------------------------------------------------------

LONG = ["a line that is long enough", "  A Line That Is Long Enough\t", "another passage of twenty", "Été " * 6, "short",
        "exactly twenty chars", "only nineteen chars"]


def kept_lines(rows, least=3):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    number = lambda i: -math.inf if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(number(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < least or max(holders[key(x)]) == number(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows():
    r = random.Random(5)
    rows = [(i, "\n".join(r.choice(LONG) for _ in range(r.randrange(6)))) for i in range(40)]
    rows += [(100 + i, t) for i, t in enumerate([*ODD, *OTHER_WHITE])]
    rows += [(7, LONG[0]), (7, LONG[0]), (39, "x\n" + LONG[2]), (None, LONG[0]), (None, LONG[2] + "\n"), (200, "\n".join([LONG[2]] * 50))]
    return rows + [(300 + i, "the very same line in every document\n" + str(i)) for i in range(30)]


def test_lines_equal_brute_force(spark, rows):
    given = line_rows()
    found = dedup_lines(documents(spark, given, ["line", "pos", "_id", "_pos"]), batches=5, fanout=2)
    assert rows(found, "doc_id", "n_lines", "n_dropped", "kept_text") == kept_lines(given)


def test_two_documents_do_not_make_a_repeated_line(spark, rows):
    given = [(1, LONG[0]), (2, LONG[0]), (2, LONG[0]), (None, None)]
    assert rows(dedup_lines(documents(spark, given))) == kept_lines(given)


def test_lines_of_no_documents(spark):
    assert dedup_lines(documents(spark, []), batches=2).count() == 0


def test_a_batch_added_again_changes_nothing_and_runs_are_compacted(spark, rows):
    root = scratch_path(spark, "runs")
    keys = line_keys(documents(spark, line_rows()))
    runs = LineRuns(spark, root, fanout=3, buckets=4)
    for part in (0, 1, 2, 3, 1, 0, 2):
        runs.add(keys.where(F.pmod("_id", F.lit(4)) == part))
    assert {level: len(there) for level, there in runs.levels.items() if there} == {0: 1, 1: 2}
    found = rows(runs.repeated())
    runs.close()
    again = LineRuns(spark, root, fanout=3, buckets=4)
    assert len(again.runs()) == 3 and rows(again.repeated()) == found
    again.add(keys)
    assert rows(again.repeated()) == found
    again.close()
    once = LineRuns(spark, scratch_path(spark, "runs"))
    once.add(keys)
    assert rows(once.repeated()) == found and len(found) > 3
    once.add(keys)  # keys that are settled do not come into the run of a later batch
    assert once.runs()[-1].count() == 0
    once.close()


def test_a_batch_meets_the_runs_without_shuffling_them(spark, monkeypatch):
    root, written = scratch_path(spark, "runs"), []
    runs = LineRuns(spark, root, buckets=8)
    keys = line_keys(documents(spark, line_rows()))
    runs.add(keys)
    monkeypatch.setattr(runs, "_write", lambda states, level: written.append(states))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        runs.add(keys)
        plan = written[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    runs.close()
    assert "LeftAnti" in plan and plan.count("Exchange hashpartitioning") == 1


# --- aligned tokenizers ---------------------------------------------------------------------------------------------

def groups_of(pair, text):
    """Groups by walking both lists of tokens side by side; None without tokens."""
    if not text:
        return None
    data = (" " + text).encode()
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    if b"".join(pair.bytes_a[i] for i in a) != data or b"".join(pair.bytes_b[i] for i in b) != data:
        return None
    groups, mine, theirs, i, j, x, y = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y:
            mine.append(a[i])
            x += len(pair.bytes_a[a[i]])
            i += 1
        else:
            theirs.append(b[j])
            y += len(pair.bytes_b[b[j]])
            j += 1
        if x == y:
            groups.append((mine, theirs))
            mine, theirs = [], []
    return groups


def aligned_brute(given):
    pair = pair_of(token_align.BYTES_VOCABULARY, token_align.PIECES_VOCABULARY)
    found = [(i, groups_of(pair, t)) for i, t in given]
    counts = Counter((a[-1], b[-1]) for _, g in found for a, b in g or ())
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, g in found:
        if not g:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        links = [(a[-1], b[-1]) for a, b in g]
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g),
                    sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("portion", [60, token_align.PORTION])
def test_alignment_equals_brute_force(spark, rows, monkeypatch, portion):
    monkeypatch.setattr(token_align, "PORTION", portion)
    given = [*enumerate([*ODD, *OTHER_WHITE, "a▁b", "<|endoftext|> <s> </s> tail", "  two  spaces ", "don't we'll\n\n\nx", "ends here \n",
                          " \n begins", "x  \n\n", "  ", "\n x", "end\n"])]
    given += [(None, "no name"), (1, "one again"), (1, "one again"), (90, "alpha beta gamma " * 300)]
    # Texts are encoded in this process, so that the portion that was set is the one in use.
    pair = pair_of(token_align.BYTES_VOCABULARY, token_align.PIECES_VOCABULARY)
    direct = list(token_align._rows([t for _, t in given], pair))
    frame = align_tokenizers(documents(spark, given, ["_row", "n_a", "_pairs"]))
    wanted = aligned_brute(given)
    assert rows(frame, "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256") == wanted
    assert sorted(r[3] for r in direct) == sorted(w[-1] for w in wanted)


def test_alignment_of_no_documents(spark):
    assert align_tokenizers(documents(spark, [])).count() == 0


def test_shared_cuts_of_random_ends():
    r = np.random.default_rng(3)
    for n in (1, 2, 5, 60, 400):
        for share in (0.02, 0.3, 0.9):
            a, b = (np.unique(np.append(np.flatnonzero(r.random(n * 3) < share) + 1, n * 3)) for _ in range(2))
            wanted = [i for i, x in enumerate(a) if x in set(b.tolist())]
            assert shared_cuts(a, b, np.array([0]), np.array([len(a) - 1])).tolist() == wanted


# --- ranked search --------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked_brute(docs, items, best):
    split = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    split = [(i, w) for i, w in split if w]
    n_docs, length = len(split), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    out = []
    for item, text in items:
        terms, found = set(TERM.findall((text or "").translate(LOWER))), []
        for i, words in split:
            tf, m, score = Counter(words), 50 + (50 * len(words) * n_docs) // length, 0
            for t in terms & tf.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                found.append((-score, math.inf if i is None else i, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=repr)


def search_rows():
    r = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Él", "日本", "x1", "don't"]
    some = lambda n: " ".join(r.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, some(r.randrange(1, 60))) for i in range(300)]
    docs += [(400 + i, t) for i, t in enumerate([*ODD, *OTHER_WHITE])]
    docs += [(5, docs[9][1]), (5, docs[9][1]), (None, docs[9][1]), *((500 + i, "w1 w3 w9 tie") for i in range(80))]
    items = [(0, "w1 w3 W9 tie"), (1, "w40 w50 ÉL él"), (2, None), (3, ""), (4, "..!"), (5, "absent entirely"),
             (6, docs[9][1]), (6, docs[9][1]), (7, "w0"), (8, some(30)), (9, "日本 x1 don t")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"cell": 16, "block": 2, "best": 7}, {"queries": 3, "terms": 5, "cell": 50, "block": 8}])
def test_search_equals_brute_force(spark, rows, options):
    docs, items = search_rows()
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    found = search_documents(documents(spark, docs, ["n", "terms", "cell", "rank"]), asked, **options)
    assert rows(found, "item_id", "rank", "doc_id", "score") == ranked_brute(docs, items, options.get("best", 50))


def test_blocks_are_skipped_only_below_the_threshold(spark):
    """Bounds hold every score, and some blocks lie below the threshold."""
    docs, items = search_rows()
    turn = next(turns([items[0]]))
    index = BlockIndex(documents(spark, docs).select("doc_id", "text"), turn.vocabulary, cell=16, block=2)
    bounds = index.bounds(turn.terms).collect()
    scores = index.score(index.bounds(turn.terms), turn.terms, 10**6).collect()
    assert max(r["bound"] for r in bounds) >= max(r["score"] for r in scores)
    assert min(r["bound"] for r in bounds) < sorted((r["score"] for r in scores), reverse=True)[49]


def test_search_without_documents_or_items(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search_documents(documents(spark, []), items).count() == 0
    assert search_documents(documents(spark, [(1, None), (2, "...")]), items).count() == 0
    assert search_documents(documents(spark, [(1, "a")]), items.limit(0)).count() == 0
