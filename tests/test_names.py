"""Name matching against brute force over all pairs."""

import random

import pytest

from starloom.operators import names
from starloom.operators.names import match_names, name_lookup

COUNTRIES = [("DE", "Germany"), ("AT", "Austria"), ("AU", "Australia"), ("KN", "Saint Kitts and Nevis"),
             ("NE", "Niger"), ("NG", "Nigeria"), ("CI", "Côte d'Ivoire"), ("GN", "Guinea"),
             ("PG", "Papua New Guinea"), ("GW", "Guinea-Bissau"), ("KR", "Korea, Republic of")]
NAMES = ["GERMANY", " germany ", "austr", "Niger", "GUINEA", "cote d'ivoire", "ST. KITTS", "de", "Atlantis", "Germny",
         "Guinea Bissao", "a", "of", "PAPUA-NEW", "KOREA, NORTH", "nigerr", "", None, "GERMANY"]
ALIASES = [("ST.", "SAINT")]


def fold(text):
    return text.strip().lower().replace("ô", "o")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(name, passes, distance):
    replaced = name.replace("ST.", "SAINT")
    first = replaced.split(" ")[0].split("-")[0].replace(",", " ").strip(" ")
    for term in [fold(name), fold(replaced), fold(first)][:passes]:
        if not term:
            continue
        ranked = []
        for code, country in COUNTRIES:
            known = fold(country)
            if term in (known, code.lower()):
                points = 80
            elif term in known:
                points = max(5, 30 - 2 * known.index(term))
            elif 0 < edits(term, known) <= distance:
                points = 4 - edits(term, known)
            else:
                continue
            ranked.append((-points, code))
        if ranked:
            return min(ranked)[1]
    return None


@pytest.mark.parametrize("passes, distance, limits", [
    (1, 0, {}), (2, 1, {}), (3, 2, {}), (3, 1, {"broadcast_rows": 0, "rows_per_task": 2, "hot_share": 0.001}),
])
def test_match_names(spark, passes, distance, limits):
    names = spark.createDataFrame([(n,) for n in NAMES], "n string")
    dim = spark.createDataFrame(COUNTRIES, "code string, country string")
    found = match_names(names, "n", dim, "country", "code", "c", ALIASES, passes=passes, max_distance=distance, **limits)
    wanted = {n: brute(n, passes, distance) for n in NAMES if n}
    assert {r["n"]: r["c"] for r in found.collect()} == {n: c for n, c in wanted.items() if c}


def test_name_lookup_keeps_all_rows(spark, rows):
    names = spark.createDataFrame([(1, "GERMANY"), (2, "Atlantis"), (3, None), (4, "GERMANY"), (5, "ST. KITTS")],
                                  "i int, n string")
    dim = spark.createDataFrame(COUNTRIES, "code string, country string")
    found = name_lookup(names, "n", dim, "country", "code", "c", no_match="no match", replacements=ALIASES)
    assert rows(found, "i", "c") == [(1, "DE"), (2, "no match"), (3, "no match"), (4, "DE"), (5, "KN")]


def test_shown_text_has_the_alias(spark, rows):
    names = spark.createDataFrame([("ST. KITTS",), ("GERMANY",)], "n string")
    dim = spark.createDataFrame(COUNTRIES, "code string, country string")
    found = match_names(names, "n", dim, "country", "code", "c", ALIASES, shown="s")
    assert rows(found, "n", "s") == [("GERMANY", "GERMANY"), ("ST. KITTS", "SAINT KITTS")]


def test_bad_options(spark):
    frame = spark.createDataFrame([("a",)], "n string")
    with pytest.raises(ValueError):
        match_names(frame, "n", frame, "n", "n", "c", passes=4)
    with pytest.raises(ValueError):
        match_names(frame, "n", frame, "n", "n", "c", max_distance=3)


def test_long_names_are_not_broadcast(spark):
    index = spark.range(50).selectExpr("concat(repeat('ab', 2500), id) AS __name", "id AS __code")
    assert not names._pieces_fit(index, 0, {})
    short = spark.range(50).selectExpr("concat('name ', id) AS __name", "id AS __code")
    assert names._pieces_fit(short, 1, {})
    searched = spark.createDataFrame([("bab7",), ("none",)], "n string")
    found = match_names(searched, "n", index, "__name", "__code", "c", passes=1)
    assert [tuple(r) for r in found.collect()] == [("bab7", 7)]


def test_segments_find_every_pair_within_the_distance(spark, rows):
    """Random short words over three letters, so that every kind of edit and many ties occur."""
    r = random.Random(2)
    words = ["".join(r.choice("abc") for _ in range(r.randrange(1, 9))) for _ in range(120)]
    index = spark.createDataFrame([(w, i) for i, w in enumerate(words[:60])], "__name string, __code int")
    searched = spark.createDataFrame([(w,) for w in set(words[60:])], "term string")
    for distance in (1, 2):
        found = names._misspelt(searched, index, distance, {}).distinct()
        wanted = {(t, i, 4 - edits(t, w)) for t in set(words[60:]) for i, w in enumerate(words[:60])
                  if 0 < edits(t, w) <= distance}
        assert set(rows(found, "term", "__code", "points")) == wanted


def test_a_very_long_name_offers_few_segments(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(5000))
    near = long[:1000] + "#" + long[1000:4000] + long[4001:]
    dim = spark.createDataFrame([("L", long), ("S", "short")], "code string, country string")
    found = match_names(spark.createDataFrame([(near,), ("shrot",), ("s",)], "n string"), "n", dim, "country", "code", "c",
                        passes=1, max_distance=2)
    assert {r["n"]: r["c"] for r in found.collect()} == {near: "L", "shrot": "S", "s": "S"}


def test_a_short_term_meets_one_row(spark):
    dim = spark.range(5000).selectExpr("id AS code", "concat('name ', id, ' ab') AS country")
    found = match_names(spark.createDataFrame([("ab",), ("n",), ("zz",)], "n string"), "n", dim, "country", "code", "c", passes=1)
    assert {r["n"]: r["c"] for r in found.collect()} == {"ab": 0, "n": 0}
