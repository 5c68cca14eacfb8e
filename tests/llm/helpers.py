"""Small tables and brute-force versions for the corpus operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    out, word = [], ""
    for c in (text or "").translate(LOWER):
        if c in WHITE:
            out.append(word)
            word = ""
        else:
            word += c
    return [w for w in [*out, word] if w]


def documents(spark, rows, more=()):
    """Documents of (doc_id, text), with columns whose names operators might use for their own."""
    frame = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    for name in ("kept", "score", "node", "_text", "_row", "hash", "length", "tokens", *more):
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(nodes, linked):
    """Smallest reachable node of each node."""
    name = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            least = min(name[a], name[b])
            if name[a] != least or name[b] != least:
                name[a] = name[b] = least
                changed = True
    return name


def variants(seed, n, length=60, edits=6):
    """Texts that are edited copies of one text, and some that are not."""
    r = random.Random(seed)
    base = [f"w{r.randrange(500)}" for _ in range(length)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randrange(edits)):
            w[r.randrange(length)] = f"e{r.randrange(10**6)}"
        if i % 7 == 0:
            w = [f"o{r.randrange(10**6)}" for _ in range(length)]
        out.append(" ".join(w))
    return out


ODD = [None, "", " \n\t ", "one", "One", "a b c d", "A B c d", "x " * 4000, "word" * 5000, "tie tie tie tie tie tie",
       "tie tie tie tie tie tie", "é日本語 😀 ok", "it's don't WE'LL", "12 3.5 ½", "no break", "▁ mark"]
