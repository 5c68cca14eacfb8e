"""Likelihood of texts under a lattice of subwords that is summed over all segmentations.

The pieces are those of an existing vocabulary; their scores (ranks) give the first weights, and some rounds of
expectation maximisation over the distinct words of the training documents fit them. A word is a first piece, any
number of further pieces and a stop, each drawn by itself; the forward recursion, in logarithms, adds up all ways to
cut the word. One more path takes a known word as a whole, by its count.

A corpus mixes languages, so the weights are fitted for each class of documents (a column, by default ``lang``, with
a bounded number of values; without it there is one class). In class k, with c of N training tokens and V distinct
ones, a word has the probability (c - d + (d * V + 1) * q) / (N + 1), where d = 0.75 is taken off each known word for
new ones, and q is nine tenths the lattice of the class and one tenth the whole corpus, counts and lattices together.
A document is its words and one end, and its probability is summed over the classes as well: which class it belongs
to is not looked at when it is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import bound_batches
from starloom.llm.shingles import numbers
from starloom.session import stage

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
LONGEST = 24  # bytes of a piece
ROUNDS = 2
CLASSES = 6  # the largest ones; the others are one more
OWN, DISCOUNT = 0.9, 0.75
FREQUENT = 500_000  # a word with one in so many tokens is frequent, so there are no more; other words meet in a join
FLUSH = 400_000  # distinct words that a task counts before it hands them on
_FLOOR = 1e-3  # of an expected count, so that no piece becomes impossible
_U = np.uint64
_BYTE = numbers(256, 41)
_STEP = numbers(LONGEST + 1, 42) | _U(1)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text with A-Z lower-cased, split at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def _window_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` codes along the last axis."""
    n = codes.shape[-1] - length + 1
    total = np.zeros((*codes.shape[:-1], n), dtype=_U)
    for k in range(length):
        total += codes[..., k:k + n] * _STEP[k]
    return total ^ (total >> _U(29))


@dataclass
class Pieces:
    """Strings of bytes that can be part of a word, with log weights at its start and further on."""
    strings: list[bytes]
    first: np.ndarray
    further: np.ndarray
    bare: float  # the word begins with a piece of its own that holds no letter
    stop: float

    def __post_init__(self) -> None:
        self._hashes: list[tuple[np.ndarray, np.ndarray]] = []
        by_length: dict[int, list[int]] = {}
        for i, s in enumerate(self.strings):
            by_length.setdefault(len(s), []).append(i)
        for length in range(1, LONGEST + 1):
            own = np.array(by_length.get(length, []), dtype=np.int64)
            codes = _BYTE[np.frombuffer(b"".join(self.strings[i] for i in own), dtype=np.uint8).reshape(len(own), length)]
            hashes = _window_hashes(codes, length)[:, 0] if len(own) else np.empty(0, dtype=_U)
            order = np.argsort(hashes)
            self._hashes.append((hashes[order], own[order]))

    def find(self, codes: np.ndarray, length: int) -> np.ndarray:
        """Number of the piece at each place, -1 if there is none."""
        known, number = self._hashes[length - 1]
        if not len(known):
            return np.full((*codes.shape[:-1], codes.shape[-1] - length + 1), -1)
        sought = _window_hashes(codes, length)
        at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
        return np.where(known[at] == sought, number[at], -1)


def read_pieces(path: str) -> Pieces:
    """The pieces of a vocabulary file; weights fall with the rank that its scores give them."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    start, further = {}, {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        weight, name = 1 / (100.0 + max(0.0, -model.get_score(i))), model.id_to_piece(i)
        if model.is_byte(i):
            further.setdefault(bytes([int(name[3:5], 16)]), 1e-7)
        elif name.startswith("▁"):
            start[name[1:].encode()] = weight  # the mark alone is the bare beginning
        else:
            further[name.encode()] = weight
    for b in range(256):
        further.setdefault(bytes([b]), 1e-7)
    start.pop(b"", None)
    strings = sorted({s for s in (*start, *further) if len(s) <= LONGEST})
    return normalised(strings, np.array([start.get(s, 0.0) for s in strings]),
                      np.array([further.get(s, 0.0) for s in strings]), sum(start.values()) / 3, sum(further.values()) / 3)


def normalised(strings: list[bytes], first: np.ndarray, further: np.ndarray, bare: float, stop: float) -> Pieces:
    """Weights or expected counts as log probabilities: of the first piece, and of a further piece or the stop."""
    with np.errstate(divide="ignore"):
        begin, go = first.sum() + bare, further.sum() + stop
        return Pieces(strings, np.log(first / begin), np.log(further / go), float(np.log(bare / begin)),
                      float(np.log(stop / go)))


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        total = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
    return np.where(np.isneginf(top), -np.inf, total)


@dataclass
class _Lattice:
    """Words of one length: ids[l] and edges[:, j, l-1] belong to pieces of length l; edges end at j."""
    ids: list[np.ndarray]
    edges: np.ndarray
    forward: np.ndarray


def _lattice(raw: np.ndarray, pieces: Pieces) -> _Lattice:
    rows, n = raw.shape
    deep = min(LONGEST, n)
    codes = _BYTE[raw]
    edges, ids = np.full((rows, n + 1, deep), -np.inf), []
    for length in range(1, deep + 1):
        found = pieces.find(codes, length)
        ids.append(found)
        weight = np.where(found >= 0, pieces.further[found], -np.inf)
        at_start = np.where(found[:, 0] >= 0, pieces.first[found[:, 0]], -np.inf)
        weight[:, 0] = np.logaddexp(at_start, pieces.bare + weight[:, 0])
        edges[:, length:, length - 1] = weight
    forward = np.full((rows, deep + n + 1), -np.inf)  # ``deep`` places of padding first
    forward[:, deep] = 0.0
    for j in range(1, n + 1):
        forward[:, deep + j] = _log_sum(forward[:, j:j + deep][:, ::-1] + edges[:, j, :])
    return _Lattice(ids, edges, forward[:, deep:])


def _by_length(words: list[bytes]) -> Iterator[np.ndarray]:
    """Indexes of words of one length, so many that their lattice stays small."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(words) else []:
        step = max(1, (1 << 15) // max(1, lengths[same[0]]))
        for at in range(0, len(same), step):
            yield same[at:at + step]


def class_scores(words: list[bytes], fitted: list[Pieces]) -> np.ndarray:
    """Natural logarithm of the lattice probability of words (rows) under weights of the same pieces (columns).

    The pieces in a word are looked up once for all weights; the recursion then goes over those that are there.
    """
    out = np.empty((len(words), len(fitted)))
    further = np.column_stack([p.further for p in fitted])
    start = np.logaddexp(np.column_stack([p.first for p in fitted]), np.array([p.bare for p in fitted]) + further)
    stop = np.array([p.stop for p in fitted])
    for at in _by_length(words):
        rows, n = len(at), len(words[at[0]])
        codes = _BYTE[np.frombuffer(b"".join(words[i] for i in at), dtype=np.uint8).reshape(rows, n)]
        forward = np.full((n + 1, rows, len(fitted)), -np.inf)
        forward[0] = 0.0
        for done in range(0, n, 1 << 15):
            width = min(n - done, 1 << 15)
            grid = np.full((width, rows, min(LONGEST, n)), -1, dtype=np.int32)  # pieces by their end
            for length in range(1, grid.shape[2] + 1):
                begin = max(0, done + 1 - length)
                if begin + length <= done + width:
                    found = fitted[0].find(codes[:, begin:done + width], length)
                    grid[begin + length - 1 - done:, :, length - 1] = found.T
            end, row, size = np.nonzero(grid >= 0)
            number, begin = grid[end, row, size], done + end - size
            weight = np.where((begin == 0)[:, None], start[number], further[number])
            cuts = np.searchsorted(end, np.arange(width + 1))
            for j in range(width):
                part = slice(cuts[j], cuts[j + 1])
                r = row[part]
                if not len(r):
                    continue
                new = np.empty(len(r), dtype=bool)
                new[0] = True
                np.not_equal(r[1:], r[:-1], out=new[1:])
                heads = np.flatnonzero(new)
                x = forward[begin[part], r] + weight[part]
                top = np.maximum.reduceat(x, heads, axis=0)
                top = np.where(np.isneginf(top), 0.0, top)
                x -= top[np.cumsum(new) - 1]
                with np.errstate(divide="ignore"):
                    forward[done + j + 1, r[heads]] = top + np.log(np.add.reduceat(np.exp(x), heads, axis=0))
        out[at] = forward[n] + stop
    return out


def word_scores(words: list[bytes], pieces: Pieces) -> np.ndarray:
    """Natural logarithm of the lattice probability of each word, summed over all its segmentations."""
    return class_scores(words, [pieces])[:, 0]


def expected_counts(words: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray, float]:
    """How often each piece is expected as first and as further piece over the words, and bare beginnings."""
    size = len(pieces.strings)
    first, further, bare = np.zeros(size), np.zeros(size), 0.0
    for at in _by_length(words):
        n = len(words[at[0]])
        raw = np.frombuffer(b"".join(words[i] for i in at), dtype=np.uint8).reshape(len(at), n)
        lattice = _lattice(raw, pieces)
        deep = lattice.edges.shape[2]
        backward = np.full((len(at), n + 1 + deep), -np.inf)
        backward[:, n] = 0.0
        steps = np.arange(1, deep + 1)
        padded = np.concatenate([lattice.edges, np.full((len(at), deep, deep), -np.inf)], axis=1)
        for i in range(n - 1, -1, -1):
            backward[:, i] = _log_sum(padded[:, i + steps, steps - 1] + backward[:, i + 1:i + 1 + deep])
        whole = lattice.forward[:, n][:, None]
        for length in range(1, deep + 1):
            found = lattice.ids[length - 1]
            share = np.exp(lattice.forward[:, :n + 1 - length] + lattice.edges[:, length:, length - 1]
                           + backward[:, length:n + 1] - whole)
            hit = found[:, 1:] >= 0
            further += np.bincount(found[:, 1:][hit], weights=share[:, 1:][hit], minlength=size)
            start = np.flatnonzero(found[:, 0] >= 0)
            number, begin = found[start, 0], share[start, 0]
            direct = np.exp(pieces.first[number] - lattice.edges[start, length, length - 1])
            first += np.bincount(number, weights=begin * direct, minlength=size)
            further += np.bincount(number, weights=begin * (1 - direct), minlength=size)
            bare += float((begin * (1 - direct)).sum())
    return first, further, bare


def _held(column: str) -> str:
    return f"crc32(cast(cast({column} AS string) AS binary)) % 5 = 1"


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[int, Counter] = {}

    def out() -> pd.DataFrame:
        found = [pd.DataFrame({"word": list(c.keys()), "class": k, "n": np.fromiter(c.values(), dtype=np.int64)})
                 for k, c in counts.items()]
        counts.clear()
        both = pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=["word", "class", "n"])
        return both.assign(n=both["n"].where(both["class"] >= 0, 0))  # held-out words are listed, not counted

    for batch in batches:
        for text, held, number in batch[["text", "held_out", "class"]].itertuples(index=False):
            counts.setdefault(-1 if held else number, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > FLUSH:
                yield out()
    yield out()


def _words_in_portions(batches: Iterator[pd.DataFrame], rows: int = 40_000) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def fit_pieces(words: DataFrame, pieces: Pieces, classes: int, rounds: int = ROUNDS) -> list[Pieces]:
    """Weights for each class, fitted to its distinct words (n0, n1, ... over 0); the driver gets a row per piece."""
    fitted = [pieces] * classes
    size = len(pieces.strings)
    for _ in range(rounds):
        def expect(batches: Iterator[pd.DataFrame], now: list[Pieces] = fitted) -> Iterator[pd.DataFrame]:
            first, further = np.zeros((classes, size + 1)), np.zeros((classes, size + 1))
            for portion in _words_in_portions(batches):
                word = portion["word"].to_numpy()
                for k in range(classes):
                    own = word[portion[f"n{k}"].to_numpy() > 0]
                    if len(own):
                        a, b, bare = expected_counts(list(own), now[k])
                        first[k] += np.append(a, bare)
                        further[k] += np.append(b, len(own))
            k, place = np.nonzero((first > 0) | (further > 0))
            yield pd.DataFrame({"class": k, "piece": place, "first": first[k, place], "further": further[k, place]})

        sums = words.mapInPandas(expect, "class int, piece long, first double, further double").groupBy(
            "class", "piece").agg(F.sum("first").alias("first"), F.sum("further").alias("further")).toPandas()
        first, further = np.full((classes, size + 1), _FLOOR), np.full((classes, size + 1), _FLOOR)
        first[sums["class"], sums["piece"]] += sums["first"]
        further[sums["class"], sums["piece"]] += sums["further"]
        fitted = [normalised(pieces.strings, np.where(np.isfinite(pieces.first), first[k, :-1], 0.0),
                             np.where(np.isfinite(pieces.further), further[k, :-1], 0.0), first[k, -1], further[k, -1])
                  for k in range(classes)]
    return fitted


@dataclass
class Corpus:
    """Counts of the training documents: tokens, distinct tokens and ends, of all and of each class."""
    tokens: int
    distinct: int
    ends: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray
    class_ends: np.ndarray

    def shares(self) -> np.ndarray:
        return (self.class_ends + 0.5) / (self.class_ends + 0.5).sum()

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def end(self) -> np.ndarray:
        """log10 probability of an end in each class."""
        share = (self.ends + 0.5) / (self.tokens + 1)
        own = DISCOUNT * self.class_distinct + 1
        return np.log10((np.maximum(self.class_ends - DISCOUNT, 0) + own * share) / (self.class_tokens + 1))

    def words(self, counts: np.ndarray, lattices: np.ndarray) -> np.ndarray:
        """log10 probability of words (rows) in each class from counts and logarithms of the lattices.

        All of it is a sum of logarithms, so a word may be as long and as unlikely as it is.
        """
        share = (self.ends + 0.5) / (self.tokens + 1)
        lattices = lattices + np.log(1 - share)
        with np.errstate(divide="ignore"):
            known = np.log(np.maximum(counts.sum(axis=1) - DISCOUNT, 0))
            mine = np.log(np.maximum(counts - DISCOUNT, 0))
        everywhere = np.logaddexp(known, np.log(DISCOUNT * self.distinct + 1) + _log_sum(lattices + np.log(self.shares())))
        whole = everywhere - np.log(self.tokens + 1)
        q = np.logaddexp(np.log(OWN) + lattices, np.log(1 - OWN) + whole[:, None])
        own = np.log(DISCOUNT * self.class_distinct + 1)
        return (np.logaddexp(mine, own + q) - np.log(self.class_tokens + 1)) / np.log(10)


def _classes(named: DataFrame, class_col: str | None, classes: int) -> list:
    if class_col is None:
        return []
    found = named.where("NOT held_out AND _class IS NOT NULL").groupBy("_class").count()
    return [r["_class"] for r in found.orderBy(F.col("count").desc(), "_class").limit(classes).collect()]


def lattice_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang",
                   path: str = VOCABULARY) -> DataFrame:
    """A row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents whose crc32(doc_id as text) mod 5 is 1 (``held_out``) are scored but not learnt from. NULL and empty
    texts are a single end. A NULL identifier is learnt from, a NULL class belongs to the class of rare values.
    Repeated rows count and are scored as often as they come; an empty table gives an empty result; without anything
    to learn from every token has the base probability 1 and the lattice has its first weights. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.coalesce(F.expr(_held(f"`{id_col}`")), F.lit(False)).alias("held_out"),
        (F.col(class_col).cast("string") if class_col else F.lit(None).cast("string")).alias("_class"))
    names = _classes(named, class_col, CLASSES)
    many = len(names) + 1
    number = F.lit(len(names))
    for i, name in enumerate(names):
        number = F.when(F.col("_class") == name, i).otherwise(number)
    named = named.select("doc_id", "text", "held_out", number.alias("class"))
    counted = [f"n{k}" for k in range(many)]
    words = stage(
        named.select("text", "held_out", "class").mapInPandas(_count_words, "word binary, class int, n long")
        .groupBy("word").agg(*[F.sum(F.when(F.col("class") == k, F.col("n")).otherwise(0)).alias(f"n{k}")
                               for k in range(many)])
        .withColumn("n", sum((F.col(c) for c in counted), F.lit(0)).cast("long")), "words")
    corpus = _corpus(named, words, many)
    fitted = fit_pieces(words.where("n > 0"), read_pieces(path), many)

    def score_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for portion in _words_in_portions(batches):
            word, counts = portion["word"].to_numpy(), portion[counted].to_numpy()
            lattices = class_scores(list(word), fitted)
            yield pd.DataFrame({"word": word, "n": portion["n"], "base": corpus.base(portion["n"].to_numpy()),
                                "scores": list(corpus.words(counts, lattices))})

    scored = stage(words.mapInPandas(score_words, "word binary, n long, base double, scores array<double>"), "scored")
    return _document_scores(named, scored, corpus, many)


def _corpus(named: DataFrame, words: DataFrame, many: int) -> Corpus:
    ends = {r["class"]: r["count"] for r in named.where("NOT held_out").groupBy("class").count().collect()}
    sums = words.agg(F.sum((F.col("n") > 0).cast("long")).alias("d"),
                     *[F.sum(f"n{k}").alias(f"t{k}") for k in range(many)],
                     *[F.sum((F.col(f"n{k}") > 0).cast("long")).alias(f"d{k}") for k in range(many)]).first()
    class_ends = np.array([ends.get(k, 0) for k in range(many)])
    class_tokens = np.array([sums[f"t{k}"] or 0 for k in range(many)]) + class_ends
    class_distinct = np.array([sums[f"d{k}"] or 0 for k in range(many)]) + (class_ends > 0)
    return Corpus(int(class_tokens.sum()), int(sums["d"] or 0) + bool(ends), int(class_ends.sum()), class_tokens,
                  class_distinct, class_ends)


def _document_scores(named: DataFrame, scored: DataFrame, corpus: Corpus, many: int) -> DataFrame:
    """Sums over the words of each document: frequent words in the task, the others by a join."""
    top = scored.where(F.col("n") >= max(2, corpus.tokens // FREQUENT)).toPandas()
    near = {w: i for i, w in enumerate(top["word"])}
    values = np.column_stack([top["n"].to_numpy() > 0, top["base"], np.array(top["scores"].tolist()).reshape(len(top), many)])
    shared = named.sparkSession.sparkContext.broadcast((near, values.astype(float)))  # FREQUENT at most
    end = np.concatenate([[corpus.ends > 0], [float(corpus.base(np.array(corpus.ends)))], corpus.end()])

    def partly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        near, values = shared.value
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = words_of(text)
                times = Counter(found)
                place = [near.get(w, -1) for w in times]
                count = np.fromiter(times.values(), dtype=float, count=len(place))
                have = np.array(place, dtype=np.int64) >= 0
                total = end + count[have] @ values[np.array(place, dtype=np.int64)[have]]
                rest = [w for w, p in zip(times, place, strict=True) if p < 0]
                rows.append((len(found) + 1, int(total[0]), total[1], total[2:], rest, count[~have].astype(np.int32)))
            out = pd.DataFrame(rows, columns=["n_tokens", "n_known", "base", "scores", "rest", "times"])
            yield out.assign(doc_id=batch["doc_id"].astype("Int64").to_numpy(), held_out=batch["held_out"].to_numpy())

    partial = stage(named.mapInPandas(
        partly, "n_tokens long, n_known long, base double, scores array<double>, rest array<binary>, times array<int>, "
                "doc_id long, held_out boolean").withColumn("row", F.monotonically_increasing_id()), "partial")
    rest = partial.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w")).select(
        "row", F.col("w.rest").alias("word"), F.col("w.times").alias("times"))
    sums = rest.join(scored, "word").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * F.col("base")).alias("_base"),
        *[F.sum(F.col("times") * F.col("scores")[k]).alias(f"_s{k}") for k in range(many)])
    joined = partial.drop("rest", "times").join(sums, "row", "left")
    each = [F.col("scores")[k] + F.coalesce(f"_s{k}", F.lit(0.0)) + float(np.log10(p))
            for k, p in enumerate(corpus.shares())]
    best = F.greatest(*each) if many > 1 else each[0]
    total = sum((F.pow(F.lit(10.0), e - F.col("_best")) for e in each), F.lit(0.0))
    return joined.withColumn("_best", best).select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("_best") + F.log10(total)).alias("score"))
