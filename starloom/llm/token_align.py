"""Token groups of two tokenizers over the same bytes, by divide and conquer at shared cuts.

Both tokenizers cut the bytes of a text into tokens. A place where a token of either ends is a shared cut. A text is
an interval of tokens; a common end near its middle is located by bisection in the other tokenizer's ends, and both
halves are treated alike; an interval without a common end inside is a group. All intervals of a portion of texts
are halved at once, level by level, so the work is in numpy and the depth is that of the logarithm.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.batches import bound_batches
from starloom.operators.joins import join_on
from starloom.session import stage

BYTES_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

# Characters that are encoded at once: an encoding takes some hundred bytes a token.
PORTION = 500_000
# Neither tokenizer has a token over a single space between two words, so what lies between is encoded by itself.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
# Words that a worker remembers; only the speed depends on them.
_KEPT, _KEPT_LENGTH = 300_000, 64


def _byte_of_sign() -> dict[str, int]:
    """The bytes that the signs of a byte-level vocabulary stand for: printable ones for themselves, others shifted."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Two tokenizers, the bytes of their tokens, and how a token is written in a list of groups."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        signs = _byte_of_sign()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in table], dtype=np.int64)
                                    for table in (self.bytes_a, self.bytes_b))
        self.words_a: dict[str, bytes] = {}
        self.words_b: dict[str, bytes] = {}
        self.cuts_at_spaces = not any("▁" in p.lstrip("▁") for p in pieces)
        names_a, names_b = [b"%d" % i for i in range(len(self.bytes_a))], [b"%d" % i for i in range(len(pieces))]
        # By code: a token of A within its group, the last one; a token of B within, the last one.
        self.written = [x + end for names, ends in ((names_a, b",|"), (names_b, b",;"))
                        for end in (ends[:1], ends[1:]) for x in names]

    def parts(self, text: str) -> list[str]:
        """The text, or what lies between single spaces about a portion apart; each part is encoded by itself."""
        found, at = [], 0
        while self.cuts_at_spaces and len(text) - at > PORTION:
            cut = _BETWEEN.search(text, at + PORTION)
            if not cut:
                break
            found.append(text[at:cut.start()])
            at = cut.end()
        return [*found, text[at:]]

    def _encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or None where the tokens' bytes are not those of a space and the text."""
        data = f" {text}".encode()
        a = self.a.encode_batch_fast([f" {text}"], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        same = (b"".join(map(self.bytes_a.__getitem__, a)) == data
                and b"".join(map(self.bytes_b.__getitem__, b)) == data)
        return (np.array(a, dtype="<i4"), np.array(b, dtype="<i4")) if same else None

    def _learn(self, words: list[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids of each word as bytes, of A and of B; a word without tokens is in neither."""
        found = self._encoded(" ".join(words))
        if found is None and len(words) > 1:  # halved until the words that are changed stand alone
            half = len(words) // 2
            (a, b), (c, d) = self._learn(words[:half]), self._learn(words[half:])
            return a | c, b | d
        if found is None:
            return {}, {}
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        out = []
        for ids, size in zip(found, (self.size_a, self.size_b), strict=True):
            to = np.searchsorted(np.cumsum(size[ids]), ends, side="right").tolist()
            data, at = ids.tobytes(), [0, *to[:-1]]
            out.append({w: data[4 * i:4 * j] for w, i, j in zip(words, at, to, strict=True)})
        return out[0], out[1]

    def tokens(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for each part, or None where the tokens' bytes are not those of a space and the part."""
        if not self.cuts_at_spaces:
            yield from map(self._encoded, parts)
            return
        split = [_BETWEEN.split(p) for p in parts]
        if len(self.words_a) > _KEPT:
            self.words_a.clear()
            self.words_b.clear()
        new = list(set().union(*split).difference(self.words_a))
        # White space at the ends of a text would meet the space that joins words.
        alone = [w for w in new if w != w.strip()]
        for some in (*([w] for w in alone), [w for w in new if w == w.strip()]):
            for known, found in zip((self.words_a, self.words_b), self._learn(some) if some else (), strict=False):
                known |= found
        for words in split:
            try:
                a, b = (b"".join(map(known.__getitem__, words)) for known in (self.words_a, self.words_b))
            except KeyError:  # a word that one of them changes
                yield None
            else:
                yield np.frombuffer(a, dtype="<i4").astype(np.int64), np.frombuffer(b, dtype="<i4").astype(np.int64)
        for word in new:
            if len(word) > _KEPT_LENGTH:
                for known in (self.words_a, self.words_b):
                    known.pop(word, None)


@lru_cache(maxsize=2)
def pair_of(path_a: str, path_b: str) -> Pair:
    """The worker's tables of two vocabulary files."""
    return Pair(path_a, path_b)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Indexes of the tokens of A that end where one of B does, in order.

    Both ends ascend. The intervals from ``first`` to ``last`` (indexes of A, inclusive) end in a common end. Each is
    cut at the common end that is nearest to its middle: the ends of A are tried from there outwards, each looked up
    among the ends of B by bisection. An interval in which no end but the last is common is left as it is.
    """
    found = [last]
    while len(first):
        middle, reach = (first + last) // 2, last - first  # so many ends inside
        cut = np.full(len(first), -1)
        trying = np.flatnonzero(reach > 0)
        step = 0
        while len(trying):
            for sign in (1, -1) if step else (1,):
                at = middle[trying] + sign * step
                inside = (at >= first[trying]) & (at < last[trying]) & (cut[trying] < 0)
                at, these = at[inside], trying[inside]
                ends = ends_a[at]
                common = ends_b[np.searchsorted(ends_b, ends)] == ends
                cut[these[common]] = at[common]
            step += 1
            trying = trying[(cut[trying] < 0) & (middle[trying] + step <= np.maximum(last[trying] - 1, middle[trying] * 2 - first[trying]))]
        halved = cut >= 0
        found.append(cut[halved])
        first, last = (np.concatenate([first[halved], cut[halved] + 1]), np.concatenate([cut[halved], last[halved]]))
    return np.sort(np.concatenate(found))


def align(pair: Pair, tokens: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple]:
    """For each text: number of groups, the groups as text with ``;`` behind each, linked pairs of ids, their times."""
    ids_a, ids_b = (np.concatenate([t[k] for t in tokens]) for k in (0, 1))
    ends_a, ends_b = np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b])
    last = np.cumsum([len(a) for a, _ in tokens]) - 1
    first = np.concatenate([[0], last[:-1] + 1])
    cut_a = shared_cuts(ends_a, ends_b, first, last)
    cut_b = np.searchsorted(ends_b, ends_a[cut_a])

    size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    code_a, code_b = ids_a.copy(), ids_b + 2 * len(pair.size_a)
    code_a[cut_a] += len(pair.size_a)
    code_b[cut_b] += len(pair.size_b)
    codes = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    codes[np.arange(len(ids_a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)] = code_a
    codes[np.arange(len(ids_b)) + np.repeat(np.cumsum(size_a), size_b)] = code_b

    groups_to = np.searchsorted(cut_a, last, side="right")
    linked = ids_a[cut_a] * len(pair.size_b) + ids_b[cut_b]
    text = np.repeat(np.arange(len(tokens)), np.diff(groups_to, prepend=0))
    many = len(pair.size_a) * len(pair.size_b)
    both, times = np.unique(text * many + linked, return_counts=True)
    pairs_to = np.searchsorted(both, np.arange(1, len(tokens) + 1) * many)
    at = group = pairs = 0
    for i, (a, b) in enumerate(tokens):
        size = len(a) + len(b)
        written = b"".join(map(pair.written.__getitem__, codes[at:at + size].tolist()))
        yield int(groups_to[i]) - group, written, both[pairs:pairs_to[i]] - i * many, times[pairs:pairs_to[i]]
        at, group, pairs = at + size, int(groups_to[i]), pairs_to[i]


class _Text:
    """What is known of a text whose parts are taken one by one."""

    def __init__(self, parts: int):
        self.open, self.valid = parts, True
        self.n_a = self.n_b = self.n_groups = 0
        self.sha, self.end = hashlib.sha256(), b""
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def take(self, tokens: tuple[np.ndarray, np.ndarray], found: tuple) -> None:
        groups, written, pairs, times = found
        self.n_a += len(tokens[0])
        self.n_b += len(tokens[1])
        self.n_groups += groups
        self.sha.update(self.end + written[:-1])
        self.end = b";"
        self.pairs.append(pairs)
        self.times.append(times)

    def row(self) -> tuple:
        if not self.valid or not self.n_groups:
            return 0, 0, 0, "", np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        pairs, times = self.pairs[0], self.times[0]
        if len(self.pairs) > 1:
            pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
            times = np.bincount(place, weights=np.concatenate(self.times)).astype(np.int64)
        return self.n_a, self.n_b, self.n_groups, self.sha.hexdigest(), pairs, times


def _take_portion(pair: Pair, portion: list[tuple[_Text, str]]) -> None:
    found = list(pair.tokens([part for _, part in portion]))
    good = [i for i, t in enumerate(found) if t is not None]
    for i, aligned in zip(good, align(pair, [found[i] for i in good]) if good else (), strict=True):
        portion[i][0].take(found[i], aligned)
    for (text, _), tokens in zip(portion, found, strict=True):
        text.open -= 1
        text.valid &= tokens is not None


def _rows(texts: list[str | None], pair: Pair) -> Iterator[tuple]:
    waiting: list[_Text] = []
    portion, size = [], 0
    for text in texts:
        parts = pair.parts(text) if text else []
        waiting.append(held := _Text(len(parts)))
        for part in parts:
            portion.append((held, part))
            size += len(part)
            if size >= PORTION:
                _take_portion(pair, portion)
                portion, size = [], 0
        if not portion:
            yield from (t.row() for t in waiting)
            waiting = []
    if portion:
        _take_portion(pair, portion)
    yield from (t.row() for t in waiting)


_ALIGNED = ("doc_id long, _row long, n_a long, n_b long, n_groups long, groups_sha256 string, _pairs array<long>, "
            "_times array<long>")


def _aligned(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    pair = pair_of(path_a, path_b)
    for batch in batches:
        rows = list(_rows(batch.column("text").to_pylist(), pair))
        n_a, n_b, n_groups, sha, pairs, times = zip(*rows, strict=True) if rows else [()] * 6
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, dtype=np.int64), *x])))
                 for x in (pairs, times)]
        numbers = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)]
        columns = [batch.column("doc_id"), batch.column("_row"), *numbers, pa.array(sha, pa.string()), *lists]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ALIGNED.split(", ")])


def align_tokenizers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str = BYTES_VOCABULARY,
                     path_b: str = PIECES_VOCABULARY) -> DataFrame:
    """A row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A is a byte-level vocabulary that encodes a space and the text, B one of pieces that puts the space itself.
    Groups are cut wherever tokens of both end; the last two tokens of a group are a link. The count of a pair of ids
    is the number of its links in all documents; ``n_best`` are links whose count is the highest of their id of B, ties
    included. Texts that are NULL, empty, or that one of the vocabularies changes have no tokens: zeros, and '' for
    the digest. Repeated rows give repeated results and count each time, NULL identifiers stay NULL, other columns are
    ignored, an empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_row"),
                        F.col(text_col).alias("text"))
    # Written, so the numbers of the rows stay.
    aligned = stage(named.mapInArrow(lambda batches: _aligned(batches, path_a, path_b), _ALIGNED), "aligned")
    links = aligned.select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("_link")).select(
        "_row", F.col("_link._pairs").alias("_pair"), F.col("_link._times").alias("_times"))
    pieces = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    of_b = Window.partitionBy(F.pmod("_pair", F.lit(pieces)))  # at most one row for each id of A
    counts = stage(
        links.groupBy("_pair").agg(F.sum("_times").alias("_count"))
        .withColumn("_best", F.col("_count") == F.max("_count").over(of_b)), "pair-counts")
    sums = join_on(links, counts, {"_pair": "_pair"}, "inner", right_is_unique=True).groupBy("_row").agg(
        F.sum(F.when(F.col("_best"), F.col("_times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("_times") * F.col("_count")).alias("count_sum"))
    return aligned.drop("_pairs", "_times").join(sums, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")], "groups_sha256")
