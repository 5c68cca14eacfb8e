"""Documents packed into sequences of a fixed length: large pieces are matched in pairs, small ones best-fit the gaps.

Only longer documents are cut. How pieces combine depends on their lengths alone, and there are at most ``CAPACITY``
different lengths, so the plan is made from a histogram: a table of patterns (which lengths share a sequence, and how
often) of a size that does not grow with the corpus. Spark then numbers the pieces of each length and every piece
finds its pattern and its place by that number. A sequence holds at most two pieces of over a third of the capacity;
they are matched greedily, the largest with the largest that fits. Smaller pieces, the longest first, go where the
least room is left.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from starloom.llm.batches import bound_batches
from starloom.operators.joins import shuffled
from starloom.session import stage

CAPACITY = 2048
SEPARATOR = 0
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ROWS_PER_PART = 20_000

# A word of plain Latin letters and the signs behind it are two units of the tokenizer, whatever stands around them.
_SIGNS = b"!#$%&()*,.:;?-"
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!#$%&()*,.:;?-]*)")
# What a worker remembers, as numbers of entries and bytes of one; only the speed depends on it.
_KEPT_WORDS, _KEPT_UNITS, _KEPT_LENGTH = 250_000, 400_000, 64


class _Words:
    """Ids of white-space separated words as bytes, remembered; the same ids as for the whole text.

    The tokenizer drops white space, and none of its units spans any, so a text's ids are those of its words in
    order. Unknown words are encoded many at a time: the last token of each unit says so in its name.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.units: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]  # without places in the text
        return np.array(found.ids, dtype="<u4")

    def _learn_units(self, units: set[str]) -> None:
        new = [u for u in units if u not in self.units]
        for at in range(0, len(new), 2000):
            some = new[at:at + 2000]
            ids = self._encode(" ".join(some))
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):
                data, to = ids.tobytes(), ends.tolist()
                self.units.update((u, data[4 * i:4 * j]) for u, i, j in zip(some, [0, *to[:-1]], to, strict=True))
            else:
                self.units.update((u, self._encode(u).tobytes()) for u in some)

    def learn(self, words: set[bytes]) -> None:
        """Ids of words that are not remembered."""
        plain, others = {}, []
        for word in words:
            stem = word.rstrip(_SIGNS)
            if stem.isalpha():  # letters of ASCII only
                plain[word] = stem.lower().decode(), word[len(stem):].decode()
            elif m := _PLAIN.fullmatch(word.decode()):
                plain[word] = m[1].lower(), m[2]
            else:
                others.append(word)
        units = {u for pair in plain.values() for u in pair if u}
        self._learn_units(units)
        for word, (stem, signs) in plain.items():
            self.words[word] = self.units[stem] + self.units[signs] if signs else self.units[stem]
        for word in others:
            self.words[word] = self._encode(word.decode()).tobytes()
        for unit in units:
            if len(unit) > _KEPT_LENGTH:
                del self.units[unit]

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        split = [t.encode().split() for t in texts]  # bytes are split at ASCII white space only
        here = set().union(*split)
        if len(self.words) > _KEPT_WORDS:  # those that occur now are likely to come again
            self.words = {w: self.words[w] for w in here.intersection(self.words)}
        if len(self.units) > _KEPT_UNITS:
            self.units.clear()
        known = self.words
        new = here.difference(known)
        self.learn(new)
        for words in split:
            yield b"".join(map(known.__getitem__, words))
        for word in new:
            if len(word) > _KEPT_LENGTH:
                del known[word]


@lru_cache(maxsize=2)
def words_of(path: str) -> _Words:
    """The worker's word table of a vocabulary file."""
    return _Words(path)


def _portions(texts: list[str]) -> Iterator[list[int]]:
    """Indexes of texts of about four million characters together."""
    at, size = [], 0
    for i, text in enumerate(texts):
        at.append(i)
        size += len(text)
        if size >= 4_000_000:
            yield at
            at, size = [], 0
    if at:
        yield at


def _pieces(batches: Iterator[pd.DataFrame], path: str, capacity: int) -> Iterator[pd.DataFrame]:
    end = np.array([SEPARATOR], dtype="<u4").tobytes()
    for batch in batches:
        texts = [t if isinstance(t, str) else "" for t in batch["text"]]
        for portion in _portions(texts):
            found = []
            for i, ids in zip(portion, words_of(path).ids([texts[i] for i in portion]), strict=True):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + capacity)]
                    found.append((batch["doc_id"].iloc[i], piece, start, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(found, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY,
                 capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32``; NULL texts count as empty (one separator)."""
    bound_batches(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(lambda batches: _pieces(batches, path, capacity), PIECES)


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns for pieces of the given lengths: (lengths of one sequence, number of such sequences)."""
    third = capacity // 3
    left = {n: c for n, c in histogram.items() if c}
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by room left

    def put(pattern: tuple[int, ...], count: int) -> None:
        open_bins.setdefault(capacity - sum(pattern), []).append((pattern, count))

    large = sorted(n for n in left if n > third)
    while large:
        a = large[-1]
        fits = [n for n in large if n <= capacity - a]
        b = fits[-1] if fits else None
        if b is None:
            put((a,), left.pop(a))
            large.pop()
        elif a == b:
            pairs, single = divmod(left.pop(a), 2)
            large.pop()
            if pairs:
                put((a, a), pairs)
            if single:
                b = next((n for n in reversed(large) if n <= capacity - a), None)
                put((a,) if b is None else (a, b), 1)
                if b is not None:
                    left[b] -= 1
                    if not left[b]:
                        large.remove(b)
                        del left[b]
        else:
            count = min(left[a], left[b])
            put((a, b), count)
            for n in (a, b):
                left[n] -= count
                if not left[n]:
                    large.remove(n)
                    del left[n]
    rooms = sorted(open_bins)
    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            at = bisect_left(rooms, n)
            if at == len(rooms):  # no room anywhere: new sequences of this length
                full = capacity // n
                bins = max(1, count // full)
                many = min(full, count)
                pattern, used = (n,) * many, bins
            else:
                room = rooms[at]
                pattern, there = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
                many = min(room // n, count)
                used = min(there, count // many)
                if there > used:
                    _add(open_bins, rooms, room, (pattern, there - used))
                pattern = pattern + (n,) * many
            count -= used * many
            _add(open_bins, rooms, capacity - sum(pattern), (pattern, used))
    return [found for room in rooms for found in open_bins[room]]


def _add(open_bins: dict, rooms: list[int], room: int, found: tuple) -> None:
    if room not in open_bins:
        open_bins[room] = []
        insort(rooms, room)
    open_bins[room].append(found)


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """For each length, runs of places: (length, number of the first, of the last, first sequence, offset)."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for n in pattern:
            first = taken.get(n, 0)
            rows.append((n, first, first + count - 1, sequence, offset))
            taken[n] = first + count
            offset += n
        sequence += count
    return rows


SLOTS = T.StructType([T.StructField(n, T.LongType()) for n in ("length", "first", "last", "sequence", "offset")])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; every sequence is filled from 0 without a gap."""
    spark = pieces.sparkSession
    pieces = stage(pieces, "pieces")
    parts = max(64, pieces.count() // ROWS_PER_PART)
    dealt = pieces.withColumn(
        "_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(parts)))
    sizes = stage(dealt.groupBy("length", "_part").agg(F.count("*").alias("_n")), "sizes")
    # At most ``capacity`` rows, however large the corpus.
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = spark.createDataFrame(_slots(plan_sequences(histogram, capacity)), SLOTS)

    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = dealt.withColumn("_row", F.row_number().over(within) - 1).join(
        shuffled(begins), ["length", "_part"]).select(*pieces.columns, (F.col("_before") + F.col("_row")).alias("_number"))
    # The table of places is bounded by the patterns; each length looks in its own runs only.
    runs = slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "last", "sequence", "offset"))).alias("_runs"))
    run = F.element_at(F.filter("_runs", lambda r: (r["first"] <= F.col("_number")) & (F.col("_number") <= r["last"])), 1)
    return numbered.join(F.broadcast(runs), "length").withColumn("_run", run).select(
        *pieces.columns, (F.col("_run.sequence") + F.col("_number") - F.col("_run.first")).alias("sequence_id"),
        F.col("_run.offset").alias("offset"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY,
                   capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and a final 0; longer ones are cut every ``capacity`` ids. NULL and empty texts are a single
    0. Repeated rows are packed as often as they come, NULL identifiers stay NULL, an empty table gives an empty
    result, other columns are ignored.
    """
    return pack(token_pieces(docs, id_col, text_col, path, capacity), capacity)
