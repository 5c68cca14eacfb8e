"""Piece encoding as a max-plus scan: giant documents are cut into chunks that are solved by themselves.

An encoding is the cut of a text into vocabulary pieces with the largest sum of scores. A piece may reach over the
border of two chunks, so a chunk yields a matrix: entry (s, t) is the best score of covering it if the chunk before
has already covered its first s characters and its own last piece covers t characters of the next one. Matrices are
combined associatively (the largest of sums), in groups of bounded size and as many levels as the longest document
needs. Going down the levels again fixes the states at all borders, and every chunk is traced back by itself.

No piece spans the place where a word ends and white space begins, or a character that no piece holds; between such
places the best cut of a word is remembered, and a document of one chunk is the cuts of its words. A character without
a piece is written as bytes.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import bound_batches
from starloom.session import stage

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
CHUNK = 16_384
GROUP = 64  # matrices combined at a time
ROWS = 1_024  # matrices to a task
_SPACE = "▁"
_BORDER = re.compile(f"(?<=[^{_SPACE}]){_SPACE}")
PART = 1 << 20  # characters that are encoded at a time, since they stand in memory in several forms
_KEPT, _KEPT_LENGTH = 64 << 20, 64  # bytes of words that a worker remembers, and letters of one; only the speed depends on them
_LOWEST = 10.0  # so far below the lowest score lies a character without a piece


class Vocabulary:
    """Pieces with ids and scores, and the best cuts made of them."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.names: list[bytes] = []
        self.bytes = [0] * 256
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
                self.names.append(bytes([int(name[3:5], 16)]))
                continue
            self.names.append(b"" if model.is_control(i) or model.is_unknown(i) else name.encode())
            if self.names[-1]:
                self.pieces[name] = (i, float(model.get_score(i)))
        self.lowest = min(score for _, score in self.pieces.values()) - _LOWEST
        self.longest = max(map(len, self.pieces))
        self.starts = {p[:n] for p in self.pieces for n in range(1, len(p) + 1)}
        self.single = frozenset(p for p in self.pieces if len(p) == 1)
        self.found = ahocorasick.Automaton()  # all pieces in a text by one pass over it
        for piece, (i, score) in self.pieces.items():
            self.found.add_word(piece, (len(piece) - 1, i, score, np.array([i], "<u4").tobytes()))
        self.found.make_automaton()
        known = "".join(map(re.escape, sorted({c for p in self.pieces for c in p} - {_SPACE})))
        self.unit = re.compile(f"{_SPACE}*[{known}]+|{_SPACE}+|[^{_SPACE}{known}]+")  # no piece spans two of these
        if any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in self.pieces):
            raise ValueError("a piece of this vocabulary spans the end of a word")
        self.scores = np.zeros(len(self.names))  # of a character written as bytes, the first one has the score
        for i, score in self.pieces.values():
            self.scores[i] = score
        self.scores[[i for b, i in enumerate(self.bytes) if not 0x80 <= b < 0xC0]] = self.lowest
        self.words: dict[str, bytes] = {}
        self.room = _KEPT

    def edges(self, text: str, i: int) -> Iterator[tuple[int, int, float]]:
        """(end, id, score) of the pieces that begin at character ``i``; id -1 is a character written as bytes."""
        single = False
        for end in range(i + 1, min(len(text), i + self.longest) + 1):
            part = text[i:end]
            if part not in self.starts:
                break
            if found := self.pieces.get(part):
                single |= end == i + 1
                yield end, *found
        if not single:
            yield i + 1, -1, self.lowest

    def best(self, text: str, begin: int, most: int) -> tuple[list[float], list[tuple[int, int]]]:
        """Best score of covering text[begin:j] for each j up to the end, starting no piece at ``most`` or later.

        The automaton gives the pieces by their ends, the longest of an end first, so of equal sums the longest last
        piece stays, as it does in the search forwards, which texts with characters written as bytes take.
        """
        score = [-np.inf] * (len(text) + 1)
        back = [(-1, -1)] * (len(text) + 1)
        score[begin] = 0.0
        if self.single.issuperset(text):
            for last, (before, number, weight, _) in self.found.iter(text, begin):
                start = last - before
                if start < most and score[start] + weight > score[last + 1]:
                    score[last + 1], back[last + 1] = score[start] + weight, (start, number)
            return score, back
        for i in range(begin, min(most, len(text))):
            if score[i] > -np.inf:
                for end, number, weight in self.edges(text, i):
                    if score[i] + weight > score[end]:
                        score[end], back[end] = score[i] + weight, (i, number)
        return score, back

    def trace(self, text: str, back: list[tuple[int, int]], begin: int, end: int) -> bytes:
        ids: list[int] = []
        while end > begin:
            start, number = back[end]
            ids += [self.bytes[b] for b in reversed(text[start:end].encode())] if number < 0 else [number]
            end = start
        return np.array(ids[::-1], dtype="<u4").tobytes()

    def word(self, unit: str) -> bytes:
        found = self.words.get(unit)
        if found is None:
            found = self.cut(unit)
            if self.room > 0 and len(unit) <= _KEPT_LENGTH:
                self.words[unit] = found
                self.room -= sys.getsizeof(unit) + sys.getsizeof(found) + 40  # and its place in the dictionary
        return found

    def cut(self, unit: str) -> bytes:
        """Ids of a unit: as by ``best`` and ``trace`` over all of it, without their states."""
        if not self.single.issuperset(unit):
            return self.trace(unit, self.best(unit, 0, len(unit))[1], 0, len(unit))
        score, back = [0.0] + [-np.inf] * len(unit), [None] * (len(unit) + 1)
        for last, hit in self.found.iter(unit):
            reached = score[last - hit[0]] + hit[2]
            if reached > score[last + 1]:
                score[last + 1], back[last + 1] = reached, hit
        ids, end = [], len(unit)
        while end:
            hit = back[end]
            ids.append(hit[3])
            end -= hit[0] + 1
        return b"".join(ids[::-1])

    def whole(self, text: str) -> tuple[float, bytes]:
        """Score and ids of a text that begins and ends where no piece reaches over."""
        known, word = self.words.get, self.word
        ids = b"".join([known(unit) or word(unit) for unit in self.unit.findall(text)])
        return float(self.scores[np.frombuffer(ids, "<u4")].sum()), ids

    def borders(self, text: str, size: int) -> tuple[int, int] | None:
        """First and last place in text[:size] that no piece spans."""
        first = _BORDER.search(text, 0, size)
        if first is None:
            return None
        last = text.rfind(_SPACE, 0, size)
        while text[last - 1] == _SPACE:  # there is a border, so this ends before the first character
            last = text.rfind(_SPACE, 0, last)
        return first.start(), last

    def matrix(self, text: str, size: int) -> np.ndarray:
        """Transfer matrix of a chunk of ``size`` characters; ``text`` goes on beyond it by what a piece can reach.

        What lies between the first and the last border adds the same to all entries and so changes no choice of
        states; it is left out here and searched once, when the chunk is traced.
        """
        n = self.longest
        out = np.full((n, n), -np.inf)
        borders = self.borders(text, size)
        if borders is None:
            for s in range(min(n, size + 1)):
                score, _ = self.best(text, s, size)
                out[s, :len(text) - size + 1] = score[size:size + n]
            if size < n:  # a piece can reach over the whole chunk
                for s in range(size, n):
                    out[s, s - size] = max(out[s, s - size], 0.0)
            return out
        first, last = borders
        right, _ = self.best(text[last:], 0, size - last)
        for s in range(min(n, first + 1)):
            left, _ = self.best(text[:first], s, first)
            out[s, :len(text) - size + 1] = left[first] + np.array(right[size - last:size - last + n])
        return out

    def traced(self, text: str, size: int, enter: int, leave: int) -> tuple[float, bytes]:
        """Score and ids of a chunk between two states."""
        borders = self.borders(text, size)
        if enter >= size:
            return 0.0, b""
        if borders is None:
            score, back = self.best(text, enter, size)
            return score[size + leave], self.trace(text, back, enter, size + leave)
        first, last = borders
        left, left_back = self.best(text[:first], enter, first)
        right, right_back = self.best(text[last:], 0, size - last)
        middle = self.whole(text[first:last])
        end = size - last + leave
        return (left[first] + middle[0] + right[end],
                self.trace(text, left_back, enter, first) + middle[1] + self.trace(text[last:], right_back, 0, end))

    def decode(self, ids: bytes) -> str:
        """The characters that the ids stand for, white space as the mark."""
        return b"".join([self.names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The worker's copy of a vocabulary file."""
    return Vocabulary(path)


def marked(text: str | None) -> str:
    """The text as it is encoded: spaces as marks, one in front; nothing for an empty text."""
    return _SPACE + text.replace(" ", _SPACE) if text else ""


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: the matrix of two neighbouring stretches."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches in parts of some ``PART`` characters; a longer text is a part by itself."""
    for batch in batches:
        ends = np.cumsum([len(t or "") for t in batch["text"]]) // PART
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(batch)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            yield batch.iloc[begin:end].reset_index(drop=True)


def _chunks(batches: Iterator[pd.DataFrame], path: str, size: int) -> Iterator[pd.DataFrame]:
    reach = vocabulary(path).longest
    for batch in batches:
        for doc, row, text in batch[["doc_id", "row", "text"]].itertuples(index=False):
            whole = marked(text)
            begins = list(range(0, max(1, len(whole)), size))
            for at in range(0, len(begins), 256):
                some = begins[at:at + 256]
                out = pd.DataFrame({"row": row, "chunk": [b // size for b in some], "chunks": len(begins),
                                    "size": [len(whole[b:b + size]) for b in some],
                                    "text": [whole[b:b + size + reach] for b in some]})
                yield out.assign(doc_id=pd.array([None if pd.isna(doc) else int(doc)] * len(some), dtype="Int64"))


CHUNKS = "row long, chunk long, chunks long, size long, text string, doc_id long"
STEP = "row long, at long, matrix binary"
STATES = "row long, at long, enter long, leave long"


def _read(matrix: bytes) -> np.ndarray:
    found = np.frombuffer(matrix, dtype=np.float64)
    side = int(len(found) ** 0.5)
    return found.reshape(side, side)


def _groups(batches: Iterator[pd.DataFrame], group) -> Iterator[list[tuple]]:
    """What ``group`` gives for the rows of each group, by batch; the rows come in order, a group over any batches."""
    rows, known = [], None
    for batch in batches:
        found = []
        for row in batch.itertuples(index=False, name=None):
            key = row[0], row[1] // GROUP
            if key != known:
                if rows:
                    found += group(rows)
                rows, known = [], key
            rows.append(row)
        yield found
    yield group(rows) if rows else []


def _combine_group(rows: list[tuple]) -> list[tuple]:
    """``row, at, matrix`` of the stretch that rows of these make up."""
    total = _read(rows[0][2])
    for _, _, other in rows[1:]:
        total = combine(total, _read(other))
    return [(rows[0][0], rows[0][1] // GROUP, total.tobytes())]


def _split_group(rows: list[tuple]) -> list[tuple]:
    """``row, at, enter, leave`` inside a group whose outer states are known (``row, at, matrix, enter, leave``)."""
    steps = [_read(row[2]) for row in rows]
    enter, leave = rows[0][3:]
    forward, back = [steps[0][enter]], []
    for step in steps[1:]:
        through = forward[-1][:, None] + step
        back.append(through.argmax(axis=0))
        forward.append(through.max(axis=0))
    states = [leave]
    for choice in reversed(back):
        states.append(int(choice[states[-1]]))
    states = [*states, enter][::-1]
    return [(*row[:2], before, after) for row, before, after in zip(rows, states[:-1], states[1:], strict=True)]


def border_states(chunks: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``row, at, enter, leave`` for each chunk of documents with several."""
    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in batches:
            yield pd.DataFrame({"row": batch["row"], "at": batch["chunk"], "matrix": [
                words.matrix(t, s).tobytes() for t, s in zip(batch["text"], batch["size"], strict=True)]})

    def grouped(level: DataFrame, counted: DataFrame) -> DataFrame:  # small rows with much work: their bytes are no measure of it
        tasks = 1 + counted.count() // ROWS
        return level.withColumn("part", F.floor(F.col("at") / GROUP)).repartition(tasks, "row", "part")

    def combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in _groups(batches, _combine_group):
            yield pd.DataFrame(found, columns=["row", "at", "matrix"])

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in _groups(batches, _split_group):
            yield pd.DataFrame(found, columns=["row", "at", "enter", "leave"])

    levels = [stage(chunks.mapInPandas(matrices, STEP), "matrices")]
    while (levels[-1].agg(F.max("at")).first()[0] or 0) > 0:
        level = grouped(levels[-1], levels[-1]).select("row", "at", "matrix").sortWithinPartitions("row", "at")
        levels.append(stage(level.mapInPandas(combined, STEP), "matrices"))
    states = levels[-1].select("row", "at", F.lit(0).cast("long").alias("enter"), F.lit(0).cast("long").alias("leave"))
    for level in reversed(levels[:-1]):
        known = states.select("row", F.col("at").alias("part"), "enter", "leave")
        # Dealt after the join, whose own shuffle may be of any kind, so that a group stays in one task.
        met = level.withColumn("part", F.floor(F.col("at") / GROUP)).join(known, ["row", "part"]).drop("part")
        met = grouped(met, level).select("row", "at", "matrix", "enter", "leave").sortWithinPartitions("row", "at")
        states = stage(met.mapInPandas(split, STATES), "states")
    return states


OUTPUT = "doc_id long, chunk long, score double, n_ids long, ids binary, text string"
Then = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY,
                  chunk: int = CHUNK, then: Then = iter, fields: str = OUTPUT) -> DataFrame:
    """A row per chunk: ``doc_id, chunk, score, n_ids, ids, text``; ids are little-endian 32-bit numbers.

    The ids of a document are those of its chunks in order, and ``text`` is what they stand for, so that the texts of
    a document in order are its text with marks (``unmarked`` takes them off). NULL and empty texts are one chunk
    without ids. Repeated rows give repeated results, a NULL identifier stays, an empty table gives an empty result,
    other columns are ignored. Of several best cuts the one with longer pieces first is taken within a chunk.
    ``then`` makes rows of ``fields`` out of batches of these, in the worker that encodes: a mapInPandas behind this one
    would hold a second worker with a vocabulary of its own for each task.
    """
    bound_batches(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.length("text"), F.lit(0)) >= chunk

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in _parts(batches):
            texts = [marked(t) for t in batch["text"]]
            found = [words.whole(t) for t in texts]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "chunk": 0, "score": [float(s) for s, _ in found],
                "n_ids": [len(i) // 4 for _, i in found], "ids": [i for _, i in found], "text": texts})

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in _parts(batches):
            rows = []
            for doc, number, text, size, enter, leave in batch[
                    ["doc_id", "chunk", "text", "size", "enter", "leave"]].itertuples(index=False):
                score, ids = words.traced(text, size, enter, leave)
                rows.append((doc, number, score, len(ids) // 4, ids, text[enter:size + leave]))
            out = pd.DataFrame(rows, columns=["doc_id", "chunk", "score", "n_ids", "ids", "text"])
            yield out.assign(doc_id=batch["doc_id"].astype("Int64").to_numpy()).astype({"doc_id": "Int64"})

    numbered = stage(named.where(is_long).withColumn("row", F.monotonically_increasing_id()), "long")
    chunks = numbered.mapInPandas(lambda batches: _chunks(batches, path, chunk), CHUNKS)
    chunks = stage(chunks.repartition("row", "chunk"), "chunks")  # the chunks of one text go to many tasks
    states = border_states(chunks, path)
    known = chunks.join(states.withColumnRenamed("at", "chunk"), ["row", "chunk"])
    traced = known.mapInPandas(lambda batches: then(trace(batches)), fields)
    return named.where(~is_long).mapInPandas(lambda batches: then(encode(batches)), fields).unionByName(traced)


def decode_pieces(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The rows of ``encode_pieces`` with ``decoded`` in place of the text: what the ids stand for."""
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in batches:
            yield batch.assign(doc_id=batch["doc_id"].astype("Int64"), decoded=[words.decode(i) for i in batch["ids"]])

    fields = "doc_id long, chunk long, score double, n_ids long, ids binary, decoded string"
    return encoded.select("doc_id", "chunk", "score", "n_ids", "ids").mapInPandas(decode, fields)


def unmarked(text: str) -> str:
    """The text behind the marks."""
    return text.replace(_SPACE, " ")[1:]


DIGESTS = "doc_id long, chunk long, score double, n_ids long, n_chars long, ids_crc32 long, round_trip boolean"


def ids_crc32(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For queries: the ids as a digest, and whether decoding them gives the text back."""
    for batch in batches:
        words = vocabulary(VOCABULARY)
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].astype("Int64"), "chunk": batch["chunk"], "score": batch["score"],
            "n_ids": batch["n_ids"], "n_chars": [len(t) for t in batch["text"]],
            "ids_crc32": [zlib.crc32(i) for i in batch["ids"]],
            "round_trip": [words.decode(i) == t for i, t in zip(batch["ids"], batch["text"], strict=True)]})
