"""Ranked lexical search over posting lists that are cut into geometric blocks.

Documents are dealt into cells of similar ones (the signs of a random projection of their weighted terms). Within a
cell the posting list of every term is clustered: documents go to the nearest of some members of the list, and blocks
of a bounded size are cut along the clusters. A block stores the coordinatewise maximum of its documents' weights,
rounded upwards to a byte per term. A query bounds each block of its terms by the sum of the maxima at its terms. The
best blocks of a query are scored first; the k-th score found there is a threshold, and of all other blocks only
those whose bound lies below it are skipped. Every document among the k best lies in a block of each of its terms,
so the result is that of scoring all documents.

An index belongs to the terms of a bounded number of queries; more queries are taken in turns.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.batches import bound_batches
from starloom.session import scratch_path, stage

BEST = 50
BLOCK = 128
CELL = 8_192
CELL_BYTES = 32 << 20  # of the maxima of a cell's documents
QUERIES, TERMS = 1_000, 16_384  # of one turn
FIRST_BLOCKS = 8
DIMENSIONS, SIGNS = 32, 16

_ONE = 1_000_000  # no weight is larger than this times the weight of its term
_PORTION = 4 << 20
# A-Z become a-z, other signs of ASCII that are no digits or letters become spaces.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _words(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in order, a portion at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + _PORTION)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def terms_of(text: str | None) -> dict[bytes, int]:
    """How often each term occurs."""
    found: Counter = Counter()
    for words in _words(text or ""):
        found.update(words)
    return found


@dataclass(frozen=True)
class Turn:
    """Some queries and their terms, by number."""

    items: list  # identifier of each query
    terms: list[np.ndarray]  # of each query, its term numbers
    vocabulary: list[bytes]


def turns(rows: Iterable[tuple], queries: int = QUERIES, terms: int = TERMS) -> Iterator[Turn]:
    """Queries (identifier, text) in turns of a bounded number of queries and, but for a single query, of terms."""
    items, sets, known = [], [], {}

    def turn() -> Turn:
        return Turn(items, sets, list(known))

    for item, text in rows:
        found = sorted(terms_of(text))
        if items and (len(items) == queries or len(known.keys() | found) > terms):
            yield turn()
            items, sets, known = [], [], {}
        items.append(item)
        sets.append(np.array([known.setdefault(t, len(known)) for t in found], dtype=np.int64))
    if items:
        yield turn()


def _counts(batches: Iterator[pa.RecordBatch], vocabulary: list[bytes]) -> Iterator[pa.RecordBatch]:
    number = {t: i for i, t in enumerate(vocabulary)}
    for batch in batches:
        length, ends, terms, times = [], [0], [], []
        for text in batch.column("text").to_pylist():
            n, found = 0, Counter()
            for words in _words(text or ""):
                n += len(words)
                found.update(map(number.get, words))
            found.pop(None, None)
            length.append(n)
            terms += found.keys()
            times += found.values()
            ends.append(len(terms))
        offsets = pa.array(ends, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (terms, times)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(length, pa.int64()), *lists],
                                         ["doc_id", "n", "terms", "times"])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column one after the other, and where each row begins and the last ends."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


@dataclass(frozen=True)
class Weights:
    """What all documents say about the terms of a turn."""

    documents: int
    length: int
    of_term: np.ndarray

    @classmethod
    def of(cls, counted: DataFrame, terms: int) -> Weights:
        total = counted.where("n > 0").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).first()
        holding = np.zeros(terms, dtype=np.int64)
        for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one per term
            holding[row["term"]] = row["count"]
        top = 2 * total["rows"] + 2
        weights = [math.floor(1000 * math.log(top / (2 * int(df) + 1))) for df in holding]
        return cls(total["rows"], total["n"] or 0, np.array(weights, dtype=np.int64))

    @property
    def step(self) -> np.ndarray:
        """For each term, what one unit of a stored byte stands for."""
        return np.maximum(1, -(-self.of_term * _ONE // 255))

    def parts(self, terms: np.ndarray, times: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What each term adds to the score of its document; ``n`` is the document's length."""
        m = 50 + 50 * n * self.documents // self.length
        return self.of_term[terms] * (1_000_000_000 * times // (1000 * times + 20 * m))


def _directions(terms: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((terms, DIMENSIONS)).astype(np.float32)


def _places(parts: np.ndarray, terms: np.ndarray, begins: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """A unit vector for each document: the projection of its weighted terms."""
    out = np.zeros((len(begins) - 1, DIMENSIONS), dtype=np.float32)
    some = np.flatnonzero(np.diff(begins))
    if len(some):
        weighted = directions[terms] * parts.astype(np.float32)[:, None]
        out[some] = np.add.reduceat(weighted, begins[:-1][some])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _keyed(batches: Iterator[pa.RecordBatch], weights: Weights) -> Iterator[pa.RecordBatch]:
    directions = _directions(len(weights.of_term))
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            some = batch.slice(at, 1024)
            (terms, begins), (times, _) = _flat(some.column("terms")), _flat(some.column("times"))
            n = np.repeat(some.column("n").to_numpy(), np.diff(begins))
            places = _places(weights.parts(terms, times, n), terms, begins, directions)
            key = (places[:, :SIGNS] > 0) @ (1 << np.arange(SIGNS))
            yield some.append_column("key", pa.array(key, pa.int32()))


_INDEX = ("cell long, number int, doc_id long, n long, terms array<int>, times array<int>, term int, members array<int>, "
          "summary binary, kind string")
_COLUMNS = [c.split()[0] for c in _INDEX.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(),
          pa.list_(pa.int32()), pa.binary(), pa.string()]


def _index_rows(kind: str, cell: int, rows: int, **columns) -> pa.RecordBatch:
    given = columns | {"cell": pa.array(np.full(rows, cell), pa.int64()), "kind": pa.array([kind] * rows, pa.string())}
    return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(rows, t)
                                       for c, t in zip(_COLUMNS, _TYPES, strict=True)], _COLUMNS)


def _clusters(members: np.ndarray, places: np.ndarray, block: int) -> list[np.ndarray]:
    """A posting list cut into blocks along its clusters, each around one of the members."""
    blocks = -(-len(members) // block)
    if blocks == 1:
        return [members]
    centres = members[np.linspace(0, len(members) - 1, blocks).astype(np.int64)]
    nearest = np.argmax(places[members] @ places[centres].T, axis=1)
    ordered = members[np.argsort(nearest, kind="stable")]
    return [ordered[i:i + block] for i in range(0, len(ordered), block)]


def _cell(cell: int, docs: pa.Table, weights: Weights, directions: np.ndarray, block: int) -> Iterator[pa.RecordBatch]:
    """The documents of a cell, and the blocks of its posting lists with their maxima."""
    docs = docs.combine_chunks()
    column = {c: docs.column(c).combine_chunks() for c in ("doc_id", "n", "terms", "times")}
    numbers = pa.array(np.arange(docs.num_rows), pa.int32())
    for at in range(0, docs.num_rows, 1024):
        some = numbers.slice(at, 1024)
        yield _index_rows("document", cell, len(some), number=some,
                          **{c: column[c].slice(at, 1024) for c in ("doc_id", "n", "terms", "times")})
    (terms, begins), (times, _) = _flat(column["terms"]), _flat(column["times"])
    row = np.repeat(np.arange(docs.num_rows), np.diff(begins))
    parts = weights.parts(terms, times, column["n"].to_numpy()[row])
    places = _places(parts, terms, begins, directions)
    maxima = np.zeros((docs.num_rows, len(weights.of_term)), dtype=np.uint8)
    maxima[row, terms] = -(-parts // weights.step[terms])  # upwards

    order = np.argsort(terms, kind="stable")
    row, terms = row[order], terms[order]
    edges = np.searchsorted(terms, np.arange(len(weights.of_term) + 1))
    number, out = 0, []
    for term in np.flatnonzero((np.diff(edges) > 0) & (weights.of_term > 0)):
        for members in _clusters(row[edges[term]:edges[term + 1]], places, block):
            out.append((number, term, members, maxima[members].max(axis=0).tobytes()))
            number += 1
            if len(out) == 512:
                yield _block_rows(cell, out)
                out = []
    if out:
        yield _block_rows(cell, out)


def _block_rows(cell: int, blocks: list[tuple]) -> pa.RecordBatch:
    number, term, members, summary = zip(*blocks, strict=True)
    ends = np.concatenate([[0], np.cumsum([len(m) for m in members])])
    return _index_rows(
        "block", cell, len(blocks), number=pa.array(number, pa.int32()), term=pa.array(term, pa.int32()),
        members=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(members), pa.int32())),
        summary=pa.array(summary, pa.binary()))


def _cells(batches: Iterator[pa.RecordBatch], weights: Weights, size: int, block: int) -> Iterator[pa.RecordBatch]:
    """Cells of the documents of a task in their order."""
    directions = _directions(len(weights.of_term))
    cell = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            some = batch.slice(at, size - rows)
            held.append(some)
            rows, at = rows + some.num_rows, at + some.num_rows
            if rows == size:
                yield from _cell(cell, pa.Table.from_batches(held), weights, directions, block)
                held, rows, cell = [], 0, cell + 1
    if rows:
        yield from _cell(cell, pa.Table.from_batches(held), weights, directions, block)


def _bounds(batches: Iterator[pa.RecordBatch], step: np.ndarray, queries: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """For each block and query that has its term, the sum of the block's maxima at the query's terms."""
    asks = np.zeros((len(queries), len(step)), dtype=bool)
    for q, terms in enumerate(queries):
        asks[q, terms] = True
    for batch in batches:
        term = batch.column("term").to_numpy()
        cell, number = batch.column("cell").to_numpy(), batch.column("number").to_numpy()
        maxima = np.frombuffer(b"".join(batch.column("summary").to_pylist()), dtype=np.uint8).reshape(len(term), len(step))
        asked, rows = np.nonzero(asks[:, term])
        found = np.empty(len(rows), dtype=np.int64)
        edges = np.searchsorted(asked, np.arange(len(queries) + 1))
        for q in np.flatnonzero(np.diff(edges)):
            terms, mine = queries[q], slice(edges[q], edges[q + 1])
            found[mine] = maxima[np.ix_(rows[mine], terms)].astype(np.int64) @ step[terms]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell[rows]), pa.array(number[rows], pa.int32()), pa.array(asked, pa.int32()), pa.array(found)],
            ["cell", "number", "query", "bound"])


def _score(blocks: pa.Table, docs: pa.Table, weights: Weights, queries: list[np.ndarray], best: int,
           least: list[int]) -> pa.Table:
    """The best documents of a cell for each query that reach its threshold, among the blocks that were not skipped."""
    none = pa.table({"query": pa.nulls(0, pa.int32()), "doc_id": pa.nulls(0, pa.int64()), "score": pa.nulls(0, pa.int64())})
    if not blocks.num_rows:
        return none
    docs = docs.sort_by("number").combine_chunks()
    column = {c: docs.column(c).combine_chunks() for c in ("doc_id", "n", "terms", "times")}
    wanted = np.zeros((len(queries), docs.num_rows), dtype=bool)
    for members, asked in zip(blocks.column("members").to_pylist(), blocks.column("queries").to_pylist(), strict=True):
        wanted[np.ix_(asked, members)] = True
    (terms, begins), (times, _) = _flat(column["terms"]), _flat(column["times"])
    row = np.repeat(np.arange(docs.num_rows), np.diff(begins))
    parts = weights.parts(terms, times, column["n"].to_numpy()[row])
    order = np.argsort(terms, kind="stable")
    row, parts = row[order], parts[order]
    edges = np.searchsorted(terms[order], np.arange(len(weights.of_term) + 1))
    ids = column["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy()

    query, doc, score = [], [], []
    for q in np.flatnonzero(wanted.any(axis=1)):
        total = np.zeros(docs.num_rows, dtype=np.int64)
        for term in queries[q]:
            mine = slice(edges[term], edges[term + 1])
            some = wanted[q][row[mine]]
            total[row[mine][some]] += parts[mine][some]  # a document is in a list once
        found = np.flatnonzero(total >= least[q])
        found = found[np.lexsort((ids[found], -total[found]))[:best]]
        query.append(np.full(len(found), q))
        doc.append(found)
        score.append(total[found])
    query, doc, score = (np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in (query, doc, score))
    return pa.table({"query": pa.array(query, pa.int32()), "doc_id": column["doc_id"].take(pa.array(doc, pa.int64())),
                     "score": pa.array(score, pa.int64())})


class BlockIndex:
    """Blocks and documents for the terms of a turn, stored in the scratch folder."""

    def __init__(self, docs: DataFrame, vocabulary: list[bytes], cell: int = CELL, block: int = BLOCK):
        """``docs`` has ``doc_id`` and ``text``."""
        spark = docs.sparkSession
        bound_batches(spark)
        counted = stage(docs.mapInArrow(lambda b: _counts(b, vocabulary),
                                        "doc_id long, n long, terms array<int>, times array<int>"), "term-counts")
        self.weights = weights = Weights.of(counted, len(vocabulary))
        cell = max(1, min(cell, CELL_BYTES // max(1, len(vocabulary))))
        holding = counted.where(F.size("terms") > 0)
        keyed = holding.mapInArrow(lambda b: _keyed(b, weights), f"{_schema(holding)}, key int").withColumn(
            "spread", F.xxhash64("doc_id", "n"))
        # Similar documents side by side; a place that very many share is cut by the hash of the identifier.
        tasks = max(1, -(-weights.documents // cell))
        dealt = keyed.repartitionByRange(tasks, "key", "spread").sortWithinPartitions("key", "spread")
        path = scratch_path(spark, "block-index")
        dealt.select("doc_id", "n", "terms", "times").mapInArrow(
            lambda b: _cells(b, weights, cell, block), _INDEX,
        ).write.partitionBy("kind").option("compression", "zstd").parquet(path)
        blocks, documents = (spark.read.schema(_INDEX).parquet(path).where(F.col("kind") == k) for k in ("block", "document"))
        self.blocks = blocks.select("cell", "number", "term", "members", "summary")
        self.documents = documents.select("cell", "number", "doc_id", "n", "terms", "times")

    def bounds(self, queries: list[np.ndarray]) -> DataFrame:
        """``cell, number, query, bound`` for each block of each term of each query."""
        step = self.weights.step
        return self.blocks.select("cell", "number", "term", "summary").mapInArrow(
            lambda b: _bounds(b, step, queries), "cell long, number int, query int, bound long")

    def score(self, chosen: DataFrame, queries: list[np.ndarray], best: int, least: list[int] | None = None) -> DataFrame:
        """``query, doc_id, score, rank``: the best documents in the chosen blocks (``cell, number, query``).

        ``least`` has the score each query asks for, 1 if not given.
        """
        weights, least = self.weights, least or [1] * len(queries)
        asked = chosen.groupBy("cell", "number").agg(F.collect_set("query").alias("queries"))  # at most a turn's
        blocks = self.blocks.select("cell", "number", "members").join(asked, ["cell", "number"])
        found = blocks.groupBy("cell").cogroup(self.documents.groupBy("cell")).applyInArrow(
            lambda b, d: _score(b, d, weights, queries, best, least), "query int, doc_id long, score long")
        rank = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= best)

    def search(self, queries: list[np.ndarray], best: int = BEST, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
        """``query, doc_id, score, rank`` of the best documents with a score above 0."""
        bounds = stage(self.bounds(queries), "bounds")
        place = Window.partitionBy("query").orderBy(F.col("bound").desc(), "cell", "number")
        first = bounds.withColumn("place", F.row_number().over(place)).where(F.col("place") <= first_blocks)
        at_best = self.score(first, queries, best).where(F.col("rank") == best)
        threshold = {r["query"]: r["score"] for r in at_best.collect()}  # one per query of the turn
        least = [threshold.get(q, 1) for q in range(len(queries))]
        asked = F.element_at(F.array(*[F.lit(s).cast("long") for s in least]), F.col("query") + 1)
        return self.score(bounds.where(F.col("bound") >= asked), queries, best, least)


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def search_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     item_col: str = "item_id", item_text: str = "text", best: int = BEST, cell: int = CELL,
                     block: int = BLOCK, queries: int = QUERIES, terms: int = TERMS) -> DataFrame:
    """A row for each of the ``best`` documents of an item: ``item_id, rank, doc_id, score``.

    Documents and items without a term (NULL and empty texts among them) are not ranked. Equal scores are ranked by
    ascending identifier, NULL last. Repeated rows of documents are ranked each by itself, repeated items are
    answered each. Other columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col), F.col(item_text)).where(F.col(item_text).isNotNull())
    kind = items.schema[item_col].dataType.simpleString()
    found = []
    for turn in turns(asked.toLocalIterator(), queries, terms):
        if not turn.vocabulary:
            continue
        index = BlockIndex(named, turn.vocabulary, cell, block)
        if not index.weights.documents:
            break
        ranked = index.search(turn.terms, best)
        names = spark.createDataFrame(list(enumerate(turn.items)), f"query int, item_id {kind}")  # at most a turn's
        found.append(stage(ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
