"""Near-duplicate vectors: spherical k-means cells, cosine products in blocks within a cell.

Each vector has a home, the cell of its nearest centre, and visits those cells of a lower number in which a vector
within the allowed angle could be at home. A pair thus meets once, in the cell of the lower number. For unit vectors
x with home h and another centre c, y within the angle d of x can only be nearer to c if x.(h - c) is at most
sin(d)|h - c|; as y lies in no special direction, the bound used is ``REACH`` deviations of tan(d)|h - c|/sqrt(dims),
and the full bound with ``reach=None``. Identical vectors are one class that is compared once. A cell is cut into
blocks of bounded size and each pair of blocks is a matrix product; it gives the number of links of each vector and,
for each vector, the smallest one it is connected to, never the pairs themselves. Vectors of each length have cells of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import connected_components
from starloom.llm.labelled import hash_sample
from starloom.session import stage

LEAST_COSINE = 0.95
SAMPLE_VECTORS = 20_000  # the centres are fitted to about so many; all vectors are assigned
PER_CELL, MOST_CELLS = 500, 2_048
BLOCK = 512
REACH = 4.0
ROUNDS = 10


def _clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        vectors = []
        for v in batch["vector"]:
            v = np.array([] if v is None else v, dtype=np.float64)
            good = len(v) and np.isfinite(v).all() and v.any()
            vectors.append(v.tobytes() if good else None)
        yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "vector": vectors})


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # keeps very large and very small numbers in range
    scaled = vectors / largest
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pd.Series) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(column), dtype=np.float64).reshape(len(column), -1))


def fit_centres(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` unit centres of unit vectors (fewer if there are fewer vectors); the same for the same input."""
    centres = vectors[np.random.default_rng(5).permutation(len(vectors))[:k]].copy()
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def visited_cells(
    units: np.ndarray, centres: np.ndarray, cosine: float, reach: float | None
) -> tuple[np.ndarray, np.ndarray]:
    """Home of each vector, and a mask of the cells it visits."""
    near = units @ centres.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))[home]
    sine = np.sqrt(1 - cosine ** 2)
    bound = sine if reach is None else min(sine, reach * sine / cosine / np.sqrt(units.shape[1]))
    gap = near[np.arange(len(units)), home][:, None] - near
    return home, (gap <= bound * apart + 1e-9) & (np.arange(len(centres))[None, :] < home[:, None])


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows of equal keys together; the input is sorted by them and groups are of bounded size."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        values = batch[keys].to_numpy()
        ends = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        begin = 0
        for end in ends:
            yield batch.iloc[begin:end]
            begin = end
        rest = batch.iloc[begin:]
    if rest is not None and len(rest):
        yield rest


def _connected(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is connected to by the links i-j."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(batches: Iterator[pd.DataFrame], cosine: float) -> Iterator[pd.DataFrame]:
    for group in _groups(batches, ["size", "cell", "one", "other"]):
        group = group.sort_values(["node", "side"], kind="stable")
        side, node, weight = (group[c].to_numpy() for c in ("side", "node", "weight"))
        units = _matrix(group["vector"])
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1)
        if len(b):
            i, j = np.nonzero(units[a] @ units[b].T >= cosine)
            i, j = a[i], b[j]
        else:
            i, j = np.nonzero(np.triu(units[a] @ units[a].T >= cosine, 1))
            i, j = a[i], a[j]
        if not len(i):
            continue
        n = len(node)
        links = np.bincount(i, weights=weight[j], minlength=n) + np.bincount(j, weights=weight[i], minlength=n)
        least = _connected(i, j, n)
        hit = links > 0
        yield pd.DataFrame({"node": node[hit], "links": links[hit].astype(np.int64), "least": node[least[hit]]})


def near_vector_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                      cosine: float = LEAST_COSINE, per_cell: int = PER_CELL, reach: float | None = REACH) -> DataFrame:
    """A row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors are linked if their cosine in double precision is at least ``cosine``. One that is NULL, empty, zero or
    holds a NULL or a number that is not finite is linked with nothing, and so is one whose
    identifier is NULL. Only vectors of equal length can be linked. ``n_links`` counts other rows, repeated ones too. The smallest
    identifier of a component is kept; rows that share an identifier count as one member. An empty table gives an
    empty result; other columns are ignored.
    """
    named = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    clean = stage(named.mapInPandas(_clean, "vec_id long, vector binary"), "vectors")
    valid = clean.where("vector IS NOT NULL AND vec_id IS NOT NULL")
    # Equal vectors are a class; written, so the numbers of the classes stay.
    classes = stage(valid.groupBy("vector").agg(F.count("*").alias("weight")).withColumn(
        "node", F.monotonically_increasing_id()), "classes")
    members = stage(valid.join(classes, "vector").select("vec_id", "node"), "members")
    count = classes.count()
    sample = hash_sample(classes, "vector", count, SAMPLE_VECTORS).select("vector").toPandas()["vector"]
    if count:
        partial = _partials(classes, sample, count, cosine, per_cell, reach)
    else:
        partial = clean.sparkSession.createDataFrame([], "node long, links long, least long")
    partial = stage(partial, "links")
    links = partial.groupBy("node").agg(F.sum("links").alias("_links"))
    # Classes that hold one identifier belong together, whether or not they are linked.
    firsts = members.groupBy("vec_id").agg(F.min("node").alias("b"), F.max("node").alias("_last")).where("b <> _last")
    ties = members.join(firsts, "vec_id").where("node <> b").select(F.col("node").alias("a"), "b")
    components = connected_components(
        partial.select(F.col("node").alias("a"), F.col("least").alias("b")).unionByName(ties))
    of_class = classes.join(links, "node", "left").join(components, "node", "left").select(
        "node", (F.coalesce("_links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "node").alias("_component"))
    placed = stage(members.join(of_class, "node").select("vec_id", "n_links", "_component"), "placed")
    least = placed.groupBy("_component").agg(F.min("vec_id").alias("component_id"))
    linked = placed.join(least, "_component").select("vec_id", "n_links", "component_id")
    alone = clean.where("vector IS NULL OR vec_id IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"))
    # An identifier may stand at vectors that count and at others: all its rows are one member.
    named_already = linked.groupBy("vec_id").agg(F.min("component_id").alias("_found"))
    alone = alone.join(named_already, "vec_id", "left").select(
        "vec_id", "n_links", F.coalesce("_found", "vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id")))


def _partials(classes: DataFrame, sample: pd.Series, count: int, cosine: float, per_cell: int,
              reach: float | None) -> DataFrame:
    """A row for each vector and pair of blocks in which it has links."""
    # Centres for each length in the sample, in proportion; a length that is too rare for it is one cell.
    cells, centres = min(MOST_CELLS, max(1, -(-count // per_cell))), {}
    for size, own in sample.groupby(sample.map(len)):
        centres[size] = fit_centres(_matrix(own), -(-cells * len(own) // len(sample)))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            for size, own in batch.groupby(batch["vector"].map(len)):
                if size in centres:
                    home, visits = visited_cells(_matrix(own["vector"]), centres[size], cosine, reach)
                else:
                    home, visits = np.zeros(len(own), dtype=np.int64), np.zeros((len(own), 1), dtype=bool)
                row, cell = np.nonzero(visits)
                row, cell = np.concatenate([np.arange(len(own)), row]), np.concatenate([home, cell])
                out = own.iloc[row].assign(size=size, cell=cell.astype("int32"), guest=np.arange(len(row)) >= len(own))
                yield out[["size", "cell", "guest", "node", "weight", "vector"]]

    placed = stage(classes.mapInPandas(
        assign, "size int, cell int, guest boolean, node long, weight long, vector binary"), "cells")
    # A row per cell; their number is bounded but for the rare lengths, of which any input has few (n lengths take n^2 / 2
    # numbers).
    blocks = placed.groupBy("size", "cell").agg(
        F.ceil(F.sum(F.when(~F.col("guest"), 1).otherwise(0)) / BLOCK).cast("int").alias("homes"),
        F.ceil(F.sum(F.when(F.col("guest"), 1).otherwise(0)) / BLOCK).cast("int").alias("guests"))
    cut = placed.join(F.broadcast(blocks), ["size", "cell"]).where("homes > 0")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes"))).cast("int")
    cut = cut.withColumn("own", own)
    # Blocks of guests are numbered after those of the cell's own vectors.
    at_home = cut.where("NOT guest").withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("homes") + F.col("guests") - 1)))
    guests = cut.where("guest").withColumn("own", F.col("own") + F.col("homes")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
    dealt = at_home.unionByName(guests).select(
        "size", "cell", F.least("own", "with").alias("one"), F.greatest("own", "with").alias("other"),
        F.when(F.col("own") > F.col("with"), 1).otherwise(0).alias("side"), "node", "weight", "vector")
    return (
        dealt.repartition("size", "cell", "one", "other").sortWithinPartitions("size", "cell", "one", "other")
        .mapInPandas(lambda batches: _compare(batches, cosine), "node long, links long, least long"))
