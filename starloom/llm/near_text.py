"""Near-duplicate texts: b-bit minimum hashes, a multi-index Hamming join, and a check on full sets.

A signature has 40 symbols of 16 bits, cut into ten chunks of four. If two signatures differ in at most 19 symbols,
then, by the pigeonhole principle, some chunk differs in at most one. So each chunk is looked up four times, each time
with another symbol left out: these 40 keys bring together all pairs within distance 19, without exception. A pair
with a similarity of exactly 0.75 is missed with a probability of 1.5 in a million, a more similar one more rarely.

What comes together is not spelt out as pairs. In each bucket the text that meets most others is the hub, and every
member is compared with the hub. Hubs whose members then lie in one component are done. Among the members of the
others, pairs from different components go through a second signature (256 symbols of 8 bits) in blocks of bounded
size, and the pairs within its distance threshold are compared, unless links found before have joined them. Every
comparison that counts is one of full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import bound_batches
from starloom.llm.components import connected_components
from starloom.llm.shingles import minimum_hashes, set_digest, shingle_set
from starloom.operators.joins import counted, shuffled
from starloom.session import stage

WIDTH = 5
SHARE = 75  # percent of the union that must be shared
CHUNKS, SYMBOLS = 10, 4
SECOND = 256
# Of 256 symbols two texts of similarity 0.75 share 192 on average, with a deviation of 7: this is five below.
SECOND_SHARED = 157
BLOCK = 256


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_set(t, WIDTH) for t in batch["text"]]
        symbols: list = [None] * len(sets)
        full = [i for i, s in enumerate(sets) if len(s)]
        if full:
            for i, row in zip(full, minimum_hashes([sets[i] for i in full], CHUNKS * SYMBOLS, 21), strict=True):
                symbols[i] = row.astype(np.uint16).view(np.int16)
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_shingles": [len(s) for s in sets],
                            "set_id": [set_digest(s) if len(s) else None for s in sets], "symbols": symbols})


def _second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_set(t, WIDTH) for t in batch["text"]]
        found = minimum_hashes(sets, SECOND, 31).astype(np.uint8)
        yield pd.DataFrame({"node": batch["node"], "second": [row.tobytes() for row in found]})


def _check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    text = hashes = None
    for batch in batches:
        linked = []
        for one, other in zip(batch["text_a"], batch["text_b"], strict=True):
            if one is not text:
                if one != text:
                    hashes = shingle_set(one, WIDTH)
                text = one
            theirs = shingle_set(other, WIDTH)
            both = len(np.intersect1d(hashes, theirs, assume_unique=True))
            linked.append(100 * both >= SHARE * (len(hashes) + len(theirs) - both))
        yield batch.loc[np.array(linked, dtype=bool), ["a", "b"]]


def linked_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose texts (node, text) share enough of their shingles, on full sets."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # Texts of one hub come one after another, so its set is made once.
    rows = counted(pairs).join(right, "b").join(shuffled(left), "a")
    return rows.select("a", "b", "text_a", "text_b").mapInPandas(_check, "a long, b long").distinct()


def _complete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches, cut so that no group (hub, lo, hi) is parted; groups are of bounded size."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        group = batch[["hub", "lo", "hi"]].to_numpy()
        other = np.flatnonzero((group != group[-1]).any(axis=1)) if len(group) else np.empty(0, dtype=int)
        cut = other[-1] + 1 if len(other) else 0
        rest = batch.iloc[cut:]
        if cut:
            yield batch.iloc[:cut].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def _near_rows(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one group from different components, near in size and in the second signature: i, j, shared."""
    group = rows[["hub", "lo", "hi"]].to_numpy()
    n, component, block = (rows[c].to_numpy() for c in ("n", "component", "block"))
    second = np.frombuffer(b"".join(rows["second"]), dtype=np.uint8).reshape(len(rows), SECOND)
    found, at, shift = [np.empty((3, 0), dtype=np.int64)], np.arange(len(rows)), 1
    while True:
        at = at[at + shift < len(rows)]
        at = at[(group[at] == group[at + shift]).all(axis=1)]
        if not len(at):
            break
        i, j = at, at + shift
        near = (component[i] != component[j]) & (100 * np.minimum(n[i], n[j]) >= SHARE * np.maximum(n[i], n[j]))
        near &= (group[i, 1] == group[i, 2]) | (block[i] != block[j])
        i, j = i[near], j[near]
        shared = (second[i] == second[j]).sum(axis=1)
        near = shared >= SECOND_SHARED
        found.append(np.stack([i[near], j[near], shared[near]]))
        shift += 1
    i, j, shared = np.concatenate(found, axis=1)
    return i, j, shared


def _with_candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in _complete(batches):
        i, j, _ = _near_rows(rows)
        yield rows.iloc[np.union1d(i, j)]


def _links_between(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links that join different components, the likeliest tried first; pairs that are joined by then are passed over."""
    for rows in _complete(batches):
        i, j, shared = _near_rows(rows)
        order = np.argsort(-shared, kind="stable")
        node, component, text = (rows[c].to_numpy() for c in ("node", "component", "text"))
        parent: dict[int, int] = {}
        sets: dict[int, frozenset] = {}

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = parent.get(up, up)
                c = up
            return c

        def hashes(row: int) -> frozenset:
            if node[row] not in sets:
                sets[node[row]] = frozenset(shingle_set(text[row], WIDTH).tolist())
            return sets[node[row]]

        found = []
        for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
            one, other = root(component[a]), root(component[b])
            if one != other:
                x, y = hashes(a), hashes(b)
                both = len(x & y)
                if 100 * both >= SHARE * (len(x) + len(y) - both):
                    parent[max(one, other)] = min(one, other)
                    found.append((node[a], node[b]))
        yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def _bucketed(sets: DataFrame) -> DataFrame:
    """A row (key, node, n, size) for each key that at least two sets have."""
    masks = [[c * SYMBOLS + s for s in range(SYMBOLS) if s != out] for c in range(CHUNKS) for out in range(SYMBOLS)]
    keys = F.array(*[F.xxhash64(F.lit(k), *[F.col("symbols")[s] for s in mask]) for k, mask in enumerate(masks)])
    keyed = sets.select("node", "n", F.explode(keys).alias("key"))
    size = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return stage(keyed.join(shuffled(size), "key"), "buckets")  # 40 rows a set, which the optimizer takes for one


def _hubs(buckets: DataFrame) -> DataFrame:
    """A row (hub, hub_n, node, n) for each member of a bucket; the hub meets most others over all its keys."""
    degree = buckets.groupBy("node").agg(F.sum("size").alias("degree"))
    hub = buckets.join(shuffled(degree), "node").groupBy("key").agg(
        F.max(F.struct("degree", (-F.col("node")).alias("minus"), "n")).alias("hub"))
    return stage(buckets.join(shuffled(hub), "key").select(
        (-F.col("hub.minus")).alias("hub"), F.col("hub.n").alias("hub_n"), "node", "n").distinct(), "hubs")


def _hub_pairs(hubs: DataFrame) -> DataFrame:
    """Each member with its hub, unless their sizes alone rule a link out."""
    return hubs.where(
        f"hub != node AND 100 * least(n, hub_n) >= {SHARE} * greatest(n, hub_n)"
    ).select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()


GROUP = "hub long, lo long, hi long, block long, node long, n long, component long, second binary"


def _open_links(hubs: DataFrame, components: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between members of one hub that lie in different components so far.

    Texts that share a bucket share its hub. The members of a hub are dealt out in pairs of blocks; only rows that
    are near some other row of theirs in the second signature go on and are compared in full.
    """
    named = hubs.join(shuffled(components.withColumnRenamed("component", "_c")), "node", "left").select(
        "hub", "node", "n", F.coalesce("_c", "node").alias("component"))
    mixed = named.groupBy("hub").agg(
        F.min("component").alias("_least"), F.max("component").alias("_most"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("_least != _most").select("hub", "blocks")
    still = stage(named.join(shuffled(mixed), "hub"), "open")
    second = counted(still.select("node").distinct()).join(texts, "node").mapInPandas(
        _second, "node long, second binary")
    dealt = (
        still.join(shuffled(stage(second, "second")), "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hub", F.least("block", "other").cast("long").alias("lo"),
                F.greatest("block", "other").cast("long").alias("hi"), "block", "node", "n", "component", "second")
    )
    groups = ("hub", "lo", "hi")
    near = stage(dealt.repartition(*groups).sortWithinPartitions(*groups).mapInPandas(_with_candidates, GROUP), "near")
    return (
        counted(near).join(texts, "node").repartition(*groups).sortWithinPartitions(*groups)
        .select(*near.columns, "text").mapInPandas(_links_between, "a long, b long")
    )


def near_text_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, n_shingles, component_id, kept``.

    Two texts are linked when their sets of distinct five-word shingles share at least 75 % of the union; a component
    is named by its smallest identifier, and that document is kept. A text of fewer words is one shingle. NULL texts
    and texts without words have no shingle and are linked with nothing. Texts with the same set form one class
    before anything is compared. Rows with one identifier count as one document: it is linked if any of its texts is.
    A NULL identifier is linked with nothing and kept. An empty table gives an empty result; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage(
        named.mapInPandas(_signatures, "doc_id long, n_shingles long, set_id binary, symbols array<smallint>"),
        "signatures")
    whole = signed.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    sets = whole.groupBy("set_id", F.col("n_shingles").alias("n"), "symbols").agg(F.min("doc_id").alias("node"))
    sets = stage(sets, "sets")
    texts = named.select(F.col("doc_id").alias("node"), "text").where("node IS NOT NULL AND text IS NOT NULL")

    buckets = _bucketed(sets)
    hubs = _hubs(buckets)
    links = stage(linked_pairs(_hub_pairs(hubs), texts), "linked")
    more = stage(_open_links(hubs, connected_components(links), texts), "linked")
    # A document with several texts ties its sets together.
    same = whole.join(sets.select("set_id", "node"), "set_id").where("doc_id != node").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b"))
    components = connected_components(links.unionByName(more).unionByName(_several(same, sets)))

    of_set = sets.join(shuffled(components), "node", "left").select(
        "set_id", F.coalesce("component", "node").alias("_of_set"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_of_set", "doc_id"))
    return signed.join(of_set, "set_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _several(same: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of documents that stand for one set and are members of another, or of several."""
    ends = same.select("a").groupBy("a").count().where("count > 1").select("a").unionByName(
        same.join(shuffled(sets.select(F.col("node").alias("a"))), "a", "left_semi").select("a")).distinct()
    return same.join(ends, "a", "left_semi").distinct()


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose identifier is the smallest of its component."""
    kept = near_text_components(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept"]), "left_semi")
