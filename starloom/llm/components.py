"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import shuffled
from starloom.session import stage

COPIED_LINKS = 100_000  # with more of them no side of a join is copied to all tasks, whatever its files take


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """A row ``node, component`` for each node that has a link to another; the component is its smallest node.

    Each round hangs the larger neighbours of every node, then the smaller ones, below the smallest, until nothing
    changes; the number of rounds grows with the logarithm of the longest path. Rounds are written to the scratch
    folder. A hub with very many links only meets a join that AQE can split and sums that are formed before the
    shuffle. Repeated links, links to oneself and links with a NULL end change nothing.
    """
    now = stage(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links")
    state = _state(now)
    while state[0]:
        side = shuffled if state[0] > COPIED_LINKS else (lambda df: df)
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        larger = both.where("y > x").join(side(least), "x").select(
            F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        below = larger.groupBy("u").agg(F.min("v").alias("m"))
        joined = larger.join(side(below), "u")
        now = stage(
            joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(below.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
