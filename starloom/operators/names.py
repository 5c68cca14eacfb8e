"""Match free-text names to codes: equal, contained, or misspelt names, by rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import text
from starloom.operators import joins
from starloom.session import stage

# Fixed values of the ranking: an equal name or code is best; a name that
# contains the term earns more the earlier it does; spelling comes last.
EQUAL = 80
CONTAINED_FIRST = 30
CONTAINED_STEP = 2
CONTAINED_LEAST = 5
SPELLING = 4

_GRAM = 3


def match_names(
    names: DataFrame,
    name: str,
    dim: DataFrame,
    dim_name: str,
    dim_key: str,
    out: str,
    replacements: Sequence[tuple[str, str]] = (),
    regex: bool = False,
    passes: int = 2,
    max_distance: int = 0,
    shown: str | None = None,
    **limits,
) -> DataFrame:
    """``name`` and ``out`` for each distinct name that finds a row of ``dim``.

    Pass 1 searches the name itself, pass 2 the name after ``replacements``,
    pass 3 its first word; a later pass counts only if no earlier one hits.
    Within a pass the best rank wins, then the smallest code. ``max_distance``
    (0 to 2) also accepts names that differ by so many single-letter edits.
    ``shown`` names a column for the text that was found, with replacements.
    """
    if passes not in (1, 2, 3) or max_distance not in (0, 1, 2):
        raise ValueError("passes must be 1 to 3 and max_distance 0 to 2")
    replaced = text.replace_chain(F.col(name), replacements, regex)
    terms = [F.col(name), replaced, text.first_token(replaced)][:passes]
    attempts = F.array(*(
        F.struct(F.lit(i).alias("attempt"), t.alias("tried"), text.fold(t).alias("term"))
        for i, t in enumerate(terms, 1)
    ))
    # Stored, so the table the names come from is read once however often they are searched.
    searched = stage(
        names.select(name).where(F.col(name).isNotNull()).distinct()
        .select(name, F.inline(attempts))
        .where("term <> ''"),
        "names",
    )
    index = dim.select(
        text.fold(F.col(dim_name)).alias("__name"), F.col(dim_key).alias("__code")
    ).dropna().distinct()
    if "right_is_small" not in limits and _pieces_fit(index, max_distance, limits):
        limits["right_is_small"] = True

    hits = _equal(searched, index, limits).unionByName(_contained(searched, index, limits))
    if max_distance:
        hits = hits.unionByName(_misspelt(searched, index, max_distance, limits))
    rank = F.struct(F.col("attempt"), (-F.col("points")).alias("points"), F.col("__code"))
    best = hits.groupBy(name).agg(F.min_by(F.struct("__code", "tried"), rank).alias("__best"))
    columns = [F.col(name), F.col("__best.__code").alias(out)]
    return best.select(*columns, *([F.col("__best.tried").alias(shown)] if shown else []))


def _pieces_fit(index: DataFrame, max_distance: int, limits: dict) -> bool:
    """Whether all pieces and segments of the names, each with its name, are few and short enough for a broadcast."""
    length = F.length("__name").cast("double")
    pieces = length + F.lit(max_distance + 3)
    width = F.octet_length("__name") + F.lit(16)
    found = index.agg(F.sum(pieces).alias("rows"), F.sum(pieces * width).alias("bytes")).first()
    return joins.is_small(found["rows"] or 0, found["bytes"] or 0, limits.get("broadcast_rows", joins.BROADCAST_ROWS))


def _equal(searched: DataFrame, index: DataFrame, limits: dict) -> DataFrame:
    """Terms equal to a name or to a code."""
    words = index.select("__code", F.explode(F.array("__name", F.lower(F.col("__code").cast("string")))).alias("word"))
    found = joins.join_on(searched, words.distinct(), {"term": "word"}, "inner", **limits)
    return found.withColumn("points", F.lit(EQUAL))


def _grams(word: Column, size: int) -> Column:
    """Distinct substrings of ``size`` letters."""
    starts = F.sequence(F.lit(1), F.length(word) - F.lit(size - 1))
    return F.when(
        F.length(word) >= size, F.array_distinct(F.transform(starts, lambda i: F.substring(word, i, F.lit(size))))
    )


def _contained(searched: DataFrame, index: DataFrame, limits: dict) -> DataFrame:
    """Terms that are part of a name.

    A name contains a term only if it contains each three-letter piece of it, so
    one piece finds all of them: the piece that the fewest names have. A shorter
    term is a piece itself; of all names that hold it the best one is known
    before the join, so it meets one row.
    """
    name, term = F.col("__name"), F.col("term")

    def points(part: Column) -> Column:
        place = F.position(part, name) - 1
        return F.greatest(F.lit(CONTAINED_LEAST), F.lit(CONTAINED_FIRST) - F.lit(CONTAINED_STEP) * place)

    tiny = index.select("*", F.explode(F.concat(*(
        F.coalesce(_grams(name, n), F.array().cast("array<string>")) for n in range(1, _GRAM)))).alias("piece"))
    best = tiny.groupBy("piece").agg(F.min(F.struct((-points(F.col("piece"))).alias("less"), "__code")).alias("best"))
    short = joins.join_on(searched.where(F.length(term) < _GRAM), best, {"term": "piece"}, "inner",
                          right_is_unique=True, **limits)
    short = short.select(*searched.columns, F.col("best.__code").alias("__code"), (-F.col("best.less")).alias("points"))

    longer = searched.where(F.length(term) >= _GRAM)
    pieces = index.select("*", F.explode(_grams(name, _GRAM)).alias("piece"))
    offered = longer.withColumn("own", F.explode(_grams(term, _GRAM)))
    # Only pieces that some term offers are kept, once, for their count and for the join.
    wanted = offered.select(F.col("own").alias("__wanted")).distinct()
    pieces = stage(pieces.join(wanted, F.col("piece") == F.col("__wanted"), "left_semi"), "pieces")
    spread = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("names"))
    # A piece that no name has rules its whole term out.
    known = joins.join_on(offered, spread, {"own": "piece"}, "left", right_is_unique=True, **limits)
    rarest = (
        known.groupBy(*searched.columns)
        .agg(F.min_by("own", F.struct("names", "own")).alias("own"),
             F.count_if(F.col("names").isNull()).alias("missing"))
        .where("missing = 0").drop("missing")
    )
    found = joins.join_on(rarest, pieces, {"own": "piece"}, "inner", **limits).drop("own")
    found = found.where(F.contains(name, term)).withColumn("points", points(term)).drop("__name")
    return found.unionByName(short)


def _segment(length: Column, segments: int, i: int) -> tuple[Column, Column]:
    """Where the ``i``-th of even segments of a word begins (from 0), and how long it is; the last ones are longer."""
    size = F.floor(length / F.lit(segments)).cast("int")
    longer = length % F.lit(segments)
    return size * F.lit(i) + F.greatest(F.lit(0), longer - F.lit(segments - i)), (
        size + F.when(longer >= F.lit(segments - i), 1).otherwise(0))


def _named(i: int, length: Column, part: Column) -> Column:
    """A segment with its number and the length of its name, as one number; what it finds is compared in full."""
    return F.xxhash64(F.lit(i), length.cast("int"), part)


def _misspelt(searched: DataFrame, index: DataFrame, distance: int, limits: dict) -> DataFrame:
    """Terms within ``distance`` edits of a name.

    A name is cut into one segment more than edits are allowed, so one of them is left as it is. It stands in the
    term no further from its place than the edits before it allow, nor the rest of the term than those behind it. So
    a term offers a number of substrings that depends on ``distance`` only, and an equality join finds every pair.
    """
    segments = distance + 1
    name, term = F.col("__name"), F.col("term")
    length, size = F.length(name), F.length(term)
    cut = []
    for i in range(segments):
        start, width = _segment(length, segments, i)
        cut.append(_named(i, length, F.substring(name, start + 1, width)))
    offered = []
    for longer in range(-distance, distance + 1):  # letters the term has more than the name
        other = size - F.lit(longer)
        for i in range(segments):
            start, width = _segment(other, segments, i)
            for shift in range(-distance, distance + 1):
                if abs(shift) + abs(longer - shift) <= distance:
                    at = start + F.lit(shift)
                    inside = (other > 0) & (at >= 0) & (at + width <= size)
                    offered.append(F.when(inside, _named(i, other, F.substring(term, at + 1, width))))
    left = searched.withColumn("part", F.explode(F.array_distinct(F.array_compact(F.array(*offered)))))
    right = index.withColumn("segment", F.explode(F.array(*cut)))
    edits = F.levenshtein(F.col("term"), F.col("__name"), distance)  # -1 beyond the distance
    return (
        joins.join_on(left, right, {"part": "segment"}, "inner", **limits).drop("part")
        .withColumn("__edits", edits).where("__edits > 0")
        .withColumn("points", F.lit(SPELLING) - F.col("__edits"))
        .drop("__name", "__edits")
    )


def name_lookup(
    df: DataFrame, name: str, dim: DataFrame, dim_name: str, dim_key: str, out: str, no_match=None, **options
) -> DataFrame:
    """Add ``out`` to every row of ``df``: the code of its name, or ``no_match``.

    Only distinct names are searched; the codes are joined back by equality.
    Options are those of :func:`match_names`.
    """
    codes = stage(match_names(df, name, dim, dim_name, dim_key, "__found", **options), "codes")
    limits = {k: v for k, v in options.items() if k in ("broadcast_rows", "rows_per_task", "hot_share")}
    found = joins.join_on(df, codes.withColumnRenamed(name, "__of"), {name: "__of"}, "left", right_is_unique=True, **limits)
    result = F.col("__found")
    if no_match is not None:
        result = F.coalesce(result, F.lit(no_match).cast(dim.schema[dim_key].dataType))
    return found.withColumn(out, result).drop("__found")
