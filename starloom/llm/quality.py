"""A quality score from a sparse ensemble of rules over statistics of the text.

Shallow trees, fitted to labelled documents, offer their paths as rules: conjunctions of thresholds. A logistic
regression with a lasso penalty weighs them and drops most. What is left is one Spark column expression, so scoring
needs neither the trees nor a model object. Rows of the training sample are bounded; statistics are of whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import bound_batches
from starloom.llm.labelled import SAMPLE_ROWS, labelled_sample, labelled_texts
from starloom.llm.shingles import word_hashes
from starloom.session import stage

STATISTICS = (
    "log_words", "word_length", "upper", "symbols", "digits", "ends_odd", "distinct_words", "top_word", "repeats",
    "distinct_pairs", "lines_repeated", "line_words", "sentence_marks", "high_bytes", "long_word",
)
TREES, DEPTH, LASSO = 24, 3, 0.001
_SYMBOLS = [b for b in b"#$%&*+/<=>@[\\]^_`{|}~!"]
_MARKS = [b for b in b".?;:,"]
_WHITE = " \t\n\x0b\x0c\r"


def _statistics(text: str | None) -> list[float]:
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words = word_hashes(text)
    n, m = len(raw), len(words)
    if not m:
        return [0.0] * len(STATISTICS)
    count = np.bincount(raw, minlength=256)
    space = int(count[[9, 10, 11, 12, 13, 32]].sum())
    solid = n - space
    letters = max(1, int(count[65:91].sum() + count[97:123].sum()))
    _, times = np.unique(words, return_counts=True)
    pairs = np.unique(words[1:] ^ (words[:-1] << np.uint64(1)))
    lines = [x for x in (text or "").split("\n") if x.strip(_WHITE)]  # what is blank to the words is blank here
    blank = np.flatnonzero(np.isin(np.append(raw, 32), (9, 10, 11, 12, 13, 32)))
    before = raw[blank[blank > 0] - 1]
    return [
        float(np.log1p(m)), solid / m, count[65:91].sum() / letters, count[_SYMBOLS].sum() / solid,
        count[48:58].sum() / solid, float(np.isin(before, _SYMBOLS).sum()) / m, len(times) / m ** 0.9,
        times.max() / m, float((words[1:] == words[:-1]).sum()) / m, len(pairs) / max(1, m - 1),
        1 - len(set(lines)) / len(lines), float(np.log1p(m / len(lines))), count[_MARKS].sum() / m,
        count[128:].sum() / solid, float(np.log1p(np.diff(blank, prepend=-1).max())),
    ]


def _append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.schema.get_field_index("_row")
        found = np.array([_statistics(t) for t in batch.column("_text").to_pylist()], dtype=float)
        found = found.reshape(batch.num_rows, len(STATISTICS))
        yield pa.RecordBatch.from_arrays([batch.column(rows), *[pa.array(c) for c in found.T]], ["_row", *STATISTICS])


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows as a struct ``_row``, and the statistics of each whole text; all are 0 for a text without words."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("_text"))
    schema = T.StructType([rows.schema["_row"], *[T.StructField(s, T.DoubleType()) for s in STATISTICS]])
    return rows.mapInArrow(_append, schema)


Rule = tuple[tuple[str, str, float], ...]  # (statistic, "<=" or ">", threshold), all of which hold


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``score`` is the probability of label 1."""
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(condition(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def condition(rule: Rule) -> Column:
    """The rule as a column of the statistics."""
    parts = [F.col(s) <= t if sign == "<=" else F.col(s) > t for s, sign, t in rule]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole & part
    return whole


def tree_paths(description: str) -> list[Rule]:
    """The distinct paths from the root to each inner and outer node, from the printed form of a forest."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, str, float]]] = []
    for line in description.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if line.strip().startswith("Tree "):
            path = []
        elif found:
            depth = len(found[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (STATISTICS[int(found[2])], found[3], float(found[4]))))
            rules[tuple(sorted(p for _, p in path))] = None
    return list(rules)


def fit_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
              text_col: str = "text", rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit to about ``rows`` labelled documents; without both labels the score is their constant share (or 0.5).

    ``labels`` holds ``doc_id`` and a label of 0 or 1; leave rows out of it that are not to be learnt from. Of rows
    that share an identifier the one with the smallest text is learnt from.
    """
    sample = labelled_sample(labels, label, rows)
    known = stage(with_statistics(labelled_texts(docs, sample, id_col, text_col)).select(
        F.col("_row.label").cast("double").alias("label"), *STATISTICS), "known")
    # A bounded number of narrow rows in one order, so that the same trees grow however the input is parted.
    known = stage(known.repartition(1).sortWithinPartitions("label", *STATISTICS), "ordered")
    share = known.agg(F.avg("label"), F.count("*")).first()
    if share[0] is None or share[0] in (0.0, 1.0):
        n, ones = share[1], (share[0] or 0.0) * share[1]
        return RuleModel(float(np.log((ones + 0.5) / (n - ones + 0.5))), ())
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(known)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", seed=7,
                                    minInstancesPerNode=3).fit(vectors.select("features", "label"))
    rules = tree_paths(forest.toDebugString)
    if not rules:
        return RuleModel(float(np.log(share[0] / (1 - share[0]))), ())
    met = known.select("label", F.array(*[condition(r).cast("double") for r in rules]).alias("met"))
    weighed = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=100, standardization=False).fit(
        met.select("label", array_to_vector("met").alias("features")))
    return RuleModel(float(weighed.intercept), tuple(
        (r, float(w)) for r, w in zip(rules, weighed.coefficients.toArray(), strict=True) if w))


def quality_scores(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, score, predicted``.

    NULL and empty texts get the score of a text without words. Rows that repeat are scored as often as they come, an
    empty table gives an empty result, and other columns than identifier and text are never looked at.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_statistics(named).select(F.col("_row.doc_id").alias("doc_id"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is at least 0.5."""
    return with_statistics(docs, text_col).where(model.score() >= 0.5).select("_row.*")
