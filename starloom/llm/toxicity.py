"""Toxicity as an ordered severity: cumulative-link regression over sparse features of words and their beginnings.

The grades are 0 (not toxic) to 3. A label only says toxic or not, so the grade of a toxic document is taken from how
many different words of it are marked by the labels themselves: up to two, up to four, more. The model has one weight
for each feature of a bounded vocabulary, a word or the first letters of one (endings vary), and one threshold for
each step between grades, in order: P(grade > k) = 1 / (1 + exp(threshold[k] - weights . words)). All steps share the
weights, so a word that makes one grade likelier does so for all. The expected severity is the sum of the three
probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import bound_batches
from starloom.llm.labelled import SAMPLE_ROWS, labelled_sample, labelled_texts
from starloom.session import stage

VOCABULARY_WORDS = 2_000
LEAST_DOCUMENTS, LEAST_Z = 4, 2.5  # of the sample that hold a feature, and how sure its side must be
GRADE_STEPS = (2, 4)  # a toxic document with more marked words than this is one grade higher
PORTION = 50  # documents that are spelt out at a time
ROUNDS, RATE, RIDGE = 400, 0.1, 2e-4
BEGINNINGS = (4, 5, 7)
_WORD = re.compile(r"\w+")


def _words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _features(words: set[str]) -> set[str]:
    """The words, for each beginning its letters and an asterisk, and the same with 2 or 4 if so many words have it."""
    found = set(words)
    for n in BEGINNINGS:
        times = Counter([w[:n] for w in words if len(w) >= n])
        found.update([b + "*" for b in times], *[[f"{b}*{m}" for b, c in times.items() if c >= m] for m in (2, 4)])
    return found


@dataclass(frozen=True)
class OrdinalModel:
    """A weight per feature and ordered thresholds."""
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def steps(self, text: str | None) -> np.ndarray:
        """P(grade > 0), P(grade > 1), ... of a whole text."""
        found = self.weights.keys() & _features(_words(text))
        x = sum(self.weights[w] for w in sorted(found))
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - x, -60, 60)))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, words: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood; ``rows`` lists the features present in each row.

    Thresholds are a first one and positive gaps, so they stay in order.
    """
    index = np.array([w for row in rows for w in row], dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    above = grades[:, None] > np.arange(steps)[None, :]
    share = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    start = -np.log(share / (1 - share))
    weights, first, gaps = np.zeros(words), start[0], np.log(np.expm1(np.maximum(np.diff(start), 0.05)))
    moments = [np.zeros(words + steps), np.zeros(words + steps)]
    for t in range(1, ROUNDS + 1):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(gaps)))])
        x = np.bincount(owner, weights=weights[index], minlength=len(rows))
        reach = 1 / (1 + np.exp(np.clip(thresholds[None, :] - x[:, None], -60, 60)))  # P(grade > k)
        edges = np.concatenate([np.ones((len(rows), 1)), reach, np.zeros((len(rows), 1))], axis=1)
        at = np.arange(len(rows))
        p = np.maximum(edges[at, grades] - edges[at, grades + 1], 1e-9)
        slope = edges * (1 - edges)
        dx = (slope[at, grades] - slope[at, grades + 1]) / p
        d_threshold = np.zeros(steps)
        for k in range(steps):
            d_threshold[k] = (((grades == k) * slope[:, k + 1] - (grades == k + 1) * slope[:, k + 1]) / p).mean()
        d_weights = np.bincount(index, weights=dx[owner], minlength=words) / len(rows) - RIDGE * weights
        from_gap = np.cumsum(d_threshold[::-1])[::-1]
        gradient = np.concatenate([d_weights, [d_threshold.sum()], from_gap[1:] / (1 + np.exp(-gaps))])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient ** 2
        step = RATE * (moments[0] / (1 - 0.9 ** t)) / (np.sqrt(moments[1] / (1 - 0.999 ** t)) + 1e-8)
        weights = weights + step[:words]
        first += step[words]
        gaps = gaps + step[words + 1:]
    return weights, first + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(gaps)))])


def _sample_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), PORTION):  # the features of a text take many times its size
            part = batch.iloc[at:at + PORTION]
            words = [_words(t) for t in part["text"]]
            yield pd.DataFrame({"label": part["label"], "words": [sorted(w) for w in words],
                                "features": [sorted(_features(w)) for w in words]})


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
                 text_col: str = "text", rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit to about ``rows`` labelled documents, whole texts; with a single label no word has any weight.

    Of rows that share an identifier the one with the smallest text is learnt from.
    """
    bound_batches(docs.sparkSession)
    sample = labelled_sample(labels, label, rows)
    known = stage(labelled_texts(docs, sample, id_col, text_col).select("label", "text")
                  .mapInPandas(_sample_words, "label int, words array<string>, features array<string>"), "sample")
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not ones or ones == n:
        share = (ones + 0.5) / (n + 1)
        return OrdinalModel({}, tuple(float(-np.log(share / (1 - share))) + k for k in range(len(GRADE_STEPS) + 1)))
    counts = known.select("label", F.explode("features").alias("word")).groupBy("word").agg(
        F.sum("label").alias("a"), F.count("*").alias("c")).where(F.col("c") >= LEAST_DOCUMENTS)
    # Difference of log odds over its standard error: how surely a word belongs to one side.
    a, b = F.col("a") + 0.5, F.col("c") - F.col("a") + 0.5
    odds = F.log(a / (ones - F.col("a") + 0.5)) - F.log(b / (n - ones - F.col("c") + F.col("a") + 0.5))
    sure = counts.select("word", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
    vocabulary = sure.where(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "word").limit(VOCABULARY_WORDS).collect()
    place = {r["word"]: i for i, r in enumerate(vocabulary)}
    marked = {r["word"] for r in vocabulary if r["z"] > 4 and r["odds"] > 2}

    def place_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, marks = [], []
            for words in batch["words"]:
                found.append(sorted(place[f] for f in _features(set(words)) if f in place))
                marks.append(sum(w in marked or any(w[:n] + "*" in marked for n in BEGINNINGS) for w in words))
            yield pd.DataFrame({"label": batch["label"], "found": found, "marks": marks})

    taken = known.select("label", "words").mapInPandas(place_of, "label int, found array<int>, marks int").collect()  # the bounded sample
    found = [r["found"] for r in taken]
    marks = np.array([r["marks"] for r in taken])
    toxic = np.array([r["label"] for r in taken])
    grades = toxic * (1 + sum((marks > s).astype(int) for s in GRADE_STEPS))
    weights, thresholds = fit_ordinal(found, grades, len(place), len(GRADE_STEPS) + 1)
    return OrdinalModel({w: float(weights[i]) for w, i in place.items()}, tuple(map(float, thresholds)))


SCORES = "doc_id long, p_toxic double, severity double, grade int, toxic boolean"


def toxicity_scores(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, p_toxic, severity, grade, toxic``, from the whole text.

    ``severity`` is the expected grade, ``grade`` the likeliest one, ``toxic`` says that a grade above 0 is likelier
    than not. NULL and empty texts have no words. Repeated rows are scored as often as they come; an empty table gives
    an empty result; other columns are ignored.
    """
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            steps = np.array([model.steps(t) for t in batch["text"]]).reshape(len(batch), len(model.thresholds))
            each = -np.diff(np.hstack([np.ones((len(batch), 1)), steps, np.zeros((len(batch), 1))]), axis=1)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "p_toxic": steps[:, 0], "severity": steps.sum(axis=1),
                "grade": each.argmax(axis=1).astype("int32"), "toxic": steps[:, 0] >= 0.5})

    bound_batches(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(score, SCORES)


def drop_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, for which a grade above 0 is not likelier than not."""
    bound_batches(docs.sparkSession)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = [bool(model.steps(t)[0] >= 0.5) for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([not t for t in toxic], type=pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
