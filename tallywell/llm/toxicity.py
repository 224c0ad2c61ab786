"""Toxicity as severity: cumulative-link ordinal regression on sparse text features.

Severity is a grade from 0 up. One weight vector w scores a text's sparse
features, and ordered thresholds cut the score into grades:

    P(grade >= k) = sigmoid(w . x - cut_k),  cut_1 < cut_2 < ...

All thresholds share w. The expected severity is the sum of these
probabilities over k; a text is toxic if P(grade >= 1) is at least ``TOXIC``.

A feature is log(1 + count) of a word or of a word's beginning. Features are chosen by how much their
document frequency differs between graded and other texts. The fit uses at most
about ``SAMPLE_ROWS`` labelled rows, chosen by a hash of their id, and the
regression sees only their chosen features. Both bounds are parameters. Scoring
covers every whole text.

Cases: a null or empty text has no feature and the score of the thresholds
alone; labels that are null, or of no document, are left out; several grades of
one id count as the largest; without a graded text every severity is 0;
repeated rows are scored each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.rows import SLICE, map_texts, quoted
from tallywell.session import staged

WORD = re.compile(r"[^\W_]+")
#: Grades above 0, rows the regression is fitted on, words it may use, least documents of a word.
GRADES, SAMPLE_ROWS, FEATURES, MIN_DOCS, SEED = 3, 20_000, 2_000, 5, 11
HASHES = 1_000_000
#: Lengths of beginnings that are features, words a Python worker remembers.
PREFIXES, MEMO_WORDS = (5, 6, 7, 8), 200_000
#: Probability of a grade above 0 from which a text counts as toxic.
TOXIC = 0.3
#: Ridge weight, steps of the fit.
RIDGE, STEPS = 5e-5, 400


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass
class OrdinalModel:
    words: list[str]
    weights: np.ndarray
    cuts: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for every score and k."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.cuts, -60, 60)))


def features_of(word: str) -> list[str]:
    """The word and its beginnings, which many inflected or compound words share."""
    return [word, *[word[:k] + "*" for k in PREFIXES if len(word) > k]]


class FeatureCounter:
    """Counts known features of texts; remembers which features a word has."""

    def __init__(self, features: list[str]):
        self.place = {f: i for i, f in enumerate(features)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def count(self, text: str) -> dict[int, int]:
        words = words_of(text)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        place = self.place
        for w in set(words).difference(self.memo):
            self.memo[w] = tuple(place[f] for f in features_of(w) if f in place)
        counts: dict[int, int] = {}
        for held in filter(None, map(self.memo.__getitem__, words)):
            for f in held:
                counts[f] = counts.get(f, 0) + 1
        return counts


# -- fit -------------------------------------------------------------------
def _document_counts(df: DataFrame) -> DataFrame:
    """``toxic, w, n``: texts that hold each feature, counted per slice before any shuffle."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                counts: dict[tuple[bool, str], int] = {}
                for toxic, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for w in {f for w in set(words_of(text or "")) for f in features_of(w)}:
                        counts[toxic, w] = counts.get((toxic, w), 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in counts], pa.bool_()),
                                                  pa.array([w for _, w in counts], pa.string()),
                                                  pa.array(list(counts.values()), pa.int64())], names=["toxic", "w", "n"])

    return df.mapInArrow(run, "toxic boolean, w string, n long")


def choose_words(graded: DataFrame, features: int = FEATURES, min_docs: int = MIN_DOCS) -> list[str]:
    """Words whose share of graded texts differs most from that of others, by a two-sample z score."""
    sizes = graded.agg(F.count_if(F.col("grade") > 0), F.count_if(F.col("grade") == 0)).first()
    if not sizes[0] or not sizes[1]:
        return []
    tox, other = F.lit(float(sizes[0])), F.lit(float(sizes[1]))
    table = _document_counts(graded.select((F.col("grade") > 0).alias("toxic"), "text")).groupBy("w").agg(
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("b"))
    pooled = (F.col("a") + F.col("b")) / (tox + other)
    z = (F.col("a") / tox - F.col("b") / other) / F.sqrt(pooled * (1 - pooled) * (1 / tox + 1 / other) + 1e-12)
    best = table.where(F.col("a") + F.col("b") >= min_docs).orderBy(F.abs(z).desc(), "w").limit(features)
    return [r.w for r in best.select("w").collect()]


def graded_sample(docs: DataFrame, grades: DataFrame, grade_col: str, sample_rows: int, id_col: str,
                  text_col: str) -> DataFrame:
    """``doc, grade, text`` of about ``sample_rows`` documents with a grade at most, staged."""
    doc = F.col(quoted(id_col))
    own = (grades.where(doc.isNotNull() & F.col(quoted(grade_col)).isNotNull()).groupBy(doc.alias("doc"))
           .agg(F.max(quoted(grade_col)).cast("int").alias("grade")))
    total = own.count()
    if total > sample_rows:
        own = own.where(F.pmod(F.xxhash64("doc", F.lit(SEED)), F.lit(HASHES)) < int(HASHES * sample_rows / total))
    # Pairs of numbers, as many as the bound says.
    return staged(docs.select(doc.alias("doc"), F.col(quoted(text_col)).cast("string").alias("text"))
                  .join(F.broadcast(own), "doc"), "graded-sample")


def fit(docs: DataFrame, grades: DataFrame, grade_col: str = "grade", sample_rows: int = SAMPLE_ROWS,
        features: int = FEATURES, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text",
        split_top: int = 1) -> OrdinalModel:
    """Fit on graded documents.

    ``split_top`` above 1 divides the highest grade into that many grades by
    how many distinct chosen words that speak for it a text holds: for labels
    that only say whether a text is toxic.
    """
    sample = graded_sample(docs, grades, grade_col, sample_rows, id_col, text_col)
    words = choose_words(sample, features, min_docs)
    if not words:
        return OrdinalModel([], np.zeros(0), np.full(1, 60.0))

    def work(texts):
        own = FeatureCounter(words)
        counts = [sorted(own.count(t).items()) for t in texts]
        return [[[f for f, _ in c] for c in counts], [[n for _, n in c] for c in counts]]

    # At most about sample_rows rows of chosen features.
    rows = sorted((r.grade, r.held, r.times) for r in map_texts(
        sample, work, [("held", "array<int>"), ("times", "array<int>")], "doc", "text", ("grade",)).collect())
    grade = np.array([g for g, _, _ in rows])
    row = np.repeat(np.arange(len(rows)), [len(h) for _, h, _ in rows])
    column = [f for _, held, _ in rows for f in held]
    value = np.log1p([n for _, _, times in rows for n in times])
    x = (np.array(row, int), np.array(column, int), np.array(value, float))
    if split_top > 1:
        grade = _split(grade, x, len(words), split_top)
    return OrdinalModel(words, *fit_ordinal(x, grade, len(words)))


def _split(grade: np.ndarray, x, words: int, parts: int) -> np.ndarray:
    """Divide the highest grade at the quantiles of its texts' number of telling words."""
    row, column, _ = x
    top = grade == grade.max()
    inside = np.bincount(column, top[row], words) / max(1, top.sum())
    outside = np.bincount(column, ~top[row], words) / max(1, (~top).sum())
    telling = inside > 4 * outside + 0.02
    count = np.bincount(row, telling[column], len(grade))
    steps = np.quantile(count[top], np.arange(1, parts) / parts)
    return np.where(top, grade + (count[:, None] > steps).sum(axis=1), grade)


def fit_ordinal(x, grade: np.ndarray, features: int, ridge: float = RIDGE, steps: int = STEPS):
    """Weights and ordered cuts by accelerated gradient descent on the cumulative-link likelihood."""
    row, column, value = x
    n, top = len(grade), int(grade.max(initial=0))
    # Grades without a text have no cut of their own.
    levels = [k for k in range(1, top + 1) if (grade >= k).any()] or [1]
    reached = np.stack([grade >= k for k in levels], axis=1)
    share = np.clip(reached.mean(axis=0), 1e-4, 1 - 1e-4)
    # cut_k = first + sum of exp(gap): the cuts stay in order.
    cut = -np.log(share / (1 - share))
    state = np.concatenate((np.zeros(features), cut[:1], np.log(np.maximum(np.diff(cut), 0.1))))
    levels_n = len(levels)

    def cuts_of(s):
        return s[features] + np.concatenate(([0], np.cumsum(np.exp(s[features + 1:]))))

    def loss_and_slope(s):
        w, cuts = s[:features], cuts_of(s)
        score = np.bincount(row, value * w[column], n)
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts, -60, 60)))
        padded = np.concatenate((np.ones((n, 1)), p, np.zeros((n, 1))), axis=1)
        at = reached.sum(axis=1)
        upper, lower = padded[np.arange(n), at], padded[np.arange(n), at + 1]
        mass = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper), lower * (1 - lower)
        by_score = -(up - low) / mass / n
        by_cut = np.zeros(levels_n + 2)
        np.add.at(by_cut, at, up / mass / n)
        np.add.at(by_cut, at + 1, -low / mass / n)
        by_cut = by_cut[1:-1]
        slope = np.concatenate((np.bincount(column, value * by_score[row], features) + ridge * w, [by_cut.sum()],
                                np.exp(s[features + 1:]) * np.cumsum(by_cut[::-1])[::-1][1:]))
        return -np.log(mass).mean() + ridge / 2 * (w @ w), slope

    best, slope = loss_and_slope(state)
    moment, step = state.copy(), 1.0
    for k in range(steps):
        old, (now, slope) = state, loss_and_slope(moment)
        for _ in range(30):
            trial = moment - step * slope
            value_there, _ = loss_and_slope(trial)
            if value_there <= now - step / 2 * (slope @ slope) + 1e-12:
                break
            step /= 2
        state, step = trial, step * 1.2
        if value_there > best:
            moment = state
        else:
            moment = state + k / (k + 3) * (state - old)
        if abs(best - value_there) < 1e-8 and k > 50:
            break
        best = value_there
    return state[:features], cuts_of(state)


# -- score -----------------------------------------------------------------
def score_severity(docs: DataFrame, model: OrdinalModel, toxic_from: float = TOXIC, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id, severity, grade, toxic_probability, toxic``: expected and likeliest grade of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own: list[FeatureCounter] = []  # one for each task

    def work(texts):
        if not own:
            own.append(FeatureCounter(shared.value.words))
        model = shared.value
        scores = np.zeros(len(texts))
        for i, t in enumerate(texts):
            counts = sorted(own[0].count(t).items())
            if counts:
                at, times = np.array(counts).T
                scores[i] = model.weights[at] @ np.log1p(times)
        p = model.at_least(scores)
        mass = np.concatenate((np.ones((len(texts), 1)), p), axis=1) - np.concatenate((p, np.zeros((len(texts), 1))), axis=1)
        return [p.sum(axis=1), mass.argmax(axis=1).astype(np.int32), p[:, 0], p[:, 0] >= toxic_from]

    return map_texts(docs, work, [("severity", "double"), ("grade", "int"), ("toxic_probability", "double"),
                                  ("toxic", "boolean")], id_col, text_col)
