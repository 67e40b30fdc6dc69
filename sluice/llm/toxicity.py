"""Toxicity: cumulative-link ordinal regression on sparse text features.

Severity has grades 0..K. The model is P(grade > k) = sigmoid(w . x - b_k) with one weight vector w for all thresholds
b_0 < b_1 < ..., so a feature moves a text along one scale, and the expected severity is the sum of P(grade > k).

Features are words and word beginnings (5 to 7 characters) that occur in at least `least` toxic texts and `ratio` times as
often in toxic texts as in others, each by the share of the text's words that have it, and the share of words with any of
them. Labels say toxic or not; where they say no more, a toxic text's grade is how much of it is: the share of its sentences
with such a word, at grade_cuts, which is none of the features.

Fitting is gradient descent over at most max_labels labelled rows (a documented bound, by the smallest hashes of the id),
whose features, not texts, go to the driver; scoring covers all rows and whole texts, in Arrow batches, with the model as a
broadcast value. Its weights are as many as those rows have features.

Defined cases: null and empty texts have no features and get the severity of the thresholds alone, which is low; labelled
rows without a text are not learned from; without two classes among the labels nothing is flagged; repeated rows count as
often as they occur; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored

#: Letters and digits of ASCII, and everything beyond ASCII.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SENTENCE = re.compile(r"[.!?\n]+")
_BEGINNINGS = (5, 6, 7)


def word_counts(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def traits(word: str) -> list[str]:
    """The features that a word may have: itself, and its beginnings with a mark."""
    return [word, *(word[:k] + "\x00" for k in _BEGINNINGS if len(word) > k)]


@dataclass
class OrdinalModel:
    """weights: one for each feature, then for the share of words with any. thresholds ascend."""

    place: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def features(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """(places, values) of a text's features, values in roots of per-cents, so that one word in a long text still counts."""
        n, found, some = max(1, sum(counts.values())), Counter(), 0
        for w, c in counts.items():
            own = [self.place[t] for t in traits(w) if t in self.place]
            for k in own:
                found[k] += c
            some += c * bool(own)
        k = np.fromiter(found, dtype=np.int64, count=len(found))
        x = np.sqrt(100.0 * np.fromiter(found.values(), dtype=float, count=len(found)) / n)
        return np.r_[k, len(self.place)], np.r_[x, np.sqrt(100.0 * some / n)]

    def toxic_share(self, text: str | None) -> float:
        """The share of a text's sentences with a word that has a feature."""
        each = [s for s in map(word_counts, _SENTENCE.split(text or "")) if s]
        return sum(any(t in self.place for w in s for t in traits(w)) for s in each) / max(1, len(each))

    def above(self, counts: Counter) -> np.ndarray:
        """P(grade > k) for each threshold."""
        k, x = self.features(counts)
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - float(self.weights[k] @ x), -500, 500)))


def fit_ordinal(place: dict[str, int], docs: list[tuple[np.ndarray, np.ndarray, int]], n_grades: int = 3, rounds: int = 400, rate: float = 0.05, ridge: float = 1e-4) -> OrdinalModel:
    """docs: (places, values, grade 0 .. n_grades), places and values as OrdinalModel.features() gives them."""
    k_all = n_grades
    model = OrdinalModel(place, np.zeros(len(place) + 1), np.linspace(3.0, 5.0, k_all))
    y = np.array([x[2] for x in docs], dtype=np.int64)
    if y.size == 0 or y.min() == y.max():
        return model
    at = np.repeat(np.arange(len(docs)), [len(k) for k, _, _ in docs])
    where, value = np.concatenate([k for k, _, _ in docs]), np.concatenate([x for _, x, _ in docs])
    over = y[:, None] > np.arange(k_all)[None, :]
    # Each side of each threshold weighs the same: few texts are toxic.
    part = np.where(over, 0.5 / np.maximum(1, over.sum(axis=0)), 0.5 / np.maximum(1, (~over).sum(axis=0)))
    w, b = model.weights, model.thresholds.copy()
    m1, m2 = np.zeros(w.size + k_all), np.zeros(w.size + k_all)
    for t in range(1, rounds + 1):
        z = np.bincount(at, weights=value * w[where], minlength=len(docs))
        p = 1.0 / (1.0 + np.exp(np.clip(b[None, :] - z[:, None], -500, 500)))
        err = part * (p - over)
        g = np.r_[np.bincount(where, weights=value * err.sum(axis=1)[at], minlength=w.size) + ridge * w, -err.sum(axis=0)]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        step = rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        w = w - step[: w.size]
        b = np.maximum.accumulate(b - step[w.size :])
    return OrdinalModel(place, w, b)


def choose_features(labelled: DataFrame, least: int = 4, ratio: float = 6.0) -> dict[str, int]:
    """labelled: (text, y). The traits that tell; labelled has a bounded number of rows."""
    n, n_toxic = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = (Counter(), Counter())
            for text, y in zip(b.column(0), b.column(1), strict=True):
                seen[y.as_py()].update({t for w in word_counts(text.as_py()) for t in traits(w)})
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays([pa.array(names, type=pa.string()), *(pa.array([c[x] for x in names], type=pa.int64()) for c in seen)], names=["trait", "clean", "toxic"])

    counts = labelled.mapInArrow(run, "trait string, clean long, toxic long").groupBy("trait").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    told = counts.where((F.col("toxic") >= least) & (F.col("toxic") * (n - n_toxic + 1) >= ratio * (F.col("clean") + 0.5) * (n_toxic + 1)))
    return {t: k for k, t in enumerate(sorted(r["trait"] for r in told.select("trait").collect()))}


def severity(
    df: DataFrame,
    labels: DataFrame,
    trains: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labels: int = 20_000,
    flag_at: float = 0.6,
    grade_cuts: tuple[float, ...] = (0.1, 0.3),
) -> DataFrame:
    """(id_col, severity double, grade int, toxic boolean) for every row of df: expected severity, the grade whose probability
    is largest, and whether P(grade > 0) is at least flag_at. trains: over id_col, says which labelled rows are learned from."""
    known = labels.where(F.col(label_col).isin(0, 1) & (F.lit(True) if trains is None else trains))
    first = known.select(id_col, F.col(label_col).cast("int").alias("y")).orderBy(F.xxhash64(id_col), id_col, "y").limit(max_labels)
    docs = df.select(id_col, F.col(text_col).alias("text")).where("text is not null").join(F.broadcast(first), id_col)
    labelled = stored(docs.select("text", "y"), "labelled-texts")
    place = choose_features(labelled)
    bare = OrdinalModel(place, np.zeros(0), np.zeros(0))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [bare.features(word_counts(x.as_py())) for x in b.column(0)]
            grades = [y and 1 + int(np.searchsorted(grade_cuts, bare.toxic_share(x.as_py()), side="right")) for x, y in zip(b.column(0), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in each], type=pa.list_(pa.int64())), pa.array([x for _, x in each], type=pa.list_(pa.float64())), pa.array(grades, type=pa.int32())], names=["k", "x", "y"])

    rows = sorted(tuple(r) for r in labelled.mapInArrow(sparse, "k array<long>, x array<double>, y int").collect())
    model = fit_ordinal(place, [(np.array(k), np.array(x), y) for k, x, y in rows], len(grade_cuts) + 1)
    shared = df.sparkSession.sparkContext.broadcast(model)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            above = [shared.value.above(word_counts(x.as_py())) for x in b.column(1)]
            grades = [int(np.argmax(-np.diff(np.r_[1.0, p, 0.0]))) for p in above]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([float(p.sum()) for p in above], type=pa.float64()), pa.array(grades, type=pa.int32()), pa.array([bool(p[0] >= flag_at) for p in above], type=pa.bool_())],
                names=[id_col, "severity", "grade", "toxic"],
            )

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, severity double, grade int, toxic boolean")
