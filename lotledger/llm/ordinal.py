"""Quality by ordinal regression with cumulative links.

Grades are 0 .. K-1. One weight vector over hashed text features is shared by all grades, and
ordered thresholds cut its score: P(grade <= k) = sigmoid(threshold[k] - score). The expected grade
and the tail probabilities P(grade >= k) follow. The features are a text's words (hashed, A-Z
lower-cased), its pairs of neighbouring bytes, and whether a word repeats the one before it, each as
a share of their number, so they do not depend on the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.llm.hashing import utf8, word_hashes

WORDS = 1 << 17
PAIRS = 1 << 16
SAMPLE = 4000   # labelled documents that the model is fitted on, those of the smallest hashed ids
STEPS = 250
SCALE = 30.0


def _parts(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of the words, of the byte pairs and of the words' repeats of a text."""
    raw = utf8(text)
    hashes = word_hashes(raw.lower())
    a = np.frombuffer(raw, np.uint8).astype(np.uint16)
    return ((hashes >> np.uint64(47)).astype(np.int64), ((a[:-1] << 8) | a[1:]).astype(np.int64) + WORDS,
            (hashes[1:] == hashes[:-1]).astype(np.int64) + WORDS + PAIRS)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, values) of a text's features; none for an empty text."""
    numbers, values = [], []
    for part in _parts(text):
        if len(part):
            n, c = np.unique(part, return_counts=True)
            numbers.append(n)
            values.append(c * (SCALE / len(part)))
    if not numbers:
        return np.empty(0, np.int64), np.empty(0)
    return np.concatenate(numbers), np.concatenate(values)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Ordinal:
    """Weights and thresholds; ``fit`` minimises the negative log-likelihood by Adam, all rows a step."""

    def __init__(self, grades: int):
        self.w = np.zeros(WORDS + PAIRS + 2)
        self.raw = np.zeros(grades - 1)  # first threshold, then logs of the steps to the next

    @property
    def thresholds(self) -> np.ndarray:
        return np.concatenate((self.raw[:1], self.raw[0] + np.cumsum(np.exp(self.raw[1:]))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, steps: int = STEPS, decay: float = 1e-4) -> Ordinal:
        column = np.concatenate([n for n, _ in rows])
        value = np.concatenate([v for _, v in rows])
        row = np.repeat(np.arange(len(rows)), [len(n) for n, _ in rows])
        share = np.bincount(grade, minlength=len(self.raw) + 1).cumsum()[:-1] / len(grade)
        cut = np.clip(share, 1e-3, 1 - 1e-3)
        theta = np.maximum.accumulate(np.log(cut / (1 - cut)) + 1e-3 * np.arange(len(cut)))
        self.raw = np.concatenate((theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))))
        state = [np.zeros_like(x) for x in (self.w, self.w, self.raw, self.raw)]
        for step in range(1, steps + 1):
            score = np.bincount(row, value * self.w[column], len(rows))
            by_score, by_cut = self._slopes(score, grade)
            slope_w = np.bincount(column, value * by_score[row], len(self.w)) + decay * self.w
            slope_raw = np.concatenate(([by_cut.sum()], np.exp(self.raw[1:]) * by_cut[::-1].cumsum()[::-1][1:]))
            for x, g, m, v, rate in ((self.w, slope_w, *state[:2], 0.02), (self.raw, slope_raw, *state[2:], 0.02)):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return self

    def _slopes(self, score: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean negative log-likelihood: by each row's score, by each threshold."""
        theta = np.concatenate(([-np.inf], self.thresholds, [np.inf]))
        high, low = _sigmoid(theta[grade + 1] - score), _sigmoid(theta[grade] - score)
        p = np.maximum(high - low, 1e-12)
        up, down = high * (1 - high) / p / len(score), low * (1 - low) / p / len(score)
        cuts = np.bincount(grade, -up, len(theta) - 1)[:-1] + np.bincount(grade, down, len(theta) - 1)[1:]
        return up - down, cuts

    def tails(self, text: str | None) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K-1; zeros for a text without words."""
        parts = _parts(text)
        if not len(parts[0]):
            return np.zeros(len(self.raw))
        score = SCALE * sum(self.w[p].mean() for p in parts if len(p))
        return 1 - _sigmoid(self.thresholds - score)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, grade of the labelled documents: 0 poor, 1 good but toxic, 2 good.

    Rows without an id or a quality are no labels; without a toxic mark they count as not toxic;
    of several labels of a document the lowest grade counts.
    """
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)
    marks = labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").alias("_id")).agg(F.min(grade).alias("grade"))
    return docs.join(marks, docs["doc_id"] == F.col("_id")).select("doc_id", "text", "grade")


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal | None:
    """The model, or None when the sample has fewer than two grades.

    Features are computed by the tasks; the driver gets those of at most ``sample`` documents.
    """
    marked = labels.where("doc_id is not null and quality is not null").select("doc_id").distinct()
    few = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    part = graded(docs.join(F.broadcast(few), "doc_id", "left_semi"),  # at most ``sample`` ids
                  labels.join(F.broadcast(few), "doc_id", "left_semi"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [features(t) for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "grade": f["grade"],
                                "n": [n.astype("<i4").tobytes() for n, _ in found],
                                "v": [v.astype("<f4").tobytes() for _, v in found]})

    rows = part.mapInPandas(read, "doc_id long, grade int, n binary, v binary").toPandas()
    rows = rows[rows["n"].map(len) > 0].sort_values(["doc_id", "n"])
    grade = rows["grade"].to_numpy(np.int64)
    if len(np.unique(grade)) < 2:
        return None
    found = [(np.frombuffer(n, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(np.float64))
             for n, v in zip(rows["n"], rows["v"])]
    return Ordinal(3).fit(found, grade)


def scored(docs: DataFrame, labels: DataFrame, keep_at: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """All columns of ``docs`` and expected_grade, p_good (P(grade >= 1)), p_best, keep.

    A document is kept when ``p_good >= keep_at``. Null and blank texts have no evidence of any
    grade: all zero, not kept. Without labels of two grades nothing can be told apart: every text
    with words is kept, with probabilities 1. Repeated rows are scored alike; columns of ``docs``
    with the names of the results are replaced by them.
    """
    model = fitted(docs, labels, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: one weight per feature

    @F.pandas_udf("p_good double, p_best double")
    def tails(text: pd.Series) -> pd.DataFrame:
        own = shared.value
        rows = [own.tails(t) if own else np.full(2, float(bool(utf8(t).split()))) for t in text]
        return pd.DataFrame(np.array(rows, np.float64).reshape(-1, 2), columns=["p_good", "p_best"])

    base = docs.drop("expected_grade", "p_good", "p_best", "keep", "_tails")
    p_good, p_best = F.col("_tails.p_good"), F.col("_tails.p_best")
    return base.withColumn("_tails", tails("text")).select(
        *base.columns, (p_good + p_best).alias("expected_grade"), p_good.alias("p_good"), p_best.alias("p_best"),
        (p_good >= keep_at).alias("keep"))
