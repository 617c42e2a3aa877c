"""Toxicity as cumulative-link ordinal regression.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight for each feature, shared by
all thresholds, which are in order. Features are word stems (runs of letters,
lowered, their first ``STEM`` letters; every word of the text counts), hashed to
``BUCKETS`` buckets, with the logarithm of one plus their number. Only stems that occur beside a toxic label clearly more often than
chance, and in ``MIN_SUPPORT`` of the toxic documents, keep a bucket, so x is sparse
and a text's copies teach little. The result is the expected grade, from 0 to
``GRADES - 1``.

Labels say only toxic or not. Grade 0 is not toxic. The toxic documents' grades are
cross-fitted: the sample falls into two halves, and a document's evidence is the sum,
over stems that are telling in the *other* half, of their log odds there times the
logarithm of one plus their number. Its half's third parts by evidence are the grades 1
to 3; equal evidence has one grade. So no document has a say in its own grade. The model
is fitted on at most ``TRAIN_ROWS`` labelled documents of each kind, those that come
first by a hash of doc_id; tasks count their stems, and only the counts reach the driver.

Texts without letters, null ones included, have no features and the least severity.
Without labelled documents of both kinds every severity is 0. Each input row gives
one output row. Other columns are not read.
"""

import math
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake.llm.common import CACHED_WORDS, arrow_map, chosen_by_hash, table

BUCKETS = 1 << 18
GRADES = 4
TRAIN_ROWS = 3000
#: Standard errors by which a stem's log odds must pass zero to be a feature.
MIN_Z = 4.0
MIN_SUPPORT = 0.03
STEM = 5
STEPS = 400
#: Expected severity from which a text counts as toxic.
CUT = 0.5
LETTERS = re.compile(r"[^\W\d_]+")


class Buckets(dict):
    """Word -> bucket of its stem; cleared when it grows large."""

    def __missing__(self, word):
        value = self[word] = xxhash.xxh64_intdigest(word[:STEM]) % BUCKETS
        return value

    def of(self, text: str | None) -> Counter:
        """Number of words in each bucket."""
        found = Counter(map(self.__getitem__, LETTERS.findall((text or "").lower())))
        if len(self) > CACHED_WORDS:
            self.clear()
        return found


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def evidence(found: list[Counter], marks: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Log odds of each bucket for toxic against not, and the buckets that tell them apart."""
    inside = np.zeros((2, BUCKETS))
    for counted, m in zip(found, marks):
        inside[m, list(counted)] += 1
    size = np.array([[(marks == 0).sum()], [(marks == 1).sum()]])
    odds = np.log((inside + 0.5) / (size - inside + 0.5))
    z = (odds[1] - odds[0]) / np.sqrt((1 / (inside + 0.5) + 1 / (size - inside + 0.5)).sum(0))
    share = inside / np.maximum(size, 1)
    telling = (z >= MIN_Z) & (share[1] >= MIN_SUPPORT) & (share[1] >= 4 * share[0])
    return odds[1] - odds[0], np.flatnonzero(telling).tolist()


def graded(found: list[Counter], marks: np.ndarray) -> np.ndarray:
    """Grades of the sample; each half of either kind is graded by what the other half shows."""
    half, grade = np.zeros(len(marks), np.int64), np.zeros(len(marks), np.int64)
    for kind in (0, 1):
        members = np.flatnonzero(marks == kind)
        half[members] = np.arange(len(members)) % 2
    for side in (0, 1):
        others = np.flatnonzero(half != side)
        odds, telling = evidence([found[n] for n in others], marks[others])
        own = np.flatnonzero((half == side) & (marks == 1))
        total = np.array([sum(odds[b] * math.log1p(found[n][b]) for b in telling) for n in own])
        if len(own):
            # Rounded, so the order of addition decides no tie.
            total = np.round(total, 9)
            grade[own] = 1 + (total[:, None] > np.quantile(total, [1 / 3, 2 / 3])).sum(1)
    return grade


def train(rows: list[tuple[Counter, int]]) -> tuple[dict[int, float], np.ndarray]:
    """Weights by bucket and thresholds, from stem counts marked toxic (1) or not (0)."""
    found, marks = [counted for counted, _ in rows], np.array([m for _, m in rows], np.int64)
    if len(set(marks.tolist())) < 2:
        return {}, np.full(GRADES - 1, np.inf)
    _, names = evidence(found, marks)
    x = np.log1p(np.array([[counted[n] for n in names] for counted in found], np.float64).reshape(len(rows), len(names)))
    weights, thresholds = fit(x, graded(found, marks), np.full(len(rows), 1 / len(rows)))
    return dict(zip(names, weights.tolist())), thresholds


def ordered(gaps: np.ndarray) -> np.ndarray:
    """Thresholds from the first one and the logarithms of the gaps that follow."""
    return gaps[0] + np.concatenate([[0], np.cumsum(np.exp(gaps[1:]))])


def loss(value: np.ndarray, x: np.ndarray, grade: np.ndarray, share: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative weighted log likelihood with a small ridge on the weights, and its slopes."""
    rows, weights, gaps = np.arange(len(x)), value[:x.shape[1]], value[x.shape[1]:]
    below = sigmoid(ordered(gaps) - (x @ weights)[:, None])
    below = np.concatenate([np.zeros((len(x), 1)), below, np.ones((len(x), 1))], 1)
    chance = np.maximum(below[rows, grade + 1] - below[rows, grade], 1e-9)
    slope = below * (1 - below)
    upper, lower = slope[rows, grade + 1] * share / chance, slope[rows, grade] * share / chance
    by_threshold = np.array([lower[grade == k + 1].sum() - upper[grade == k].sum() for k in range(GRADES - 1)])
    by_gap = np.array([by_threshold.sum(), *(np.exp(gaps[k]) * by_threshold[k:].sum() for k in range(1, GRADES - 1))])
    total = -float(share @ np.log(chance)) + 0.5e-4 * float(weights @ weights)
    return total, np.concatenate([x.T @ (upper - lower) + 1e-4 * weights, by_gap])


def fit(x: np.ndarray, grade: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on :func:`loss`."""
    value = np.zeros(x.shape[1] + GRADES - 1)
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        _, slopes = loss(value, x, grade, share)
        mean += 0.1 * (slopes - mean)
        square += 0.01 * (slopes ** 2 - square)
        value = value - 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
    return value[:x.shape[1]], ordered(value[x.shape[1]:])


def sample(rows: DataFrame) -> DataFrame:
    """``kind, id, buckets, counts`` of rows ``kind, id, text``."""
    def start():
        cache = Buckets()

        def step(kinds, ids, texts):
            counted = [sorted(cache.of(text).items()) for text in texts]
            return [(k, n, [b for b, _ in c], [m for _, m in c]) for k, n, c in zip(kinds, ids, counted)]

        return step

    schema = "kind int, id bigint, buckets array<int>, counts array<int>"
    return arrow_map(rows.select("kind", F.col("id").cast("bigint"), "text"), schema, start)


def model(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[dict[int, float], np.ndarray]:
    """Fit on the bounded sample of labelled documents."""
    marks = labels.where(F.col("toxic").isin(0, 1)).select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("kind"))
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    found = sample(chosen_by_hash(rows, TRAIN_ROWS, marks)).collect()
    found.sort(key=lambda row: (row["kind"], row["id"]))
    return train([(Counter(dict(zip(r["buckets"], r["counts"]))), r["kind"]) for r in found])


def severity(
    docs: DataFrame, fitted: tuple[dict[int, float], np.ndarray], id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, severity, grade, toxic``: expected grade, likeliest grade, the verdict."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def start():
        (weights, thresholds), cache = shared.value, Buckets()

        def step(ids, texts):
            out = []
            for name, body in zip(ids, texts):
                counted = cache.of(body)
                telling = sorted(counted.keys() & weights.keys())
                total = sum(weights[b] * math.log1p(counted[b]) for b in telling)
                above = 1 - sigmoid(thresholds - total)
                expected = float(above.sum())
                chances = -np.diff(np.concatenate([[1.0], above, [0.0]]))
                out.append((name, expected, int(chances.argmax()), expected >= CUT))
            return out

        return step

    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return arrow_map(rows, f"`{id}` bigint, severity double, grade int, toxic boolean", start)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return severity(docs, model(docs, table(spark, folder, "labels")))
