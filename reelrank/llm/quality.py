"""Graded quality by cumulative-link (ordinal logistic) regression on hashed text."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import draw_least, freeing, materialise, texts

WORD = re.compile(r"[^\W\d_]+")
DIM = 1 << 18
CACHE = 500_000
STEMS = (4, 5, 6)
#: Grades of labelled documents, lowest first.
TOXIC, POOR, GOOD = 0, 1, 2

_hashes: dict[str, int] = {}


def _hash(found: set[str]) -> list[int]:
    if len(_hashes) > CACHE:
        _hashes.clear()
    for w in found.difference(_hashes):
        _hashes[w] = zlib.crc32(w.encode()) & (DIM - 1)
    return [_hashes[w] for w in found]


def shape(text: str, found: list[str]) -> list[str]:
    """Names of the bands that a text's length, letters, repeats and lines fall in."""
    n, w = max(1, len(text)), max(1, len(found))
    letters = sum(map(len, found)) / n
    upper = sum(1 for x in found if len(x) > 1 and x.isupper()) / w
    distinct = len(set(found)) / w
    runs = sum(1 for _ in groupby(found)) / w
    lines = [x for x in text.split("\n") if x]
    repeated = len(set(lines)) / max(1, len(lines))
    top = max(Counter(found).values(), default=0) / w
    bands = {"letters": letters, "upper": upper, "distinct": distinct, "runs": runs, "lines": repeated, "top": top}
    out = [f"\x00{k}:{int(v * 20)}" for k, v in bands.items()]
    out += [f"\x00{c}:{min(20, int(200 * text.count(c) / n))}" for c in "|!#$%&@<>{}"]
    return [*out, f"\x00words:{w.bit_length()}", f"\x00pace:{min(30, int(sum(map(len, found)) / w))}"]


def features(text: str | None) -> np.ndarray:
    """Sorted distinct hashed features: every word of the whole text, lower-cased, its stems (its
    first letters, if there are more), and the text's shape."""
    text = text or ""
    found = WORD.findall(text)
    words = {w.lower() for w in found}
    stems = {"\x01" + w[:n] for w in words for n in STEMS if len(w) > n}
    return np.unique(np.array(_hash(words) + _hash(stems) + _hash(set(shape(text, found))), np.int64))


@dataclass
class Model:
    """P(grade >= k) = sigmoid(weights . features - thresholds[k - 1]), thresholds ascending."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, rows: list[np.ndarray]) -> np.ndarray:
        """(rows x grades above the lowest) tail probabilities."""
        starts = np.cumsum([0, *map(len, rows)])[:-1]
        s = np.add.reduceat(self.weights[np.concatenate(rows)], starts) if rows else np.zeros(0)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - s[:, None], -60, 60)))


def train(rows: list[np.ndarray], grades: np.ndarray, levels: int = 3, steps: int = 300, rate: float = 0.3,
          ridge: float = 1e-4, least_rows: int = 8,
          deviations: float = 5.0) -> Model:
    """Likelihood ascent (Adagrad, full batch) with grades weighted to the same total.

    All cumulative links share the weights; thresholds are kept in order through positive gaps.
    Only features whose share in some grade is at least ``deviations`` standard deviations from
    what chance gives, and that ``least_rows`` rows have, get a weight; the others would learn by heart.
    """
    x, g = np.concatenate(rows), np.repeat(grades, list(map(len, rows)))
    seen = np.bincount(x * levels + g, minlength=DIM * levels).reshape(DIM, levels)
    share = np.bincount(grades, minlength=levels) / len(grades)
    chance = seen.sum(axis=1, keepdims=True) * share
    z = np.abs(seen - chance) / np.sqrt(chance * (1 - share) + 1e-9)
    often = (seen.sum(axis=1) >= least_rows) & (z.max(axis=1) >= deviations)
    rows = [np.append(r[often[r]], DIM) for r in rows]  # DIM: a constant, so that no row is empty
    x, n = np.concatenate(rows), np.array(list(map(len, rows)))
    owner, starts = np.repeat(np.arange(len(rows)), n), np.cumsum(n) - n
    used, x = np.unique(x, return_inverse=True)
    size = np.bincount(grades, minlength=levels)
    weight = (len(rows) / np.maximum(size, 1) / max(1, (size > 0).sum()))[grades] / len(rows)
    w, w_sum = np.zeros(len(used)), np.full(len(used), 1e-10)
    theta = np.array([-1.0, *np.zeros(levels - 2)])  # first threshold, then logs of the gaps
    theta_sum = np.full(levels - 1, 1e-10)
    for _ in range(steps):
        cuts = np.cumsum([theta[0], *np.exp(theta[1:])])
        s = np.add.reduceat(w[x], starts)
        above = 1 / (1 + np.exp(np.clip(cuts[None, :] - s[:, None], -60, 60)))
        edge = np.hstack([np.ones((len(s), 1)), above, np.zeros((len(s), 1))])
        slope = np.hstack([np.zeros((len(s), 1)), above * (1 - above), np.zeros((len(s), 1))])
        i = np.arange(len(s))
        p = np.maximum(edge[i, grades] - edge[i, grades + 1], 1e-12)
        d_s = weight * (slope[i, grades] - slope[i, grades + 1]) / p
        g = np.bincount(x, d_s[owner], len(used)) - ridge * w
        w_sum += g * g
        w += rate * g / np.sqrt(w_sum)
        d_cut = np.zeros(levels - 1)
        for k in range(1, levels):
            part = np.where(grades == k, -slope[:, k], np.where(grades == k - 1, slope[:, k], 0)) * weight / p
            d_cut[k - 1] = part.sum()
        g_t = np.array([d_cut.sum(), *(np.exp(theta[j]) * d_cut[j:].sum() for j in range(1, levels - 1))])
        theta_sum += g_t * g_t
        theta += rate * g_t / np.sqrt(theta_sum)
    weights = np.zeros(DIM + 1)
    weights[used] = w
    return Model(weights[:DIM], np.cumsum([theta[0], *np.exp(theta[1:])]) - weights[DIM])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([features(t.as_py()) for t in batch.column(1)], pa.list_(pa.int64()))], ["grade", "x"])


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): toxic documents are graded 0, others 1 or 2 by quality; unlabelled ones go.

    A document that is labelled more than once takes its lowest grade.
    """
    grade = F.when(F.col("toxic") == 1, TOXIC).when(F.col("quality") == 1, GOOD).when(F.col("quality") == 0, POOR)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")).where(
        F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, rows_per_grade: int = 2500, seed: int = 42) -> Model | None:
    """Fit on at most ``rows_per_grade`` rated rows of each grade, drawn by a hash of doc_id.

    ``ratings`` is (doc_id, grade from 0). None if no rated row has a text.
    """
    # stored first: Spark then knows how small it is and need not shuffle the texts to join it
    drawn = materialise(draw_least(ratings.select("doc_id", "grade"), rows_per_grade, "grade", ["doc_id"], seed), "quality-sample")
    # of rows with one doc_id the least text is taken, and rows come in order: the model is the same each time
    sample = texts(docs).where("text IS NOT NULL").join(drawn, "doc_id").groupBy("doc_id").agg(
        F.min("grade").alias("grade"), F.min("text").alias("text")).orderBy("doc_id").select(F.col("grade").cast("int").alias("grade"), "text").mapInArrow(
        _features, "grade int, x array<long>").toArrow()
    if not sample.num_rows:
        return None
    grades = sample.column("grade").to_numpy()
    rows = [np.asarray(x.values) for x in sample.column("x")]
    return train(rows, grades.astype(np.int64), max(3, int(grades.max()) + 1))


def _score(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of.value
        for batch in batches:
            tails = model.tails([features(t.as_py()) for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, -1])],
                ["doc_id", "expected_grade", "p_not_lowest", "p_highest"])
    return run


SCORED = "doc_id long, expected_grade double, p_not_lowest double, p_highest double"


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, expected_grade, p_not_lowest, p_highest) of every row.

    expected_grade is the sum of the tail probabilities. A null text is scored as an empty one;
    without a model all scores are null. Repeated rows score alike, a null doc_id stays null,
    other columns are ignored, an empty table gives no rows.
    """
    plain = texts(docs)
    if model is None:
        none = F.lit(None).cast("double")
        return plain.select("doc_id", none.alias("expected_grade"), none.alias("p_not_lowest"), none.alias("p_highest"))
    return plain.mapInArrow(freeing(_score(docs.sparkSession.sparkContext.broadcast(model))), SCORED)  # DIM doubles


def op5_quality(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Scores of all documents; ``selected``: the chance of a grade above the lowest is at least ``least``."""
    return score(docs, fit(docs, graded(labels))).withColumn(
        "selected", F.coalesce(F.col("p_not_lowest") >= least, F.lit(True)))
