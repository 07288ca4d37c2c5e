"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k) = 1 / (1 + exp(threshold_k - s)), where s adds up weights of hashed words and shape marks that all grades
share, and the thresholds are in order. The expected grade is the sum of these, and one of them is the tail probability
documents are selected by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageglean.llm import features

# 0: toxic; 1: not toxic, of low quality; 2: not toxic and good.
GRADE = "case when toxic = 1 then 0 when quality = 1 then 2 when quality = 0 then 1 end"


@dataclass(frozen=True)
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray  # rising, one fewer than grades


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds of free parameters: the first, then steps of positive width."""
    return free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def fit(sets: list[np.ndarray], grades: np.ndarray, n_grades: int, buckets: int = features.BUCKETS) -> Ordinal:
    """The model of graded bucket sets. Without rows every weight is 0 and the thresholds are those of equal grades."""
    even = np.log(np.arange(1, n_grades) / np.arange(n_grades - 1, 0, -1))
    free = np.concatenate([even[:1], np.log(np.diff(even))])
    if not sets:
        return Ordinal(np.zeros(buckets), even)
    rows = np.arange(len(sets))

    def slopes(scores: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s, cuts = scores[:, 0], _thresholds(free)
        # Probability of being above each threshold, with certainty below the first and none above the last.
        above = np.hstack([np.ones((len(s), 1)), _sigmoid(s[:, None] - cuts), np.zeros((len(s), 1))])
        density = above * (1 - above)
        mass = np.maximum(above[rows, grades] - above[rows, grades + 1], 1e-9)
        by_score = -(density[rows, grades] - density[rows, grades + 1]) / mass / len(s)
        by_cut = np.zeros(len(cuts))
        for k in range(len(cuts)):
            by_cut[k] = ((density[:, k + 1] / mass)[grades == k + 1].sum() - (density[:, k + 1] / mass)[grades == k].sum()) / len(s)
        by_free = np.array([by_cut.sum(), *[np.exp(free[i]) * by_cut[i:].sum() for i in range(1, len(free))]])
        return by_score[:, None], by_free

    weights, free = features.minimize(slopes, sets, 1, free, buckets)
    return Ordinal(weights[:, 0], _thresholds(free))


def above(model: Ordinal, sets: list[np.ndarray]) -> np.ndarray:
    """P(grade > k) for each set and k."""
    return _sigmoid(features.sums(model.weights[:, None], sets) - model.thresholds)


def grade_documents(docs: DataFrame, labels: DataFrame, grade: str = GRADE, n_grades: int = 3, keep_from: int = 2, keep_above: float = 0.5,
                    id_col: str = "doc_id", text_col: str = "text", sample_rows: int = features.SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``expected_grade`` (0 to n_grades - 1), ``tail`` = P(grade >= keep_from), and ``keep``, tail > keep_above.

    ``grade`` is an SQL expression over the labels' columns; null leaves a label out. The model is fitted on about
    ``sample_rows`` labelled documents and applied to every whole text. A null text counts as empty; without labels all
    documents get the same middle grade; repeated rows are graded alike; other columns are not looked at.
    """
    sets, grades = features.labelled_sample(docs, labels, id_col, text_col, grade, sample_rows, features.BUCKETS)
    shared = docs.sparkSession.sparkContext.broadcast(fit(sets, grades, n_grades))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            odds = above(model, features.bucket_sets(batch.column("text").to_pylist(), len(model.weights)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(odds.sum(axis=1)), pa.array(odds[:, keep_from - 1])],
                                             ["doc_id", "expected_grade", "tail"])

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    found = plain.mapInArrow(score, f"doc_id {kind}, expected_grade double, tail double")
    return found.withColumn("keep", F.col("tail") > keep_above)
