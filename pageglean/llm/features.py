"""Hashed text features, and small linear models over them.

A document is the set of hash buckets of its words (lower-case ASCII, punctuation set aside) and of a few marks of its
shape. Sets are made in numpy where the texts are read; models are fitted on a bounded sample of labelled documents and
have a fixed number of weights, so they are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageglean.llm import words as W

BUCKETS = 1 << 16
# About so many labelled documents, chosen by a hash of their id, are fitted on.
SAMPLE_ROWS = 12_000

_FOLD = bytes(32 if c < 128 and not chr(c).isalnum() else ord(chr(c).lower()) if c < 128 else c for c in range(256))
_SYMBOL = np.array([c < 128 and c > 32 and not chr(c).isalnum() and chr(c) not in ".,'" for c in range(256)])


def _shape(blob: bytes, n_words: int, n_different: int) -> list[tuple[int, int]]:
    """Marks of a text's shape: length, share of different words, share of symbols."""
    symbols = int(_SYMBOL[np.frombuffer(blob, dtype=np.uint8)].sum())
    return [(1, int(np.log2(n_words + 1))), (2, int(10 * n_different / max(1, n_words))), (3, min(20, int(100 * symbols / max(1, len(blob)))))]


def _text_buckets(hashes: np.ndarray, blob: bytes, buckets: int) -> np.ndarray:
    different = np.unique(hashes)
    marks = np.array([k * 1000 + v for k, v in _shape(blob, len(hashes), len(different))], dtype=np.uint64)
    return np.unique((np.concatenate([different, W.mixed(marks, 5)]) % np.uint64(buckets)).astype(np.int32))


def bucket_sets(texts: list[str | None], buckets: int = BUCKETS) -> list[np.ndarray]:
    """The set of buckets of each text. A null or empty text has its shape only."""
    found = []
    for at in range(0, len(texts), 256):
        blobs = [W.encoded(t) for t in texts[at:at + 256]]
        folded = [b.translate(_FOLD).decode("utf-8", "replace") for b in blobs]
        hashes, begins = W.word_hashes(folded)
        found += [_text_buckets(hashes[begins[i]:begins[i + 1]], blob, buckets) for i, blob in enumerate(blobs)]
    return found


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, grade: str, rows: int, buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket sets and grades of a sample of about ``rows`` labelled documents; labels without grade or id do not count.

    An id with several labels counts with the largest.
    """
    graded = labels.select(F.col(id_col).alias("id"), F.expr(grade).cast("int").alias("grade")).filter(
        F.col("id").isNotNull() & F.col("grade").isNotNull()).groupBy("id").agg(F.max("grade").alias("grade"))
    total = graded.count()
    share = min(1.0, rows / max(1, total))
    turn = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    # At most about ``rows`` ids and grades: broadcast, so that no text is shuffled.
    chosen = F.broadcast(graded.filter(turn < share))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id").select("grade", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = bucket_sets(batch.column("text").to_pylist(), buckets)
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(sets, pa.list_(pa.int32()))], ["grade", "buckets"])

    table = texts.mapInArrow(hashed, "grade int, buckets array<int>").toArrow()
    lists, grades = table.column("buckets").combine_chunks(), table.column("grade").to_numpy().astype(np.int64)
    if not len(grades):
        return [], grades
    flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # Sorted by grade and a hash of the set, so that the fit hangs on no order of rows; the sets stay parts of one array.
    with np.errstate(over="ignore"):
        marks = [np.add.reduceat(W.mixed(flat, seed), begins) for seed in (31, 37)]
    order = np.lexsort((*marks, grades))
    return [flat[begins[i]:begins[i] + sizes[i]] for i in order.tolist()], grades[order]


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return (np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.int64)), sizes


def sums(weights: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Sum of the weights (rows of a matrix) of each set; no set is empty."""
    if not sets:
        return np.zeros((0, weights.shape[1]))
    flat, sizes = _flat(sets)
    return np.add.reduceat(weights[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)


def minimize(slopes: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], sets: list[np.ndarray], columns: int, extra: np.ndarray,
             buckets: int, rounds: int = 120, rate: float = 0.05, decay: float = 3e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights of a linear model by full-batch Adam.

    ``slopes(scores, extra)`` gives the slope of the mean loss by the scores of each document and by ``extra``.
    """
    flat, sizes = _flat(sets)
    begins, owner = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(sets)), sizes)
    used, flat = np.unique(flat, return_inverse=True)
    state = [np.zeros((len(used), columns)), extra.astype(float)]
    mean, square = [np.zeros_like(x) for x in state], [np.zeros_like(x) for x in state]
    for step in range(1, rounds + 1):
        scores = np.add.reduceat(state[0][flat], begins, axis=0)
        by_score, by_extra = slopes(scores, state[1])
        by_weight = np.stack([np.bincount(flat, weights=by_score[owner, c], minlength=len(used)) for c in range(columns)], axis=1) + decay * state[0]
        for k, slope in enumerate((by_weight, by_extra)):
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            state[k] = state[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    weights = np.zeros((buckets, columns))
    weights[used] = state[0]
    return weights, state[1]
