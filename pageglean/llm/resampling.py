"""Importance resampling toward a target distribution.

A text's features are its runs of words, hashed into a fixed number of buckets. The logarithm of how much more frequent a
bucket is in the target than in the corpus is its gain; a document's weight is the mean gain of its features. Adding
Gumbel noise to the weights and taking the highest scores draws documents without replacement, by their weights.

The gains are an array of fixed size that goes to every task. The cutoff of the draw is found without sorting the scores:
a quantile sketch brackets it, exact counts of what lies outside confirm the bracket or widen it, and only the scores in
the bracket are sorted. What was drawn is then numbered for its ranks.

Null and empty texts have no features, weight 0, and are not drawn (below ``least_words``). A null id draws as the empty
string and comes after all others among equal scores; repeated rows are drawn one by one. Rows that agree in score and id
are taken by number of features, then in stored order. An empty table gives no row; an empty target has no counts, so its
smoothing alone speaks. Other columns of the inputs are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageglean.llm import words as W
from pageglean.operators.numbering import numbered
from pageglean.session import materialize

BUCKETS = 10_000
# Relative error of the sketch is one part in so many; the first bracket is twice as wide to both sides.
ACCURACY = 10_000

# Bytes of a word stay, A to Z in lower case; every other byte becomes a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def _features(blob: bytes, longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """Number of new words, and the runs of 1 to ``longest`` words that end in them, for each piece of a text."""
    held: list[bytes] = []
    for piece in W.cut(blob.translate(_FOLD)):
        new = piece.split()
        every = held + new
        runs = list(new)
        for n in range(2, longest + 1):
            first = max(0, len(held) - n + 1)
            runs += [b" ".join(every[i:i + n]) for i in range(first, len(every) - n + 1)]
        yield len(new), runs
        held = every[max(0, len(every) - longest + 1):] if longest > 1 else []


def _buckets(runs: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(crc32, runs), dtype=np.int64, count=len(runs)) % buckets


def _blobs(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [b or b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket. A task adds up its texts; ``buckets`` sums come to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in W.slices(batches):
            for blob in _blobs(batch, "text"):
                for _, runs in _features(blob, longest):
                    total += np.bincount(_buckets(runs, buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    counted = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket int, n long")
    found = np.zeros(buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        found[row["bucket"]] = row["n"]
    return found


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the corpus, rounded down."""
    n = len(target)
    ratio = (target + 1.0) * (float(corpus.sum()) + n) / ((corpus + 1.0) * (float(target.sum()) + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight``, the mean gain rounded down, of every document."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            found = np.zeros((3, batch.num_rows), dtype=np.int64)
            for i, blob in enumerate(_blobs(batch, "text")):
                words = features = total = 0
                for n, runs in _features(blob, longest):
                    words, features = words + n, features + len(runs)
                    total += int(gain[_buckets(runs, len(gain))].sum())
                found[:, i] = words, features, total // features if features else 0
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x) for x in found)], ["id", "n_words", "n_features", "weight"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(weigh, "id long, n_words long, n_features long, weight long")


def _noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _place() -> Column:
    """What comes first among equal scores."""
    return F.struct(F.col("id").isNull().alias("a"), F.coalesce("id", F.lit(0).cast("long")).alias("b"), F.col("n_features").alias("c"), F.col("row").alias("d"))


def _order() -> tuple[Column, ...]:
    """The order of ranks."""
    return F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("row")


def _bracket(scored: DataFrame, rows: int, accuracy: int, above_share: float) -> tuple[int, int, int]:
    """Two scores with the ``rows``-th highest between them, both included, and how many lie above the higher one."""
    widths = [0.0]
    while widths[-1] < 1:
        widths.append(max(2.0 / accuracy, widths[-1] * 8))
    at = [min(1.0, max(0.0, 1 - above_share + side * width)) for width in widths[1:] for side in (-1, 1)]
    marks = scored.agg(F.percentile_approx("score", at, accuracy).alias("marks")).first()["marks"]
    for low, high in zip(marks[::2], marks[1::2]):
        # The sketch only proposes; what counts is the exact number of scores outside.
        above, reached = scored.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") >= low)).first()
        if above < rows <= reached:
            return low, high, above
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    return low, high, 0


def drawn(scored: DataFrame, rows: int, total: int, accuracy: int = ACCURACY) -> Column:
    """Condition that holds for the ``rows`` highest scores of a stored table of ``total`` rows."""
    if rows <= 0:
        return F.lit(False)
    low, high, above = _bracket(scored, rows, accuracy, rows / total)
    inside = numbered(scored.filter(F.col("score").between(low, high)), *_order())
    last = inside.filter(F.col("number") == rows - above - 1).select("score", _place().alias("place")).first()
    mark = last["place"]
    least = F.struct(F.lit(mark["a"]).alias("a"), *[F.lit(mark[k]).cast("long").alias(k) for k in "bcd"])
    return (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & (_place() <= least))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", longest: int = 1,
             buckets: int = BUCKETS, percent: int = 10, least_words: int = 20, seed: int = 2024, accuracy: int = ACCURACY) -> DataFrame:
    """Every document's ``n_features``, ``weight``, ``score`` and ``rank``; the rank is null where it was not drawn.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn.
    """
    gain = gains(bucket_counts(target, target_text, longest, buckets), bucket_counts(docs, text_col, longest, buckets))
    weighed = weights(docs, gain, id_col, text_col, longest)
    scored = materialize(weighed.withColumn("score", F.col("weight") + _noise(F.col("id"), seed)).withColumn("row", F.monotonically_increasing_id()))
    able = F.col("n_words") >= least_words
    total = scored.filter(able).count()
    chosen = able & drawn(scored.filter(able), percent * total // 100, total, accuracy)
    ranked = numbered(scored.filter(chosen), *_order()).withColumn("rank", F.col("number") + 1)
    # One stored table, told apart by a condition: no row is moved to find out what was not drawn.
    rest = scored.filter(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
