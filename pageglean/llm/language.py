"""Language ID: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log probabilities, one row per hash bucket and one column per language. Its size is the number
of languages times ``buckets``, whatever the data, so it is broadcast. Texts are scored in batches: their code points
become n-gram buckets in numpy, and the matrix rows of these are added up per text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = (2, 3)
BUCKETS = 1 << 16
# The model is fitted on about so many documents of each language, chosen by a hash of their id.
ROWS_PER_LANGUAGE = 4000
UNKNOWN = "und"
CODE_POINTS = 1 << 20

_MULTIPLY = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_PLAIN_LETTER = re.compile("[A-Za-z]")


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prior: np.ndarray  # log, one per language
    weights: np.ndarray  # log, buckets x languages


def has_letters(text: str | None) -> bool:
    """Whether a text holds a letter of any script (Unicode category L)."""
    return bool(text) and (_PLAIN_LETTER.search(text) is not None or any(map(str.isalpha, set(text))))


def _pieces(text: str) -> Iterator[np.ndarray]:
    """Code points of the lower-case text with a blank around it, in overlapping pieces."""
    padded = f" {text.lower()} "
    step = CODE_POINTS - max(ORDERS) + 1
    for at in range(0, max(1, len(padded) - max(ORDERS) + 1), step):
        yield np.frombuffer(padded[at:at + CODE_POINTS].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _grams(points: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of all n-grams of every order whose first code point leaves room for the longest."""
    n = len(points) - max(ORDERS) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    wide, found = points.astype(np.uint64), []
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    with np.errstate(over="ignore"):
        for order in ORDERS:
            h = np.full(n, order, dtype=np.uint64)
            for i in range(order):
                h = (h + wide[i:i + n]) * np.uint64(_MULTIPLY[i])
                h ^= h >> np.uint64(29)
            found.append((h * np.uint64(_MULTIPLY[0])) >> shift)
    return np.concatenate(found).astype(np.int64)


def _held_out(id_column: Column) -> Column:
    return F.crc32(id_column.cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows_per_language: int) -> tuple[DataFrame, dict[str, int]]:
    """The bounded sample to learn from, and how many documents each language has to learn from.

    Documents whose ``crc32(id) % 5`` is 0, without id, text or language are never learned from.
    """
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        (_held_out(F.col("id")) != 0) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {lang: n for lang, n in usable.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return usable.limit(0).select("lang", "text"), {}
    share = F.element_at(F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, rows_per_language / n)))]), F.col("lang"))
    turn = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
    return usable.filter(turn < share).select("lang", "text"), sizes


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_per_language: int = ROWS_PER_LANGUAGE, buckets: int = BUCKETS, smoothing: float = 0.1) -> Model:
    """The model, counted on Spark over the sample; languages times buckets numbers reach the driver."""
    sample, sizes = training_rows(docs, id_col, text_col, lang_col, rows_per_language)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                total = counts.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                for points in _pieces(text):
                    total += np.bincount(_grams(points, buckets), minlength=buckets)
        for lang, total in counts.items():
            used = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": used, "n": total[used]})

    languages = sorted(sizes)
    counts = np.zeros((buckets, len(languages)))
    if languages:
        summed = sample.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        counts[summed["bucket"].to_numpy(), summed["lang"].map(languages.index).to_numpy(dtype=np.int64)] = summed["n"].to_numpy()
    weights = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * buckets)
    prior = np.log(np.array([sizes[lang] for lang in languages], dtype=float)) - np.log(max(1, sum(sizes.values())))
    return Model(languages, prior, weights.astype(np.float32))


def scores(texts, model: Model) -> np.ndarray:
    """Posterior of every language for every text."""
    logs = np.tile(model.prior, (len(texts), 1))
    waiting: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        grams = [_grams(points, len(model.weights)) for _, points in waiting]
        sizes = np.array([len(g) for g in grams])
        if sizes.sum():
            kept = sizes > 0
            begins = np.concatenate([[0], np.cumsum(sizes[kept])[:-1]])
            rows = model.weights[np.concatenate(grams)]
            sums = np.add.reduceat(rows, begins, axis=0, dtype=np.float64)
            np.add.at(logs, np.array([i for i, _ in waiting])[kept], sums)
        waiting.clear()

    for i, text in enumerate(texts):
        for points in _pieces(text or ""):
            waiting.append((i, points))
            held += len(points)
            if held >= CODE_POINTS:
                flush()
                held = 0
    flush()
    logs -= logs.max(axis=1, keepdims=True)
    odds = np.exp(logs)
    return odds / odds.sum(axis=1, keepdims=True)


def labels(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    spoken = np.array([bool(model.languages) and has_letters(t) for t in texts], dtype=bool)
    names, best = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
    if spoken.any():
        odds = scores([t for t, s in zip(texts, spoken) if s], model)
        names[spoken] = np.array(model.languages, dtype=object)[odds.argmax(axis=1)]
        best[spoken] = odds.max(axis=1)
    return names, best


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of the documents with ``lang_pred`` and ``score``, the posterior of that language (0 to 1).

    A text that is null or has no letters, and every text if no language was learned, gets ``und`` and score 0. Ties go
    to the language that sorts first. Other columns, of whatever names, are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, best = labels(batch.column(text_col).to_pylist(), shared.value)
            columns = [batch.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(best)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    needed = docs.select(*dict.fromkeys([*keep, text_col]))
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return needed.mapInArrow(label, ", ".join([*kinds, "lang_pred string", "score double"]))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """Fits on the documents themselves and labels each: id, ``held_out``, ``lang_pred``, ``score``.

    Language, source and id are never inputs of a prediction. Rows without id count as not held out and are not learned
    from. Repeated rows are labelled each; an empty table gives an empty result.
    """
    model = fit(docs, id_col, text_col, lang_col, rows_per_language)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return predict(plain, model).select("doc_id", F.coalesce(_held_out(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
