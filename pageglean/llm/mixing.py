"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives each document a posterior over domains, so a document belongs to all
of them in part. Nonnegative rates, one per document, are then fitted so that the expected tokens of each domain,
``sum(rate * tokens * posterior)``, meet the targets: least squares by projected gradients that start from rate 1.

With domain totals ``A r`` and ``H = sum(tokens * posterior * posterior')`` the loss is ``(A r - T)' H^-1 (A r - T) / 2``.
In the metric of the token counts its gradient for a document is ``posterior . H^-1 (A r - T)`` and its curvature is at
most 1, so steps of 1 never overshoot. A step is thus one short vector; a rate is the fold of all vectors so far over
the document's posterior. Nothing per document is ever rewritten or sent to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageglean.llm import features
from pageglean.llm import words as W
from pageglean.session import materialize

# The labelled table's domains, and the share of all tokens each is to have.
DOMAIN = "case when toxic = 1 then 2 when quality = 1 then 0 when quality = 0 then 1 end"
DOMAINS = ("good", "low", "toxic")
TARGETS = (0.93, 0.04, 0.03)
STEPS = 60
TOLERANCE = 1e-7


def fit_domains(sets: list[np.ndarray], domains: np.ndarray, n: int, buckets: int = features.BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a softmax classifier; without rows all domains are alike."""
    if not sets:
        return np.zeros((buckets, n)), np.zeros(n)
    truth = np.eye(n)[domains]

    def slopes(scores: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        miss = (softmax(scores + bias) - truth) / len(truth)
        return miss, miss.sum(axis=0)

    start = np.log(np.maximum(truth.mean(axis=0), 1e-6))
    return features.minimize(slopes, sets, n, start, buckets)


def softmax(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def posteriors(docs: DataFrame, labels: DataFrame, domain: str = DOMAIN, n_domains: int = len(DOMAINS), id_col: str = "doc_id",
               text_col: str = "text", sample_rows: int = features.SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``n_tokens`` (words of the whole text) and ``posterior``, one share per domain."""
    sets, found = features.labelled_sample(docs, labels, id_col, text_col, domain, sample_rows, features.BUCKETS)
    shared = docs.sparkSession.sparkContext.broadcast(fit_domains(sets, found, n_domains))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            odds = softmax(features.sums(weights, features.bucket_sets(texts, len(weights))) + bias)
            counts = np.array([len(W.spans(W.encoded(t))[0]) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), pa.array(list(odds), pa.list_(pa.float64()))],
                                             ["doc_id", "n_tokens", "posterior"])

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(score, f"doc_id {kind}, n_tokens long, posterior array<double>")


def rate(posterior: Column, steps: list[np.ndarray]) -> Column:
    """Rate of a document after these steps: each is subtracted along the posterior, never below 0."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])

    def step(value: Column, move: Column) -> Column:
        along = F.aggregate(F.zip_with(posterior, move, lambda p, m: p * m), F.lit(0.0), lambda a, x: a + x)
        return F.greatest(F.lit(0.0), value - along)

    return F.aggregate(moves, F.lit(1.0), step)


@dataclass(frozen=True)
class Fit:
    steps: list[np.ndarray]
    totals: np.ndarray
    wanted: np.ndarray


def fit_rates(members: DataFrame, targets: tuple[float, ...], total: float | None = None, max_steps: int = STEPS, tolerance: float = TOLERANCE) -> Fit:
    """The steps that bring the expected domain tokens to ``targets`` (shares) of ``total`` (all tokens if not given).

    ``members`` has ``n_tokens`` and ``posterior``. Each step is one aggregate over it; as many sums as domains squared
    reach the driver. Without tokens there are no steps.
    """
    n, tokens = len(targets), F.col("n_tokens")
    share = [F.get("posterior", F.lit(k)) for k in range(n)]
    first = members.agg(*[F.sum(tokens * share[a] * share[b]).alias(f"h{a}_{b}") for a in range(n) for b in range(n)],
                        *[F.sum(tokens * share[a]).alias(f"t{a}") for a in range(n)]).first()
    totals = np.array([first[f"t{a}"] or 0.0 for a in range(n)])
    wanted = np.array(targets) / sum(targets) * (totals.sum() if total is None else total)
    if totals.sum() == 0:
        return Fit([], totals, wanted)
    curvature = np.array([[first[f"h{a}_{b}"] for b in range(n)] for a in range(n)])
    # Domains that no document tells apart leave the matrix short of rank; those directions are left out.
    inverse, steps = np.linalg.pinv(curvature, rcond=1e-9, hermitian=True), []
    while len(steps) < max_steps and np.abs(totals - wanted).max() > tolerance * wanted.sum():
        steps.append(inverse @ (totals - wanted))
        now = rate(F.col("posterior"), steps)
        sums = members.select(tokens.alias("n_tokens"), F.col("posterior"), now.alias("rate")).agg(
            *[F.sum(F.col("rate") * tokens * share[a]).alias(f"t{a}") for a in range(n)]).first()
        totals = np.array([sums[f"t{a}"] for a in range(n)])
    return Fit(steps, totals, wanted)


def mix(docs: DataFrame, labels: DataFrame, targets: tuple[float, ...] = TARGETS, domain: str = DOMAIN, total: float | None = None,
        seed: int = 1, sample_rows: int = features.SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``posterior``, ``rate`` and ``copies`` of every document.

    ``copies`` is a whole number whose expectation is the rate, drawn by a hash of id and seed. A null or empty text has
    no tokens and moves no total; its rate follows its posterior like any other. Without labels all domains are alike
    and the rates stay 1. Repeated rows are rated alike; other columns are not looked at; an empty table stays empty.
    """
    members = materialize(posteriors(docs, labels, domain, len(targets), sample_rows=sample_rows))
    found = fit_rates(members, targets, total)
    rated = members.withColumn("rate", rate(F.col("posterior"), found.steps))
    turn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return rated.withColumn("copies", (F.floor("rate") + F.when(turn < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int"))
