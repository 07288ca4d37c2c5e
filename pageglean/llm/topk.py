"""Exact top-k by inner product over norm-sorted vectors.

All vectors are rotated by the eigenvectors of their second moments (a singular value decomposition of the data), which
moves most of the length into the first components and changes no inner product. Vectors are packed into blocks by
falling length. A query goes through the blocks of a stripe in that order with the k best so far: it stops at the first
block whose longest vector times its own length cannot reach the k-th score; inside a block the sum over the first
components plus the product of the remaining lengths (Cauchy-Schwarz) bounds each score, and only what may reach the
k-th score is computed exactly, on the integers themselves. Ties are kept, so the smaller id can win them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageglean.session import materialize

BLOCK = 1024
QUERY_BLOCK = 1024
# Vectors of a stripe: what one task holds of the candidates.
STRIPE = 1 << 16
# Rounding of the rotated sums, as a share of the product of the lengths.
SLACK = 1e-9


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """``uid`` (one per row), ``vec_id``, ``dim``, ``v`` = floor(scale * x), and ``norm``.

    Rows without id, and vectors that are null, empty, or hold null or non-finite components, take no part.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is above infinity here
    usable = vectors.select(F.col(id_col).alias("vec_id"), v.alias("x")).filter(
        F.col("vec_id").isNotNull() & (F.size("x") > 0) & F.coalesce(finite, F.lit(False)))
    whole = usable.select("vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return whole.select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.size("v").alias("dim"), "v", norm.alias("norm"))


def _matrix(batch: pa.RecordBatch, rows: np.ndarray, dim: int) -> np.ndarray:
    """The vectors of these rows, which all have ``dim`` components."""
    column = batch.column("v").take(pa.array(rows))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), dim)


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each number of components the eigenvectors of the second moments, largest first. Moments are summed on Spark."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                m = _matrix(batch, np.flatnonzero(dims == dim), dim).astype(float)
                total[dim] = total.get(dim, 0) + m.T @ m
        for dim, t in total.items():
            i, j = np.indices(t.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(t.size, dim, dtype=np.int32)), pa.array(i.ravel()), pa.array(j.ravel()), pa.array(t.ravel())],
                                             ["dim", "i", "j", "x"])

    summed = vectors.select("dim", "v").mapInArrow(moments, "dim int, i long, j long, x double").groupBy("dim", "i", "j").agg(F.sum("x").alias("x"))
    found: dict[int, np.ndarray] = {}
    table = summed.toPandas()  # squares of the numbers of components
    for dim, part in table.groupby("dim"):
        m = np.zeros((dim, dim))
        m[part["i"], part["j"]] = part["x"]
        found[int(dim)] = np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy()
    return found


def _blocks(vectors: DataFrame, turn, size: int, parts: int) -> DataFrame:
    """Vectors packed into blocks of equal dimension by falling length: ids, integers and rotated components as bytes.

    The range is dealt by length and row, so that vectors of one length spread over tasks.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spins, n, at = turn.value, 0, TaskContext.get().partitionId()
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            uids, ids, norms = (batch.column(c).to_numpy() for c in ("uid", "vec_id", "norm"))
            for dim in np.unique(dims).tolist():
                of = np.flatnonzero(dims == dim)
                for k in range(0, len(of), size):
                    rows = of[k:k + size]
                    v = _matrix(batch, rows, dim)
                    columns = [[dim], [at + n], [float(norms[rows].max())], [uids[rows].tobytes()], [ids[rows].astype(np.int64).tobytes()],
                               [v.tobytes()], [(v.astype(float) @ spins[dim]).tobytes()]]
                    n += 1
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PACKED)], _PACKED_NAMES)

    ordered = vectors.repartitionByRange(parts, "dim", F.desc("norm"), "uid").sortWithinPartitions("dim", F.desc("norm"), "uid")
    return ordered.mapInArrow(pack, "dim int, place int, longest double, uids binary, ids binary, whole binary, turned binary")


_PACKED_NAMES = ["dim", "place", "longest", "uids", "ids", "whole", "turned"]
_PACKED = [pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


class _Block:
    def __init__(self, row: dict, lead: int):
        self.uids, self.ids = (np.frombuffer(row[c], dtype=np.int64) for c in ("uids", "ids"))
        self.whole = np.frombuffer(row["whole"], dtype=np.int64).reshape(len(self.ids), -1)
        self.longest = row["longest"]
        turned = np.frombuffer(row["turned"]).reshape(len(self.ids), -1)
        self.head, tail = turned[:, :lead], turned[:, lead:]
        self.rest = np.sqrt((tail * tail).sum(axis=1))
        self.norms = np.sqrt((turned * turned).sum(axis=1))
        self.largest = int(np.abs(self.whole).max())


def _products(a: np.ndarray, b: np.ndarray, largest: int) -> np.ndarray:
    """Inner products of integers: in doubles where these are exact, else in 64-bit integers."""
    if largest * a.shape[1] < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def search(queries: _Block, blocks: list[_Block], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its best k in these blocks, which come by falling length."""
    n = len(queries.ids)
    best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in range(n)]
    bar = np.full(n, -np.inf)
    for block in blocks:
        alive = np.flatnonzero(queries.norms * block.longest * (1 + SLACK) >= bar)
        if not len(alive):
            break
        bound = queries.head[alive] @ block.head.T + np.outer(queries.rest[alive], block.rest)
        bound += SLACK * np.outer(queries.norms[alive], block.norms) + SLACK
        may = (bound >= bar[alive, None]) & (queries.uids[alive, None] != block.uids)
        hit = np.flatnonzero(may.any(axis=1))
        if not len(hit):
            continue
        columns = np.flatnonzero(may[hit].any(axis=0))
        scores = _products(queries.whole[alive[hit]], block.whole[columns], queries.largest * block.largest)
        for row, q in enumerate(alive[hit]):
            own = may[hit[row], columns]
            ids = np.concatenate([best[q][0], block.ids[columns[own]]])
            values = np.concatenate([best[q][1], scores[row, own]])
            first = np.lexsort((ids, -values))[:k]
            best[q] = ids[first], values[first]
            if len(first) == k:
                bar[q] = best[q][1][-1]
    return best


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best rows for each query, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows of as many components but the
    query's own row, so a repeated row finds its copies and answers once per copy. Queries and candidates meet block by
    block: each task holds one block of queries and one stripe of candidates, whatever the size of the table. Scores are
    64-bit integers.
    """
    usable = materialize(integer_vectors(vectors, id_col, vector_col, scale))
    spark = vectors.sparkSession
    n, cores = usable.count(), spark.sparkContext.defaultParallelism
    turn = spark.sparkContext.broadcast(rotations(usable))
    stripes = max(cores, math.ceil(n / STRIPE))
    candidates = _blocks(usable, turn, BLOCK, max(1, min(4 * stripes, math.ceil(n / BLOCK))))
    asked = usable.filter(F.col("vec_id") % every == 0)
    queries = materialize(_blocks(asked, turn, QUERY_BLOCK, max(1, math.ceil(n / every / QUERY_BLOCK))).withColumn("query", F.monotonically_increasing_id()))
    # A query block goes to every stripe, and a candidate block to every query block of its dimension.
    numbers = queries.select("dim", F.col("query").alias("by"))
    left = queries.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    right = candidates.withColumn("of", F.pmod("place", F.lit(stripes))).join(numbers, "dim")

    def answer(asks: pa.Table, holds: pa.Table) -> pa.Table:
        found: list[tuple] = []
        stored = sorted(holds.to_pylist(), key=lambda r: -r["longest"])
        for row in asks.to_pylist():
            lead = max(1, row["dim"] // 4)
            block = _Block(row, lead)
            for uid, vec_id, (ids, scores) in zip(block.uids, block.ids, search(block, [_Block(r, lead) for r in stored], k)):
                found += [(int(uid), int(vec_id), int(i), int(s)) for i, s in zip(ids, scores)]
        columns = list(zip(*found)) if found else [[], [], [], []]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("uid", "query_id", "vec_id", "score"), columns)})

    parts = left.groupBy("query", "stripe").cogroup(right.groupBy("by", "of")).applyInArrow(answer, "uid long, query_id long, vec_id long, score long")
    place = F.row_number().over(W.partitionBy("uid").orderBy(F.desc("score"), "vec_id"))
    return parts.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
