"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes, in DataFrame functions only.

Rows are first dealt to parts by a hash. How many rows of part ``v`` go to shard ``s`` is drawn from the multivariate
hypergeometric distribution with the part sizes and the shard sizes as margins, which is how a uniform permutation of all
rows would spread them. Each part is permuted by itself, cut at these counts, and sent; each shard is then permuted
again, in blocks. The matrix has parts x shards numbers; the parts are bounded by ``MAX_PARTS``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageglean.session import materialize

ROWS_PER_PART = 50_000
MAX_PARTS = 8192
LAW = "rows"


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One exact draw for populations of any size: the distribution function around the mode, inverted.

    Beyond twelve standard deviations the mass is below the rounding of doubles.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(max(0.0, draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1))))
    low, high = max(low, mode - int(12 * spread) - 20), min(high, mode + int(12 * spread) + 20)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def communication_matrix(part_sizes: list[int], shard_sizes: list[int], seed: int) -> np.ndarray:
    """Rows of each part for each shard. Row sums are the part sizes and column sums the shard sizes."""
    rng = np.random.default_rng(seed)
    room, matrix = list(shard_sizes), np.zeros((len(part_sizes), len(shard_sizes)), dtype=np.int64)
    for v, size in enumerate(part_sizes):
        left, others = size, sum(room)
        for s in range(len(room)):
            others -= room[s]
            taken = hypergeometric(rng, room[s], others, left)
            matrix[v, s], left = taken, left - taken
        for s in range(len(room)):
            room[s] -= int(matrix[v, s])
    return matrix


def shuffle_shards(rows: DataFrame, n_shards: int = 8, seed: int = 1, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The rows with ``shard`` (0 to n_shards - 1) and ``slot`` (0, 1, ... without gaps in each shard).

    Shard sizes differ by one at most, and each shard is in random order. Where a row goes hangs on the hash of all its
    columns, its place in the table and the seed, so equal rows are spread like all others, however many there are. The
    table is read several times and has to be stored; a rerun over the same stored rows gives the same. Nulls hash as values,
    an empty table gives no rows. Columns named ``shard`` or ``slot`` are replaced.
    """
    rows = rows.drop("shard", "slot")
    columns = rows.columns
    # Hashes of maps and the like are not defined, so only columns that hash are used.
    kinds = [f.name for f in rows.schema.fields if not f.dataType.simpleString().startswith(("map", "variant"))]
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.xxhash64(F.monotonically_increasing_id(), *[F.col(f"`{c}`") for c in kinds]).alias("_key"))

    def turned(n: int):
        return F.xxhash64("_key", F.lit(seed * 8 + n))

    total = keyed.count()
    parts = max(1, min(MAX_PARTS, math.ceil(total / rows_per_part)))
    dealt = keyed.withColumn("_part", F.pmod(turned(0), F.lit(parts)).cast("int"))
    sizes = dict(dealt.groupBy("_part").count().collect())  # at most MAX_PARTS rows
    part_sizes = [sizes.get(v, 0) for v in range(parts)]
    shard_sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    ends = np.cumsum(communication_matrix(part_sizes, shard_sizes, seed), axis=1)
    spark = rows.sparkSession
    plan = spark.createDataFrame([(v, [int(x) for x in ends[v]]) for v in range(parts)], "_part int, _ends array<long>")
    place = F.row_number().over(W.partitionBy("_part").orderBy(turned(1), "_key"))
    cut = dealt.withColumn("_place", place).join(F.broadcast(plan), "_part").withColumn(
        "shard", F.size(F.filter("_ends", lambda e: e < F.col("_place"))))
    # Second permutation: a shard is as many blocks as parts make up a shard, ordered by the hash that orders its rows.
    blocks = max(1, math.ceil(parts / n_shards))
    sent = cut.withColumn("_turn", turned(2)).withColumn("_block", F.pmod(F.shiftrightunsigned("_turn", 32), F.lit(blocks)).cast("int"))
    held = sent.groupBy("shard", "_block").count()
    before = held.select("shard", "_block", F.coalesce(F.sum("count").over(
        W.partitionBy("shard").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("shard", "_block").orderBy("_turn", "_key"))
    return sent.withColumn("_inside", inside).join(F.broadcast(before), ["shard", "_block"]).select(
        "_row.*", F.col("shard").cast("int").alias("shard"), (F.col("_before") + F.col("_inside") - 1).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = 8, seed: int = 1) -> DataFrame:
    """All documents in shards by the law of equal row counts.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1, ``text_crc32`` the unsigned CRC-32 of these bytes, and
    ``grown_shard`` is null, since this law makes no promise for another number of shards. Only these small columns are
    shuffled; texts stay where they are read.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    small = docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    # Counted, dealt and joined below, so the texts are read once.
    return shuffle_shards(materialize(small), n_shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
