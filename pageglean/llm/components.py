"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageglean.session import materialize

# So many links are worth a task; fewer are not spread over more tasks and files.
LINKS = 1 << 16


def _toward_least(links: DataFrame, larger_only: bool, tasks: int) -> DataFrame:
    """Each node's neighbours linked to the least of the node and its neighbours instead.

    ``larger_only`` moves the larger neighbours (a large star); otherwise the node and its smaller neighbours move (a
    small star). The least is found by an aggregate that is combined before its shuffle, and brought back by a join whose
    hot nodes adaptive execution splits.
    """
    both = links if not larger_only else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    moved = both.join(least, "a").coalesce(tasks)
    if larger_only:
        return moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct().coalesce(tasks)
    pairs = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(moved.select("a", F.col("least").alias("b")))
    return pairs.filter(F.col("a") != F.col("b")).distinct().coalesce(tasks)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node of links ``a``, ``b`` (no order, no loops needed).

    The links become a star around the least node of each component; a round is stored in the shared folder, and the
    number of rounds grows with the logarithm of the longest path.
    """
    held = materialize(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen, tasks = state, 1 + state[0] // LINKS
        held = materialize(_toward_least(_toward_least(held.coalesce(tasks), True, tasks), False, tasks))
    return held.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        held.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
