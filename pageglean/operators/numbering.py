"""Consecutive numbers over a whole table, without one big window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageglean.session import materialize


def numbered(df: DataFrame, *order: Column | str, column: str = "number") -> DataFrame:
    """The rows with ``column``, counting from 0 in the given order.

    Rows are dealt to partitions by ranges of the order and sorted there; a row's number is its place in its partition
    plus the sizes of the partitions before. So no task sees more than a range, and what is in one place is a size per
    partition. Rows equal in ``order`` may be numbered either way and lie in one range: where a value may be frequent, end
    the order with a column that tells its rows apart. The table is read twice (ranges are sampled first): store it before
    if it is costly to make.
    """
    part, at = f"{column}_part", f"{column}_at"
    in_order = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The lower 33 bits of the generated id are the row's place in its partition.
    placed = materialize(in_order.withColumn(part, F.spark_partition_id()).withColumn(
        at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # One row per partition, whatever the table holds.
    offsets = F.broadcast(sizes.select(part, before.alias("before")))
    others = [F.col(c) for c in df.columns]
    return placed.join(offsets, part).select(*others, (F.col("before") + F.col(at)).alias(column))
