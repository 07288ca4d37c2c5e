"""Joins of a large table with a table that is usually, but not surely, small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast up to this many bytes of column data.
BROADCAST_BYTES = 64 << 20


def _width(df: DataFrame) -> Column:
    """Bytes one row takes, counting the text it really holds."""
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        elif isinstance(field.dataType, T.ArrayType):
            width = width + F.coalesce(F.size(F.col(field.name)), F.lit(0)) * 16 + 24
        else:
            width = width + 16
    return width


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table: counted, not estimated, by one distributed sum."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_width(df))).first()
    return rows, size or 0


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measure(df)[1] <= max_bytes


def join_sized(big: DataFrame, other: DataFrame, on, how: str = "inner", small: bool = False) -> DataFrame:
    """Join that broadcasts ``other`` where it was measured to be small.

    Otherwise it is a shuffled join, where adaptive execution splits the partitions of a hot key on the big side.
    """
    return big.join(F.broadcast(other) if small else other, on, how)


def lookup(big: DataFrame, other: DataFrame, on, how: str = "inner", max_bytes: int | None = None) -> DataFrame:
    """Join with a dimension. Its size as shuffled decides at run time if it is broadcast, so that it is computed once.

    With ``max_bytes`` it is measured beforehand: worth its price where the big rows are too wide to be shuffled.
    """
    return join_sized(big, other, on, how, max_bytes is not None and fits_broadcast(other, max_bytes))
