"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row.

    Without it, every mention of a derived value in an expression computes the value again.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
