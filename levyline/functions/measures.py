"""Aggregate measures with one definition in every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(c: Column | str) -> Column:
    """avg as double of the exact decimal sum over the non-NULL count (NULL for no values)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(col).cast("double"), F.count(col))
