"""Broadcast only behind a size check: measured rows × declared row width against a byte limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broadcast limit for dimension sides whose size has been measured.
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Hint ``df`` for broadcast when its row count × ``row_bytes`` is within ``limit``; else leave it to the
    shuffled join. Counting stops at the limit (``limit`` rows + 1), so a large side costs a bounded scan; for a
    stored Parquet version the count is answered from file footers."""
    max_rows = max(limit // max(row_bytes, 1), 1)
    n = df.limit(max_rows + 1).count()
    return (F.broadcast(df), True) if n <= max_rows else (df, False)
