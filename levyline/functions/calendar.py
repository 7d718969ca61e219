"""Calendar parts of a zone-free timestamp (``timestamp_ntz``); none depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(text: str) -> Column:
    """A ``timestamp_ntz`` literal from 'yyyy-MM-dd[ HH:mm:ss]'."""
    return F.lit(text).cast("timestamp_ntz")


def date_lit(text: str) -> Column:
    return F.lit(text).cast("date")


def day(ts: Column | str) -> Column:
    """date(ts)."""
    return F.to_date(_c(ts))


def month_start(ts: Column | str) -> Column:
    """date_trunc('month', ts) kept as ``timestamp_ntz`` (Spark's date_trunc would return a zoned timestamp)."""
    return F.trunc(F.to_date(_c(ts)), "month").cast("timestamp_ntz")


def year(ts: Column | str) -> Column:
    """extract(year from ts)::int."""
    return F.year(_c(ts))


def year_month(ts: Column | str) -> Column:
    """to_char(ts, 'YYYY-MM'): calendar year, not week-year, hence 'yyyy'."""
    return F.date_format(F.to_date(_c(ts)), "yyyy-MM")
