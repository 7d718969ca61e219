"""Source profile of a table: existence, counts, required columns, time ranges, status histogram, amounts,
latest rows. Each figure is one aggregate (or one top-k) over the table; no rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a stored table exists (schema readable) at ``path``."""
    try:
        spark.read.format(fmt).load(path).schema  # noqa: B018 - resolving the schema is the check
        return True
    except AnalysisException:
        return False


def schema_check(df: DataFrame, table: str, expected: Sequence[str], exists: bool = True) -> DataFrame:
    """One row: table_name, table_exists, row_count, column_count, n_missing, missing_columns ('|'-joined)."""
    missing = [c for c in expected if c not in df.columns]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"),
        F.lit(exists).alias("table_exists"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(len(missing)).alias("n_missing"),
        F.lit("|".join(missing)).alias("missing_columns"),
    )


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet reads answer counts and ranges from the files' footers."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_profile(spark: SparkSession, paths: Sequence[str], table: str, column: str) -> DataFrame:
    """One row (table_name, row_count, column_count, min_<column>, max_<column>) of a stored table; no row of it is read.

    ``column`` is a number or a date: for those Parquet footers hold exact ranges."""
    rows = footer_session(spark).read.parquet(*paths)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")).select(
        F.lit(table).alias("table_name"), "row_count", F.lit(len(rows.columns)).alias("column_count"), f"min_{column}", f"max_{column}"
    )


def time_ranges(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Earliest and latest value of each time column, in one row."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_earliest"), F.max(c).alias(f"{c}_latest")]
    return df.agg(*aggs)


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values with their counts; ties broken by the value. A top-k report by definition."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.col("cnt").desc(), F.col(column).asc_nulls_last())
        .limit(k)
    )


def amount_summary(df: DataFrame, column: str) -> DataFrame:
    """min, max, avg and total of the non-NULL amounts, avg and total rounded half away from zero to cents."""
    vals = df.filter(F.col(column).isNotNull())
    return vals.agg(
        F.min(column).alias("min_amt"),
        F.max(column).alias("max_amt"),
        F.round(F.avg(column), 2).alias("avg_amt"),
        F.round(F.sum(column), 2).alias("total_amt"),
    )


def latest_rows(df: DataFrame, time_column: str, key: str, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The n latest rows by ``time_column`` (NULLs last), newest key first among equal times."""
    return df.select(*columns).orderBy(F.col(time_column).desc_nulls_last(), F.col(key).desc()).limit(n)
