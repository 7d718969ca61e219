"""Data tests: ``unique`` and ``not_null`` on a column, and a suite over the declared tests.

A unique test is one grouped count on the column (partial aggregation map-side, so a value repeated in a
third of the rows costs one row per task); all not_null tests of a table share a single pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyline.schemas import TableSpec
from levyline.sources.warehouse import Warehouse

SUITE_SCHEMA = "table_name string, column_name string, test_name string, failures bigint, passed boolean"


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of ``unique``: each non-NULL value held by more than one row, with its row count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unique_new_keys(wh: Warehouse, spec: TableSpec, slice_: DataFrame) -> DataFrame:
    """Keys of a new slice that repeat in it or are stored already: (table_name, column_name, value, in_slice, stored).

    The stored table is not read: its key bitmaps answer, and only those of the parts that the slice touches."""
    state = wh.log(spec.name).at()
    counts = slice_.filter(F.col(spec.key).isNotNull()).groupBy(spec.key).agg(F.count(F.lit(1)).alias("in_slice"))
    held = wh.stored_keys(spec, state, counts).withColumn("stored", F.lit(True))
    rows = counts.join(held, spec.key, "left").withColumn("stored", F.coalesce("stored", F.lit(False)))
    return rows.filter("in_slice > 1 OR stored").select(
        F.lit(spec.name).alias("table_name"), F.lit(spec.key).alias("column_name"), F.col(spec.key).cast("string").alias("value"), "in_slice", "stored"
    )


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULL count of each column in one pass, as (column_name, null_rows) rows."""
    cols = list(columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, null_rows)")


def unique_report(tables: Mapping[str, DataFrame], checks: Iterable[tuple[str, str]]) -> DataFrame:
    """Failing values of unique tests on (table, column) pairs: table_name, column_name, value, n_records."""
    parts = [
        unique_failures(tables[t], c).select(
            F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
            "n_records",
        )
        for t, c in checks
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null_report(tables: Mapping[str, DataFrame], checks: Iterable[tuple[str, str]]) -> DataFrame:
    """NULL counts of not_null tests: table_name, column_name, null_rows (one pass per table)."""
    by_table: dict[str, list[str]] = {}
    for t, c in checks:
        by_table.setdefault(t, []).append(c)
    parts = [null_counts(tables[t], cols).select(F.lit(t).alias("table_name"), "*") for t, cols in by_table.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_suite(tables: Mapping[str, DataFrame], tests: Iterable[tuple[str, str, str]]) -> DataFrame:
    """The declared tests with pass/fail: failures = failing values (unique) or NULL rows (not_null)."""
    tests = list(tests)
    uniques = [(t, c) for t, c, k in tests if k == "unique"]
    not_nulls = [(t, c) for t, c, k in tests if k == "not_null"]
    parts = []
    for t, c in uniques:
        parts.append(
            unique_failures(tables[t], c)
            .agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit("unique").alias("test_name"),
                    "failures")
        )
    if not_nulls:
        parts.append(
            not_null_report(tables, not_nulls).select(
                "table_name", "column_name", F.lit("not_null").alias("test_name"), F.col("null_rows").alias("failures")
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)
