"""Source extracts: one source table with its explicit column list, renamed by name to the target layout.

Works over any DataFrame source: stored extracts (Parquet/ORC/CSV with a schema) or a live database through
Spark's JDBC source, where the column list, the high-water filter and the partitioned read (``fetchsize``,
``partitionColumn`` / bounds / ``numPartitions``) are pushed to the database. The slice filter is applied
after the rename and Catalyst pushes it below the rename into the scan (Parquet row-group pruning, JDBC WHERE).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline.operators.schema_ops import source_columns, to_target_layout
from levyline.operators.watermark import slice_condition
from levyline.schemas import TableSpec

# Rows per fetch in the source system's batched pull.
FETCH_SIZE = 10_000


def read_stored_extract(spark: SparkSession, spec: TableSpec, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored extract in source column names (camel/mixed case)."""
    return spark.read.format(fmt).load(path)


def read_jdbc(
    spark: SparkSession,
    spec: TableSpec,
    url: str,
    table: str | None = None,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A live source table over JDBC, read in parallel ranges of ``partition_column`` when given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table or spec.name)
    reader = reader.option("fetchsize", FETCH_SIZE)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions)
        )
    return reader.load()


def extract(source: DataFrame, spec: TableSpec, since: str | dt.datetime | None = None) -> DataFrame:
    """The explicit column list, renamed to target names; with ``since``, only the slice newer than it."""
    df = to_target_layout(source.select(*[F.col(f"`{c}`") for c in source_columns(spec)]), spec)
    return df if since is None else df.filter(slice_condition(spec, since))
