"""Schema operators: rename a source extract to the target layout (by name), and the integer->text migration."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyline.schemas import TableSpec

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def to_target_layout(source: DataFrame, spec: TableSpec) -> DataFrame:
    """Source columns (mixed case names) -> the spec's snake-case columns and types, matched by name."""
    return source.select(
        *[F.col(spec.source_names.get(name, name)).cast(typ).alias(name) for name, typ in spec.columns]
    )


def source_columns(spec: TableSpec) -> list[str]:
    """The explicit column list of the source extract, in target order."""
    return [spec.source_names.get(c, c) for c in spec.column_names]


def migrate_integral_to_string(df: DataFrame, column: str) -> DataFrame:
    """If ``column`` is still integral (the old layout), turn it into text; otherwise leave the table as is."""
    if isinstance(df.schema[column].dataType, _INTEGRAL):
        return df.withColumn(column, F.col(column).cast("string"))
    return df


def conform(df: DataFrame, spec: TableSpec, extra: Iterable[str] = ()) -> DataFrame:
    """Rows stored in an older layout as rows of the table's present one, without rewriting them.

    Columns go by name, else by a former name; other types are cast (a cast that would lose values fails, as elsewhere);
    columns that the old layout lacks are their NOT NULL default, else NULL. ``extra`` columns are kept."""
    kinds, out = dict(df.dtypes), []
    for name, kind in spec.columns:
        held = name if name in kinds else spec.former_names.get(name)
        if held in kinds:
            out.append(F.col(held) if held == name and kinds[held] == kind else F.col(held).cast(kind).alias(name))
        else:
            out.append(F.expr(spec.not_null.get(name) or "NULL").cast(kind).alias(name))
    return df.select(*out, *extra)
