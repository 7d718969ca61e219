"""Set-based merge of a slice into a target table, keyed on one column.

Policies (``TableSpec.refresh``):
  upsert       new keys insert the whole slice row; matched keys take the slice's values for
               ``update_columns`` only (NULL overwrites) and keep every other target column.
               With update_columns = all non-key columns this is a type-1 dimension.
  insert_only  new keys insert; existing target rows never change.
  full         the target becomes the slice.

Duplicate keys inside one slice are resolved explicitly before merging, as loading its rows one after
another in time order would: the earliest row is inserted, and for upserts the latest row's update columns
replace its own (``fold``); insert-only loads keep the earliest row (``dedupe``). Ties go to the greatest
(latest) or least (earliest) whole row, so the result is deterministic. Both are grouped ``min``/``max`` of a struct,
which combine map-side: a key repeated in a third of the slice still costs one partial row per task. Such a grouping sorts
whole rows in the task that reads them, so rows whose key does not repeat pass it by (``_repeated_only``).

A NULL key is an error, as for a primary key: the merge fails when it meets one, duplicates or not. The
loaders count NULL keys while they write the slice and stop before anything is merged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyline.operators.lookup import measured_bytes
from levyline.schemas import TableSpec


def event_time(spec: TableSpec) -> Column:
    """The row's high-water time: the later of its non-NULL high-water columns (NULL if all are NULL)."""
    cols = [F.col(c) for c in spec.hwm]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def _repeated_only(df: DataFrame, key: str, resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``resolve`` (one row per key) applied to the rows whose key repeats; other rows need no grouping.

    The repeated keys are found by a hash aggregate of the keys alone and broadcast if measured small; else all rows are resolved."""
    repeated = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key")
    if measured_bytes(repeated) is None:
        return resolve(df)
    again = F.col(key).eqNullSafe(F.col("__key"))
    several = resolve(df.join(F.broadcast(repeated), again, "left_semi"))
    return df.join(F.broadcast(repeated), again, "left_anti").unionByName(several)


def dedupe(df: DataFrame, key: str, order_by: Sequence[Column | str], keep: str = "latest") -> DataFrame:
    """One row per key: the row with the greatest (``keep='latest'``) or least (``'earliest'``) order value."""
    rest = [c for c in df.columns if c != key]
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ordered = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order)], F.struct(*rest).alias("__row"))
    pick = F.max if keep == "latest" else F.min
    return _repeated_only(
        df,
        key,
        lambda d: d.groupBy(key)
        .agg(pick(ordered).alias("__m"))
        .select(key, *[F.col(f"__m.__row.{c}").alias(c) for c in rest])
        .select(*df.columns),
    )


def fold(df: DataFrame, key: str, order: Column, update_columns: Sequence[str]) -> DataFrame:
    """One row per key: the earliest row with the latest row's ``update_columns``."""
    rest = [c for c in df.columns if c != key]
    update = [c for c in rest if c in set(update_columns)]
    if set(update) == set(rest):
        return dedupe(df, key, [order])
    ordered = F.struct(order.alias("__o"), F.struct(*rest).alias("__row"))
    side = lambda c: "__z" if c in update else "__a"

    def resolve(d: DataFrame) -> DataFrame:
        both = d.groupBy(key).agg(F.min(ordered).alias("__a"), F.max(ordered).alias("__z"))
        return both.select(key, *[F.col(f"{side(c)}.__row.{c}").alias(c) for c in rest]).select(*df.columns)

    return _repeated_only(df, key, resolve)


def checked_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` whose evaluation fails at a NULL key."""
    kind = df.schema[key].dataType
    return df.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"NULL key in {key}")).cast(kind)))


def upsert(
    target: DataFrame, slice_: DataFrame, key: str, update_columns: Sequence[str], small_slice: bool = False
) -> DataFrame:
    """Upsert with a partial update list (see module doc). ``slice_`` must hold one row per key.

    ``small_slice=False``: one full outer join; both sides shuffle once on the key. Right for any size.
    ``small_slice=True`` (the caller has checked the slice's size): the slice is broadcast and the target is never
    shuffled: one pass gives its rows, updated where the slice has the key; new rows = slice rows whose key
    is not among the target keys that the broadcast slice found (at most as many as the slice has).
    """
    cols = target.columns
    update = set(update_columns)
    if small_slice:
        s = F.broadcast(slice_.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__new_{c}") for c in cols if c in update and c != key)))
        hit = F.col("__key").isNotNull()
        held = target.join(s, F.col(key) == F.col("__key"), "left").select(
            *[F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in update and c != key else F.col(c) for c in cols]
        )
        return held.unionByName(_new_rows(target, slice_, key, True))
    t, s = target.alias("t"), slice_.alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_slice = F.col(f"s.{key}").isNotNull()
    in_target = F.col(f"t.{key}").isNotNull()
    out = []
    for c in cols:
        if c == key:
            expr = F.coalesce(F.col(f"s.{key}"), F.col(f"t.{key}"))
        elif c in update:
            expr = F.when(in_slice, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        else:
            expr = F.when(in_target, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        out.append(expr.alias(c))
    return joined.select(*out)


def update_dealt(target: DataFrame, updates: DataFrame, key: str, update_columns: Sequence[str], block: Column) -> DataFrame:
    """``target`` with the ``update_columns`` of ``updates``, which hold one row for each of its keys and no other; all blocks of keys lie whole.

    Only the key and the update columns of the updates are dealt: the others are NULL, which costs next to nothing. Both sides are dealt once,
    by ``block`` (a coarse function of the key), not by key for a join and then once more for the files."""
    cols, kinds = target.columns, dict(target.dtypes)
    update = [c for c in cols if c in set(update_columns) and c != key]
    theirs = updates.select(*[F.col(c) if c == key or c in update else F.lit(None).cast(kinds[c]).alias(c) for c in cols], F.lit(1).alias("__origin"))
    both = target.withColumn("__origin", F.lit(0)).unionByName(theirs).withColumn("__block", block).repartition("__block")
    group = Window.partitionBy("__block", key).orderBy("__origin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    newest = both.withColumn("__new", F.last(F.struct(F.col("__origin"), *update)).over(group)).where("__origin = 0")
    hit = F.col("__new.__origin") == 1
    return newest.select(*[F.when(hit, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in cols])


def _new_rows(target: DataFrame, slice_: DataFrame, key: str, small_slice: bool) -> DataFrame:
    """Slice rows whose key the target lacks; a small slice is sent to the target's keys, not they to it."""
    keys = target.select(key)
    if small_slice:
        keys = keys.join(F.broadcast(slice_.select(key)), key, "left_semi").distinct()
    else:
        keys = keys.hint("merge")  # Spark's estimate of a derived table (of compressed files) may let all its keys be broadcast
    return slice_.join(keys, key, "left_anti").select(*target.columns)


def insert_only(target: DataFrame, slice_: DataFrame, key: str, small_slice: bool = False) -> DataFrame:
    """Insert slice rows whose key is absent from the target; existing rows are kept as they are."""
    return target.unionByName(_new_rows(target, slice_, key, small_slice))


def resolved(slice_: DataFrame, spec: TableSpec, dedupe_slice: bool = True) -> DataFrame:
    """The slice's rows as they go into a table that holds none of their keys: checked, one a key."""
    slice_ = checked_key(slice_.select(*spec.column_names), spec.key)
    if dedupe_slice and spec.refresh == "insert_only":
        return dedupe(slice_, spec.key, [event_time(spec)], keep="earliest")
    return fold(slice_, spec.key, event_time(spec), spec.update_columns) if dedupe_slice else slice_


def merge(
    target: DataFrame,
    slice_: DataFrame,
    spec: TableSpec,
    dedupe_slice: bool = True,
    small_slice: bool = False,
) -> DataFrame:
    """Apply ``spec.refresh`` to merge ``slice_`` into ``target`` (both in the spec's layout)."""
    cols = spec.column_names
    slice_ = slice_.select(*cols)
    if spec.refresh == "full":
        return slice_
    target = target.select(*cols)
    slice_ = resolved(slice_, spec, dedupe_slice)
    if spec.refresh == "insert_only":
        return insert_only(target, slice_, spec.key, small_slice=small_slice)
    return upsert(target, slice_, spec.key, spec.update_columns, small_slice=small_slice)
