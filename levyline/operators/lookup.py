"""Lookups of a fact's rows in a code table of few distinct values.

A plain shuffled join would deal the fact by the code, so that as many tasks work as there are codes, and one gets a
third of all rows if one code has them. So the code side comes to the fact: broadcast when its measured size allows. Of a larger
code table only the codes that are hot in the fact are treated so (they are counted first, and are few): their rows are broadcast if
measured small, else copied ``SALTS`` times, the fact's rows being dealt by code and a digest of their own key together. All other
codes are joined by one plain shuffle. So a hot code is spread over many tasks, and no code is copied for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyline.operators.sizing import BROADCAST_BYTES

#: Copies of a hot code's rows where they are too many to broadcast.
SALTS = 32
#: A code with more than one of so many rows of the fact is hot.
HOT = 1000


def measured_bytes(df: DataFrame, limit: int = BROADCAST_BYTES) -> int | None:
    """The rows' size as stored (characters of strings, 8 bytes for others, 16 a row), or None if over ``limit``.

    The scan stops once the limit's worth of the smallest rows is read, so a large table costs a bounded read."""
    kinds = dict(df.dtypes)
    width = F.lit(16)
    for c in df.columns:
        width = width + (F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) if kinds[c] in ("string", "binary") else F.lit(8))
    most = limit // 16
    got = df.select(width.cast("long").alias("w")).limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("bytes")).first()
    return None if got["n"] > most or (got["bytes"] or 0) > limit else int(got["bytes"] or 0)


def hot_codes(fact: DataFrame, column: str) -> list:
    """The codes that hold more than one of ``HOT`` of the fact's rows: fewer than ``HOT``, whatever the table."""
    counts = fact.select(F.col(f"`{column}`").alias("code")).where("code IS NOT NULL").groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return sorted(r["code"] for r in counts.crossJoin(F.broadcast(total)).where(F.col("n") * HOT > F.col("total")).select("code").collect())


def lookup(fact: DataFrame, codes: DataFrame, fact_column: str, code_column: str, key: str, how: str = "left", small: bool | None = None) -> DataFrame:
    """``fact`` (t) joined to ``codes`` (r) where ``fact_column`` equals ``code_column``.

    ``key`` is the fact's own key. ``small`` is what the caller has measured (None: leave it to Spark's statistics)."""
    t, r = fact.alias("t"), codes.alias("r")
    same = F.col(f"t.`{fact_column}`") == F.col(f"r.`{code_column}`")
    if small is None:
        return t.join(r, same, how)
    if small:
        return t.join(F.broadcast(codes).alias("r"), same, how)
    hot = hot_codes(fact, fact_column)
    hot_fact = F.col(f"`{fact_column}`").isNull() | F.col(f"`{fact_column}`").isin(hot)  # rows without a code are as many as any
    hot_code = F.coalesce(F.col(f"`{code_column}`").isin(hot), F.lit(False))
    theirs = codes.where(hot_code)
    if measured_bytes(theirs) is None:
        return _dealt(fact, codes, fact_column, code_column, key, how, hot_fact, hot_code)
    held = fact.where(hot_fact).alias("t").join(F.broadcast(theirs).alias("r"), same, how)
    rest = _dealt(fact.where(~hot_fact), codes.where(~hot_code), fact_column, code_column, key, how, F.lit(False), F.lit(False))
    sides = [F.struct(*(F.col(f"{side}.`{c}`") for c in df.columns)).alias(side) for side, df in (("t", fact), ("r", codes))]
    return held.select(*sides).unionByName(rest.select(*sides))


def _dealt(fact: DataFrame, codes: DataFrame, fact_column: str, code_column: str, key: str, how: str, hot_fact: Column, hot_code: Column) -> DataFrame:
    """The shuffled join: rows of a hot code are dealt by their own key as well, and only hot codes are copied.

    A merge join, as Spark's estimate of a derived code table (of compressed files) may let it be broadcast whatever its size."""
    slot = lambda c: F.pmod(F.xxhash64(f"`{c}`"), F.lit(SALTS)).cast("int")
    slots = F.when(hot_code, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(slot(code_column)))
    r = codes.withColumn("__salt", F.explode(slots)).hint("merge").alias("r")
    t = fact.withColumn("__slot", F.when(hot_fact, slot(key)).otherwise(slot(fact_column))).alias("t")
    return t.join(r, (F.col(f"t.`{fact_column}`") == F.col(f"r.`{code_column}`")) & (F.col("t.__slot") == F.col("r.__salt")), how)
