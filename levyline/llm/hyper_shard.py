"""Uniform shuffle into shards of exact sizes with a hypergeometric communication matrix.

Rows are dealt into blocks by a hash of all their columns. How many rows of each block go to each shard is
drawn exactly as a uniform shuffle would give it: a multivariate hypergeometric matrix whose row sums are the
blocks' counts and whose column sums are the shards' exact sizes. Blocks permute their rows and hand out the
drawn numbers, the rows are exchanged, and every shard permutes what it received: a second random key sorts
its rows, cell by cell (a cell is a range of keys, so no shard is ever one task), and gives gapless slots.

The matrix is drawn as a tree: the driver draws groups of blocks (at most ``GROUPS`` x shards numbers,
whatever the input), and tasks draw the blocks of each group given its totals, which is the same law.
Every draw's seed derives from ``seed`` and the place in the tree, and every row's keys from its content, so
a lost task's rerun repeats its result. Rows equal in all columns are interchangeable.

Defined results: null and empty texts are rows as any other; an empty table gives no rows; shard sizes are at
most one row apart (law ``rows``; the first ``n % shards`` shards have one more). Equal texts are dealt
independently, as a uniform shuffle demands. Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, split_count

SHARDS = 16
#: Rows a block (and a cell of a shard) holds on average.
BLOCK_ROWS = 4096
#: Groups of blocks that the driver draws.
GROUPS = 256
SEED = 20240229


def draw(rng: np.random.Generator, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """A random matrix of the given row and column sums, distributed as in a uniform shuffle."""
    out, left = np.zeros((len(rows), len(columns)), np.int64), columns.astype(np.int64).copy()
    for i, n in enumerate(rows):
        n, rest = int(n), int(left.sum())
        for j in range(len(left)):
            rest -= int(left[j])
            # numpy draws exactly up to 1e9 a side; larger sides are drawn in parts
            out[i, j] = _hypergeometric(rng, int(left[j]), rest, n)
            n -= int(out[i, j])
        left -= out[i]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn without replacement, for sides of any size."""
    if not n or not good:
        return 0
    if not bad:
        return n
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n))
    # halve the draw: the first half of the draw, then the second from what is left
    if n > 1:
        first = _hypergeometric(rng, good, bad, n // 2)
        return first + _hypergeometric(rng, good - first, bad - (n // 2 - first), n - n // 2)
    return int(rng.random() * (good + bad) < good)


def shares(total: int, shards: int) -> np.ndarray:
    return np.array([total // shards + (i < total % shards) for i in range(shards)], np.int64)


def matrix(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """``blocks(block, n)`` -> (block, upto array<long>): running totals of the block's rows by shard."""
    grouped = blocks.withColumn("group", F.pmod("block", F.lit(GROUPS)))
    sums = {r["group"]: r["n"] for r in grouped.groupBy("group").agg(F.sum("n").alias("n")).collect()}
    keys = sorted(sums)
    top = draw(np.random.default_rng([seed]), np.array([sums[k] for k in keys]), shares(sum(sums.values()), shards))
    share = dict(zip(keys, top, strict=True))

    def lower(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        got = draw(np.random.default_rng([seed, int(key[0]) + 1]), pdf["n"].to_numpy(), share[key[0]])
        return pd.DataFrame({"block": pdf["block"].to_numpy(), "upto": list(np.cumsum(got, axis=1))})

    return grouped.groupBy("group").applyInPandas(lower, "block long, upto array<long>")


def shuffle(df: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` and ``slot``, gapless from 0 in each shard."""
    ship(df.sparkSession)
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    packed = F.struct(*(F.col(f"`{c}`") for c in names))

    def key(salt: int) -> Column:
        return F.xxhash64(*(F.col(f"`{c}`") for c in names), F.lit(seed + salt))

    rows = df.select(packed.alias("row"), key(0).alias("at"), key(1).alias("first"), key(2).alias("second"))
    n = df.count()
    blocks = split_count(n, block_rows)
    rows = rows.withColumn("block", F.pmod("at", F.lit(blocks)))
    upto = matrix(rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")), shards, seed)
    # permute locally: the position in the block's random order decides the shard
    nth = F.row_number().over(Window.partitionBy("block").orderBy("first", "second"))
    rows = rows.withColumn("nth", nth).join(upto, "block")
    shard = F.size(F.filter("upto", lambda u: u < F.col("nth")))
    cells = split_count(n, block_rows * shards)
    dealt = rows.select("row", "second", "first", shard.alias("shard"), F.pmod(F.col("second"), F.lit(cells)).alias("cell"))
    # exchange, and permute again within the cell; cells follow one another in the shard
    held = dealt.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("second", "first"))
    slot = F.col("before") + F.col("nth") - 1
    return dealt.withColumn("nth", within).join(held, ["shard", "cell"]).select("row.*", F.col("shard").cast("int"), slot.cast("long").alias("slot"))
