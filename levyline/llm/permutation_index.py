"""Approximate nearest neighbours by a permutation index (largest inner product).

A vector is represented by the order of all ``PIVOTS`` pivots by nearness to it. It is posted, with that order, in the
inverted files of its ``LISTS`` nearest pivots; a query reads the files of its ``PROBES`` nearest pivots. In a file
the postings are ranked by footrule distance (the sum of differences of each pivot's places) to the query and reranked by
inner product in that order, ``STEP`` at a time, until a step no longer changes the query's best k. A posting that
several of the query's files hold is looked at only in the one of the pivot nearest to the query.

For largest inner products, rows are scaled by the largest norm R and given one more component, sqrt(1 - (|x| / R)^2), queries
a zero there: nearness of directions is then the order of inner products. Equal vectors are one class, posted and searched
once however many rows hold them; of a class the k + 1 smallest ids matter to any query. Files are dealt into blocks of rows
and of queries, so a pivot near a third of all rows becomes many groups. Queries that find fewer than k rows although
more exist are compared with all rows, in blocks.

The pivots are a bounded sample: the ``PIVOTS`` distinct vectors with the smallest hash of their id. Every row is posted.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows with a null
id. Shorter vectors count as padded with zeros. Of an id's rows the smallest vector counts. Scores are double-precision
sums in order of the components. Equal scores: smaller id first. With no row the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, stored

#: Pivots (also the length of a permutation; at most 128, so that places fit a byte).
PIVOTS = 128
#: Files a row is posted in, and files a query reads.
LISTS = 4
PROBES = 40
#: Postings reranked at a time, in order of footrule distance.
STEP = 32
#: Postings and queries of a block of a file.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048


def participants(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows (id, v) that take part, one an id."""
    v = F.col(vec_col)
    sound = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))
    zero = F.forall(v, lambda x: x.cast("double") == 0)
    element = "float" if isinstance(rows.schema[vec_col].dataType.elementType, T.FloatType) else "double"
    rows = rows.where(F.col(id_col).isNotNull() & v.isNotNull()).where(sound & ~zero)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.cast(f"array<{element}>").alias("v"))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a list column as rows of doubles, padded with zeros."""
    size = np.asarray(column.value_lengths().fill_null(0))
    out = np.zeros((len(column), dim))
    out[np.arange(dim)[None] < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _orders(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pivots from nearest to farthest, place of each pivot) of each row."""
    order = np.argsort(-(np.column_stack([x, extra]) @ pivots.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1).astype(np.int8)
    return order, place


def _posted(side: int, files: int, pivots: np.ndarray, largest: float):
    """(cls, v) -> (side, file, cls, place, x) for the nearest ``files`` pivots of each row (side 0) or query (side 1)."""
    dim = pivots.shape[1] - 1

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1), dim)
            extra = np.sqrt(np.maximum(0.0, 1 - (np.linalg.norm(x / largest, axis=1)) ** 2)) if side == 0 else np.zeros(len(x))
            order, place = _orders(x / largest, extra, pivots)
            n = min(files, len(pivots))
            at = np.repeat(np.arange(len(x)), n)
            width = lambda m: pa.FixedSizeBinaryArray.from_buffers(pa.binary(m.shape[1] * m.itemsize), len(m), [None, pa.py_buffer(np.ascontiguousarray(m).tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), side, np.int32)), pa.array(order[:, :n].ravel().astype(np.int32)), b.column(0).take(pa.array(at)), width(place).take(pa.array(at)), b.column(1).take(pa.array(at))],
                ["side", "file", "cls", "place", "v"],
            )

    return run


def _footrule(places: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Footrule distances of one permutation to others; a difference of places below 128 fits a byte."""
    return np.abs(places - place).sum(axis=1, dtype=np.int32)


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed in order of the components."""
    return np.add.accumulate(x * q, axis=1)[:, -1] if x.size else np.zeros(len(x))


def _best(k: int, dim: int, whole: bool):
    """A block of a file and of its queries -> (q, cls, score): the best k of each query."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("cls").combine_chunks()
        side = t.column("side").to_numpy()
        rows, asks = t.filter(pa.array(side == 0)).combine_chunks(), t.filter(pa.array(side == 1)).combine_chunks()
        out = ([], [], [])
        if rows.num_rows and asks.num_rows:
            chunk = lambda c: c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
            take = lambda t: (t.column("cls").to_numpy(), np.frombuffer(b"".join(t.column("place").to_pylist()), np.int8).reshape(t.num_rows, -1), _matrix(chunk(t.column("v")), dim))
            (ids, places, x), (asking, asked, q) = take(rows), take(asks)
            file = int(t.column("file")[0].as_py())
            posted = np.nonzero(places < LISTS)[1].reshape(len(ids), -1)
            for i in range(len(asking)):
                mine = ids != asking[i]
                if not whole:  # the file of the pivot nearest to the query, of those that hold the row
                    mine &= asked[i][posted].min(axis=1) == asked[i][file]
                mine = np.flatnonzero(mine)
                if not len(mine):
                    continue
                mine = mine[np.argsort(_footrule(places[mine], asked[i]), kind="stable")]
                top, score, at = mine[:0], np.zeros(0), 0
                while at < len(mine):
                    to = len(mine) if whole else at + STEP
                    ids_, s = np.concatenate([top, mine[at:to]]), np.concatenate([score, _exact(x[mine[at:to]], q[i])])
                    keep = np.lexsort((ids[ids_], -s))[:k]
                    same = len(top) == k and np.array_equal(ids_[keep], top)
                    top, score, at = ids_[keep], s[keep], to
                    if same:
                        break
                out[0].append(np.full(len(top), asking[i]))
                out[1].append(ids[top])
                out[2].append(score)
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return pa.table({"q": pa.array(join(out[0], np.int64)), "cls": pa.array(join(out[1], np.int64)), "score": pa.array(join(out[2], np.float64))})

    return run


def _searched(rows: DataFrame, asks: DataFrame, k: int, dim: int, whole: bool) -> DataFrame:
    """Best classes (q, cls, score) found in the files; every block of a file's rows meets every block of its queries."""
    sizes = rows.groupBy("file").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("nx"))
    sizes = sizes.join(asks.groupBy("file").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).alias("nq")), "file")
    sizes = F.broadcast(sizes)  # at most PIVOTS rows
    own = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    columns = ["side", "file", "cls", "place", "v"]
    x = rows.join(sizes, "file").select(*columns, own("nx").alias("bx"), every("nq").alias("bq"))
    y = asks.join(sizes, "file").select(*columns, own("nq").alias("bq"), every("nx").alias("bx"))
    return x.unionByName(y).groupBy("file", "bx", "bq").applyInArrow(_best(k, dim, whole), "q long, cls long, score double")


def nearest(vectors: DataFrame, asks: Column | None = None, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of each row for which ``asks`` (of column ``id``) holds.

    Without ``asks`` every row is a query. A row is never its own neighbour.
    """
    spark = vectors.sparkSession
    ship(spark)
    asks = F.lit(True) if asks is None else asks
    rows = stored(participants(vectors, id_col, vec_col), "ann-rows")
    classes = stored(rows.groupBy("v").agg(F.min("id").alias("cls"), F.max(F.when(asks, True)).alias("asked")), "ann-classes")
    members = stored(rows.join(classes.select("v", "cls"), "v").select("id", "cls"), "ann-members")
    result = "query_id long, rank int, vec_id long, score double"
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    size = classes.agg(F.max(F.size("v")), F.max(norm)).first()
    if size[0] is None:
        return spark.createDataFrame([], result)
    dim, largest = size[0], float(size[1])
    sample = classes.orderBy(F.xxhash64("cls"), "cls").limit(PIVOTS).select("v").collect()  # at most PIVOTS vectors
    p = np.zeros((len(sample), dim))
    for i, r in enumerate(sample):
        p[i, : len(r["v"])] = r["v"]
    p /= largest
    pivots = np.column_stack([p, np.sqrt(np.maximum(0.0, 1 - (p * p).sum(axis=1)))])
    vector = classes.schema["v"].dataType.simpleString()
    posted = f"side int, file int, cls long, place binary, v {vector}"
    queries = classes.where("asked").select("cls", "v")
    files = stored(classes.select("cls", "v").mapInArrow(_posted(0, LISTS, pivots, largest), posted), "ann-files")
    reads = stored(queries.mapInArrow(_posted(1, PROBES, pivots, largest), posted), "ann-reads")
    own = queries.select(F.col("cls").alias("q"), "cls", F.aggregate(F.transform("v", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda s, x: s + x).alias("score"))
    first = members.withColumn("nth", F.row_number().over(Window.partitionBy("cls").orderBy("id"))).where(F.col("nth") <= k + 1).select("cls", "id")

    def ranked(found: DataFrame) -> DataFrame:
        """The k + 1 best rows (q, id, score) of each query class, its own rows among them."""
        best = Window.partitionBy("q").orderBy(F.desc("score"), "cls")
        found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k).select("q", "cls", "score").unionByName(own)
        by = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        found = found.join(first, "cls").withColumn("nth", F.row_number().over(by))
        return found.where(F.col("nth") <= k + 1).select("q", "id", "score")

    found = stored(ranked(_searched(files, reads, k, dim, False)), "ann-found")
    enough = min(k + 1, members.count())
    short = found.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < enough).select(F.col("q").alias("cls"))
    if not short.isEmpty():
        everything = F.lit(0).alias("file")
        all_rows = files.dropDuplicates(["cls"]).select("side", everything, "cls", "place", "v")
        all_asks = reads.join(short, "cls", "left_semi").dropDuplicates(["cls"]).select("side", everything, "cls", "place", "v")
        more = _searched(all_rows, all_asks, k, dim, True)
        own = own.join(short, "cls", "left_semi")
        found = found.join(short.select(F.col("cls").alias("q")), "q", "left_anti").unionByName(ranked(more))
    ids = members.where(asks).select(F.col("id").alias("query_id"), F.col("cls").alias("q"))
    rows = ids.join(found, "q").where(F.col("id") != F.col("query_id"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return rows.select("query_id", F.row_number().over(by).alias("rank"), F.col("id").alias("vec_id"), "score").where(F.col("rank") <= k)
