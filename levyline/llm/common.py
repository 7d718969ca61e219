"""Small helpers shared by the operators: table reading, shared-folder materialisation, graph components."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting (tests) gets a folder of its own; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="levyline-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so a lost executor costs only
    the tasks that ran on it, and every later reader sees the same rows."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_count(rows: int, per_split: int) -> int:
    return max(1, math.ceil(rows / per_split))


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, component) with component the smallest node.

    Alternating large-star and small-star steps; every step is a partial-aggregated minimum per node and
    an equi-join back, so a hub with a third of all links is pre-aggregated and its join side can be split.
    Each round is written to the shared folder. Nodes without a link are absent.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = _digest(e)
    for _ in range(max_rounds):
        e = stored(_small_star(_large_star(e)), name)
        after = _digest(e)
        if after == before:
            stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
        before = after
    raise RuntimeError("components did not settle")


def _digest(e: DataFrame):
    h = F.xxhash64("a", "b")
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("low"))
    moved = e.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once a context), so that functions run there can be imported by name."""
    sc = spark.sparkContext
    if getattr(sc, "_levyline_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="levyline-py-"), "levyline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._levyline_shipped = True
