"""The incremental merge as a Structured Streaming query: extract files landing in a folder are merged
into the warehouse table, one micro-batch per trigger.

A micro-batch writes only itself: an upsert table gets *delta* segments (the batch's rows, one a key), which readers merge
with the stored parts, last one wins; an insert-only table gets the rows whose keys the key bitmaps lack.
``compact_ratio`` bounds what readers have to merge: a part whose deltas exceed that share of its base is rewritten.

The streaming checkpoint records which files were taken, so no high-water filter is needed to find new
rows; the control row is still committed per batch (mark = max(old mark, newest event time of the batch)),
so batch and streaming runs can follow each other on the same table. Each micro-batch writes the version
``s<stream>-<epoch>``, where <stream> is the query's own id from its checkpoint: when a batch is retried after a
failure it rewrites the same folder, and does nothing once that version is committed, so the sink is idempotent (exactly-once with
the checkpoint), and another stream's epochs never coincide with it. Commits of two streams to the same parts are ordered by the
table's log: a batch adds deltas and replaces nothing, so it commits on top of what it finds.

A batch takes the rows that the batch loader would take: newer than the mark less the lookback, never those
without a time. NULL keys and NULLs in NOT NULL columns stop the stream.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from levyline.operators import watermark as wm
from levyline.operators.merge import checked_key, event_time, fold
from levyline.plans.ingest import check_rules, merged_segments, rule_counts
from levyline.schemas import FALLBACK_START, LOOKBACK_DAYS, TableSpec
from levyline.sources.warehouse import Warehouse


def stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that the query keeps in its checkpoint: a new checkpoint has a new one."""
    line = spark.read.text(f"{checkpoint_dir.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"].replace("-", "")


def merge_batch(wh: Warehouse, spec: TableSpec, batch: DataFrame, epoch_id: int, stream: str = "", fallback: str = FALLBACK_START,
                lookback_days: int = LOOKBACK_DAYS, compact_ratio: float | None = 0.25) -> None:
    """foreachBatch body: add one micro-batch to the table."""
    version = f"s{stream}-{epoch_id:012d}"
    log = wh.log(spec.name)
    if any(e["control"]["run_id"] == version for _, e in log.history()):  # this epoch of this stream was already committed
        return
    state = log.at()
    mark = wm.read_watermark(wh.control(), spec.name, fallback)
    batch = wm.extract_slice(batch, spec, wm.lookback(mark, lookback_days))
    stats = batch.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(spec.key).alias("keys"), F.max(event_time(spec)).alias("newest"),
        *rule_counts(spec),
    ).collect()[0]
    check_rules(spec, stats.asDict())
    if stats["n"] == 0:
        return
    duplicates = stats["keys"] < stats["n"]
    if spec.refresh == "insert_only":
        segments, _ = merged_segments(wh, spec, state, batch, version, duplicates, False)
    else:
        rows = checked_key(batch.select(*spec.column_names), spec.key)
        rows = fold(rows, spec.key, event_time(spec), spec.update_columns) if duplicates else rows
        segments = wh.write_parts(rows, spec, version, state, kind="delta")
    wh.commit(spec, state, version, max(mark, stats["newest"]), dt.datetime.now(), stats["n"], segments, version=version)
    if compact_ratio is not None and spec.refresh != "insert_only":
        wh.compact(spec, version, compact_ratio)


def start_merge_stream(
    spark: SparkSession,
    wh: Warehouse,
    spec: TableSpec,
    landing_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    fallback: str = FALLBACK_START,
    compact_ratio: float | None = 0.25,
) -> StreamingQuery:
    """Start the stream: Parquet extract files (in the spec's layout) under ``landing_dir``."""
    reader = spark.readStream.schema(spec.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)
    writer = (
        stream.writeStream.foreachBatch(lambda batch, epoch: merge_batch(wh, spec, batch, epoch, stream_id(spark, checkpoint_dir), fallback=fallback, compact_ratio=compact_ratio))
        .option("checkpointLocation", checkpoint_dir)
        .queryName(f"merge_{spec.name}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
