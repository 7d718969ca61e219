"""A pull of one source table in ranges of its key, each written and recorded on its own.

The ranges are cut at quantiles of the key, so they hold about as many rows each however the keys lie; the plan is written
once a run (created if absent), so a restarted pull uses the same cuts. Each range is one Spark job whose key and time
filters reach the source's scan (Parquet row groups, a database's WHERE). A range that is done leaves a progress
record (rows, seconds, share of the table); a pull that died is repeated by calling it again: done ranges are kept, and
only the others are read. Rows without a key are a range of their own.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from levyline.schemas import TableSpec
from levyline.sources.warehouse import Warehouse

PROGRESS = "range_no int, low bigint, high bigint, rows bigint, seconds double, done_rows bigint, percent double"
#: Rows that a range should hold.
RANGE_ROWS = 20_000_000


def plan_ranges(source: DataFrame, key: str, ranges: int | None = None, range_rows: int = RANGE_ROWS) -> dict:
    """Cuts {"edges": [...], "rows": n}: range i holds the keys from edges[i] (exclusive) to edges[i + 1] (inclusive)."""
    n, low, high = source.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    if low is None:
        return {"edges": [], "rows": n}
    ranges = ranges or max(1, -(-n // range_rows))
    inner = source.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] if ranges > 1 else []
    return {"edges": sorted({int(low) - 1, *map(int, inner), int(high)}), "rows": n}


def _conditions(key: str, edges: list[int]) -> list[tuple[int | None, int | None, Column]]:
    out = [(a, b, (F.col(key) > a) & (F.col(key) <= b)) for a, b in zip(edges, edges[1:])]
    return [*out, (None, None, F.col(key).isNull())]


def pull(wh: Warehouse, spec: TableSpec, source: DataFrame, run_id: str, ranges: int | None = None, parallel: int = 4,
         heard: Callable[[dict], None] = lambda progress: None) -> DataFrame:
    """The rows of ``source``, stored by range under the run's slice; ``heard`` gets each range's progress as it is done."""
    folder = f"{wh.slice_path(spec.name, run_id)}/_progress"
    if not wh.exists(f"{folder}/plan.json"):
        wh.files.create(f"{folder}/plan.json", json.dumps(plan_ranges(source, spec.key, ranges)))
    plan = json.loads(wh.files.read(f"{folder}/plan.json"))
    done = {r["range_no"]: r for r in progress_rows(wh, spec, run_id)}

    def one(i: int, low: int | None, high: int | None, condition: Column) -> dict:
        t0, obs = time.perf_counter(), Observation()
        rows = source.filter(condition).observe(obs, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").parquet(f"{wh.slice_path(spec.name, run_id)}/range={i}")
        return {"range_no": i, "low": low, "high": high, "rows": int(obs.get["rows"]), "seconds": round(time.perf_counter() - t0, 3)}

    todo = [(i, *c) for i, c in enumerate(_conditions(spec.key, plan["edges"])) if i not in done]
    read = sum(r["rows"] for r in done.values())
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for result in pool.map(lambda x: one(*x), todo):
            read += result["rows"]
            result |= {"done_rows": read, "percent": round(100.0 * read / plan["rows"], 2) if plan["rows"] else 100.0}
            wh.files.create(f"{folder}/{result['range_no']:09d}.json", json.dumps(result))
            heard(result)
    return wh.spark.read.schema(source.schema).parquet(wh.slice_path(spec.name, run_id)).select(*source.columns)


def progress_rows(wh: Warehouse, spec: TableSpec, run_id: str) -> list[dict]:
    """The progress records of a pull so far, one a finished range."""
    folder = f"{wh.slice_path(spec.name, run_id)}/_progress"
    return [json.loads(wh.files.read(f"{folder}/{n}")) for n in wh.files.names(folder) if n.endswith(".json") and n[0].isdigit()]


def progress(wh: Warehouse, spec: TableSpec, run_id: str) -> DataFrame:
    names = [c.split()[0] for c in PROGRESS.split(", ")]
    return wh.spark.createDataFrame([tuple(r[n] for n in names) for r in progress_rows(wh, spec, run_id)], PROGRESS)
