"""Command line: the daily run, the weekly report and the source profile over a warehouse.

    python -m levyline daily  --warehouse PATH (--extracts DIR | --fixtures SF_DIR) [--as-of DATE] [--incremental]
    python -m levyline report --warehouse PATH --out DIR [--as-of DATE]
    python -m levyline profile (--extracts DIR | --fixtures SF_DIR)

``--extracts DIR`` holds one stored extract per source table (``DIR/<table>``, Parquet, source column names);
``--fixtures SF_DIR`` derives the six tables from the test tables instead. Each command prints one JSON line.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from levyline.operators import profile, quality
from levyline.plans import reports, staging
from levyline.plans.pipeline import MART_LAYOUT, run_daily
from levyline.schemas import FALLBACK_START, LOAD_ORDER, PROFILE_EXPECTED_COLUMNS, SPECS
from levyline.sources import fixtures
from levyline.sources.raw import extract, read_stored_extract
from levyline.sources.warehouse import Warehouse


def _sources(spark: SparkSession, args) -> dict:
    if args.fixtures:
        return fixtures.raw_tables(spark, args.fixtures)
    return {s.name: extract(read_stored_extract(spark, s, f"{args.extracts.rstrip('/')}/{s.name}"), s) for s in LOAD_ORDER}


class _CurrentMarts:
    """The marts a report reads, from a warehouse's current versions."""

    def __init__(self, wh: Warehouse):
        for model, day in MART_LAYOUT.items():
            versions = wh.mart_days(model).select("version").distinct().collect()
            if versions:
                sample = wh.spark.read.parquet(wh.mart_path(model, versions[0][0]))
                setattr(self, model, wh.read_days(model, day, sample.schema))
        self.stg_bus_ticketing_transaction = staging.stg_bus_ticketing_transaction(
            wh.read_table(SPECS["bus_ticketing_transaction"])
        )


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="levyline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--warehouse", required=True)
    src = d.add_mutually_exclusive_group(required=True)
    src.add_argument("--extracts")
    src.add_argument("--fixtures")
    d.add_argument("--as-of")
    d.add_argument("--incremental", action="store_true")
    d.add_argument("--fallback", default=FALLBACK_START)
    r = sub.add_parser("report")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--as-of")
    p = sub.add_parser("profile")
    psrc = p.add_mutually_exclusive_group(required=True)
    psrc.add_argument("--extracts")
    psrc.add_argument("--fixtures")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"levyline-{args.cmd}").getOrCreate()
    if args.cmd == "daily":
        res = run_daily(spark, _sources(spark, args), args.warehouse, dt.datetime.now().replace(microsecond=0),
                        as_of=args.as_of, incremental=args.incremental, fallback=args.fallback)
        out = {"run_id": res.run_id, "touched_days": len(res.touched_days) if res.touched_days is not None else None,
               "loads": {t.table: {"rows": t.rows, "seconds": round(t.seconds, 3), "rows_per_s": round(t.rows_per_second)}
                         for t in res.loads},
               "reports": res.report_paths}
    elif args.cmd == "report":
        m = _CurrentMarts(Warehouse(spark, args.warehouse))
        reps = reports.weekly_reports(m, args.as_of, ordered=False)
        paths = reports.write_reports(reps, args.as_of, args.out)
        out = {"window": reports.report_window(args.as_of), "files": paths,
               "rows": {r["report"]: r["row_count"] for r in reports.report_index(reps, args.as_of).collect()}}
    else:
        at = _sources(spark, args)["agent_transactions"]
        check = profile.schema_check(at, "agent_transactions", PROFILE_EXPECTED_COLUMNS).collect()[0].asDict()
        amounts = {k: str(v) for k, v in profile.amount_summary(at, "amount").collect()[0].asDict().items()}
        top = [(r["status"], r["cnt"]) for r in profile.top_values(at, "status").collect()]
        span = {k: str(v) for k, v in profile.time_ranges(at, ["trans_date", "payment_date"]).collect()[0].asDict().items()}
        out = {"schema": check, "amounts": amounts, "status_top10": top, "time_ranges": span,
               "nulls": {r["column_name"]: r["null_rows"] for r in
                         quality.null_counts(at, ["amount", "payment_date"]).collect()}}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
