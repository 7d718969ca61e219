"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each over the whole test tables.

Every query derives the six raw tables from the test tables (``sources.fixtures``) and runs the library on
them. Results are ``present``-ed: decimal columns are computed exactly and shown as double, the same
presentation the DuckDB oracle applies, so that clients that turn decimals into floats compare equal.
"""

from __future__ import annotations

import datetime as dt
import uuid
import weakref
from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyline.functions import ts_lit
from levyline.operators import profile, quality, status
from levyline.operators import watermark as wm
from levyline.operators.merge import merge
from levyline.operators.schema_ops import migrate_integral_to_string
from levyline.plans import reports
from levyline.plans.ingest import RejectedRows, load_all, load_table
from levyline.plans.models import RevenueModels
from levyline.plans.pipeline import build_marts, recorded
from levyline.plans.propagate import affected_days
from levyline.plans.staging import STAGING
from levyline.schemas import (
    AGENT_TRANSACTIONS,
    DATA_TESTS,
    LOAD_ORDER,
    MERCHANT_USER,
    PROFILE_EXPECTED_COLUMNS,
    PROFILE_SAMPLE_COLUMNS,
    SPECS,
)
from levyline.session import shared_dir
from levyline.sources import fixtures, ranges
from levyline.sources.files import Files
from levyline.sources.snapshots import ALL
from levyline.sources.warehouse import Warehouse
from levyline.streaming.merge_stream import start_merge_stream

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Decimal columns as double; everything else unchanged."""
    if not any(isinstance(f.dataType, T.DecimalType) for f in df.schema.fields):
        return df
    return df.selectExpr(
        *[
            f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`" if isinstance(f.dataType, T.DecimalType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


_PLANS: "weakref.WeakKeyDictionary[SparkSession, dict[str, RevenueModels]]" = weakref.WeakKeyDictionary()


def models(spark: SparkSession, sf_dir: str) -> RevenueModels:
    """The model graph over one test folder, built once per session (plans only: every action re-reads
    the files). Building a plan costs driver round-trips per expression; data work is unaffected."""
    try:
        per_session = _PLANS.setdefault(spark, {})
    except TypeError:  # a session type that cannot be weakly referenced: build each time
        per_session = {}
    if sf_dir not in per_session:
        per_session[sf_dir] = RevenueModels(fixtures.raw_tables(spark, sf_dir))
    return per_session[sf_dir]


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return models(spark, sf_dir).raw[name]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES: dict[str, Query] = {}


def _register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# --- staging views and marts --------------------------------------------------------------------------------
def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(models(spark, sf_dir).model(name))

    run.__name__ = name
    return run


for _name in RevenueModels.STAGING + (
    "fct_transactions",
    "fct_concession_permits",
    "fct_agent_enumeration",
    "agg_revenue_daily",
    "agg_concession_by_plancode",
    "agg_bus_daily",
    "agg_combined_revenue_daily",
):
    QUERIES[_name] = _model_query(_name)


# --- scenario parameters of the load and report queries (dates inside the test data's range) ----------------
AS_OF = "2024-02-03"  # a Saturday: the report covers 2024-01-27 .. 2024-02-02
RUN_START = "2024-02-03 06:00:00"
STORED_MARKS = {  # control table before the run
    "agent_transactions": "2024-01-30 00:00:00",
    "bus_ticketing_transaction": "2024-01-30 00:00:00",
    "enumeration": "2024-01-30 00:00:00",
    "merchant_user": "2024-01-20 00:00:00",
}
FUTURE_MARK = "2024-03-01 00:00:00"  # a mark past all data: every incremental slice is empty
BULK_FROM = "2024-01-28 00:00:00"


# --- weekly reports ------------------------------------------------------------------------------------------
def _reports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return reports.weekly_reports(models(spark, sf_dir), AS_OF)


def _report_query(report: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(_reports(spark, sf_dir)[report])

    return run


QUERIES["report_mda"] = _report_query("mda")
QUERIES["report_eticket"] = _report_query("eticket")
QUERIES["report_bus"] = _report_query("bus")
QUERIES["report_agent_enumeration"] = _report_query("agents")


@_register("report_index")
def report_index(spark, sf_dir):
    return reports.report_index(_reports(spark, sf_dir), AS_OF)


@_register("report_csv_roundtrip")
def report_csv_roundtrip(spark, sf_dir):
    """Write the four CSV files to the shared folder and read them back (one job): header and line counts."""
    out = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    paths = reports.write_reports(reports.weekly_reports(models(spark, sf_dir), AS_OF, ordered=False), AS_OF, out)
    if not paths:
        return spark.createDataFrame([], "report string, header string, lines bigint, data_rows bigint")
    by_dir = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    names = F.create_map(*[x for name, p in paths.items() for x in (F.lit(p.rstrip("/").split("/")[-1]), F.lit(name))])
    text = spark.read.text(list(paths.values())).select(
        names[by_dir].alias("report"), "value", F.monotonically_increasing_id().alias("pos")
    )
    # each file is read in order by one task, so its first line has the smallest position
    return text.groupBy("report").agg(
        F.min_by("value", "pos").alias("header"),
        F.count(F.lit(1)).alias("lines"),
        (F.count(F.lit(1)) - 1).alias("data_rows"),
    )


@_register("report_csv_cells")
def report_csv_cells(spark, sf_dir):
    """Every line of the four published CSV files, as text: header and cells."""
    out = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    paths = reports.write_reports(reports.weekly_reports(models(spark, sf_dir), AS_OF, ordered=False), AS_OF, out)
    if not paths:
        return spark.createDataFrame([], "file_name string, line string")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return spark.read.text(list(paths.values())).select(name.alias("file_name"), F.col("value").alias("line"))


# --- extract slices ------------------------------------------------------------------------------------------
@_register("extract_slice_transactions")
def extract_slice_transactions(spark, sf_dir):
    s = AGENT_TRANSACTIONS
    return present(wm.extract_slice(_raw(spark, sf_dir, s.name), s, wm.lookback(STORED_MARKS[s.name])))


@_register("extract_slice_merchants")
def extract_slice_merchants(spark, sf_dir):
    s = MERCHANT_USER
    return present(wm.extract_slice(_raw(spark, sf_dir, s.name), s, wm.lookback(STORED_MARKS[s.name])))


@_register("bulk_extract")
def bulk_extract(spark, sf_dir):
    """Back-fill: every transaction paid on or after the start, merged (upsert policy) into an empty table."""
    s = AGENT_TRANSACTIONS
    slice_ = _raw(spark, sf_dir, s.name).filter(F.col("payment_date") >= ts_lit(BULK_FROM))
    return present(merge(spark.createDataFrame([], s.schema), slice_, s))


@_register("extract_by_ranges")
def extract_by_ranges(spark, sf_dir):
    """A pull in ranges of the key, each stored and recorded on its own; the rows with the final progress."""
    spec = SPECS["bus_ticketing_transaction"]
    wh = _warehouse(spark, "ranges")
    rows = ranges.pull(wh, spec, _raw(spark, sf_dir, spec.name), "run-1", ranges=6)
    last = ranges.progress(wh, spec, "run-1").agg(F.sum("rows").alias("rows_read"), F.max("percent").alias("percent"))
    return present(rows.crossJoin(F.broadcast(last)))  # one row


# --- merges --------------------------------------------------------------------------------------------------
# Stale values an earlier load left in the target (FIXTURES.md §3); the oracle uses the same.
STALE_VALUES = {
    "agent_transactions": {"status": "Processing", "amount": 0, "comment": "loaded earlier"},
    "bus_ticketing_transaction": {"amount": 0, "route_name": "old route"},
    "enumeration": {"category": "Changed"},
    "merchant_user": {"status": "Old", "bank": "Old Bank"},
}
STALE_COLUMN = {"rev_sub_newcode": "mda", "concession_permit": "category"}


def prior_target(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The target as an earlier load left it: rows up to the stored mark, with stale values."""
    spec = SPECS[name]
    before = _raw(spark, sf_dir, name).filter(F.col(spec.hwm[0]) <= ts_lit(STORED_MARKS[name]))
    return before.withColumns({c: F.lit(v).cast(spec.type_of(c)) for c, v in STALE_VALUES[name].items()})


def _merge_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = SPECS[name]
        slice_ = wm.extract_slice(_raw(spark, sf_dir, name), spec, wm.lookback(STORED_MARKS[name]))
        return present(merge(prior_target(spark, sf_dir, name), slice_, spec))

    return run


def _warehouse(spark: SparkSession, name: str, part_keys: int = 1 << 12) -> Warehouse:
    """A warehouse of this query's own in the shared folder; small parts, so that tables of every size have several."""
    return Warehouse(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", part_keys)


def _full_refresh_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The reload replaces a stored copy: stale values and rows that the source has no more are gone."""
        src, spec = _raw(spark, sf_dir, name), SPECS[name]
        stale = src.withColumn(STALE_COLUMN[name], F.lit("stale"))
        gone = stale.withColumn(spec.key, (F.col(spec.key) + 1_000_000).cast(spec.type_of(spec.key)))
        wh = _warehouse(spark, "full-refresh")
        load_table(wh, spec, stale.unionByName(gone), "run-1", dt.datetime(2024, 2, 2, 6), wh.control())
        load_table(wh, spec, src, "run-2", dt.datetime(2024, 2, 3, 6), wh.control())
        return present(wh.read_table(spec))

    return run


QUERIES["merge_agent_transactions"] = _merge_query("agent_transactions")
QUERIES["merge_bus_ticketing"] = _merge_query("bus_ticketing_transaction")
QUERIES["merge_enumeration_insert_only"] = _merge_query("enumeration")
QUERIES["merge_merchant_user_scd1"] = _merge_query("merchant_user")
QUERIES["full_refresh_rev_codes"] = _full_refresh_query("rev_sub_newcode")
QUERIES["full_refresh_permits"] = _full_refresh_query("concession_permit")


@_register("merge_duplicate_keys")
def merge_duplicate_keys(spark, sf_dir):
    """A slice in which every fifth key has a later row: it is inserted as the earlier row, updated by the later."""
    spec = SPECS["agent_transactions"]
    rows = _raw(spark, sf_dir, spec.name).filter(F.col("trans_date").isNotNull())
    later = rows.filter(F.col(spec.key) % 5 == 0).withColumns({
        "trans_date": F.col("trans_date") + F.expr("INTERVAL 1 HOUR"),
        "status": F.lit("Reversed"),
        "agency": F.lit("later"),
    })
    empty = spark.createDataFrame([], spec.schema)
    return present(merge(empty, rows.unionByName(later), spec).select(spec.key, "agency", "status", "amount", "trans_date"))


@_register("load_two_runs")
def load_two_runs(spark, sf_dir):
    """The loader on stored tables: a first load of old amounts, a second of the whole source, read back with
    the control row (marks keep microseconds; rows before the lookback keep their old amounts)."""
    spec = SPECS["bus_ticketing_transaction"]
    source = _raw(spark, sf_dir, spec.name)
    wh = _warehouse(spark, "load-two-runs")
    old = source.filter(F.col("trans_date") <= ts_lit("2024-01-20 12:00:00")).withColumn("amount", F.lit(0).cast(spec.type_of("amount")))
    load_table(wh, spec, old, "run-1", dt.datetime(2024, 1, 21, 6), wh.control(), fallback="2024-01-01 00:00:00")
    load_table(wh, spec, source, "run-2", dt.datetime(2024, 2, 1, 6), wh.control())
    control = wh.control().select("last_loaded_at", "rows_loaded", F.lit(spec.name).alias("table_name"))
    rows = wh.read_table(spec).select("id", "trans_date", "amount", F.lit(spec.name).alias("table_name"))
    return present(rows.join(F.broadcast(control), "table_name"))


@_register("stream_merge_on_read")
def stream_merge_on_read(spark, sf_dir):
    """Two runs of the merge stream: the rows read over base and delta segments, and again after compaction."""
    spec = SPECS["bus_ticketing_transaction"]
    wh = _warehouse(spark, "stream-merge")
    source = _raw(spark, sf_dir, spec.name)
    batches = prior_target(spark, sf_dir, spec.name), wm.extract_slice(source, spec, wm.lookback(STORED_MARKS[spec.name]))
    for i, batch in enumerate(batches):
        batch.write.parquet(f"{wh.root}/landing/batch-{i}")
        stream = start_merge_stream(spark, wh, spec, f"{wh.root}/landing/*", f"{wh.root}/checkpoint", fallback="2024-01-01 00:00:00", compact_ratio=None)
        stream.awaitTermination()
    read = wh.read_table(spec).withColumn("state", F.lit("merged on read"))
    wh.compact(spec, "all", ratio=0.0)
    return present(read.unionByName(wh.read_table(spec).withColumn("state", F.lit("compacted"))))


@_register("load_mixed_layouts")
def load_mixed_layouts(spark, sf_dir):
    """Parts stored in an older layout (an integer rev_head under its former name, no enter_by) and in the present one, read as one table."""
    spec = replace(SPECS["rev_sub_newcode"], former_names={"rev_head": "rev_head_no"})
    wh = _warehouse(spark, "mixed-layouts", part_keys=10)
    codes = _raw(spark, sf_dir, spec.name)
    old = codes.withColumn("rev_head_no", (F.col("id") * 10).cast("int")).drop("rev_head", "enter_by")
    run, log = dt.datetime(2024, 2, 1, 6), wh.log(spec.name)
    wh.commit(spec, log.at(), "run-1", run, run, 0, wh.write_parts(old, spec, "run-1", log.at()), ALL, "run-1")
    later = codes.filter("id >= 20").withColumns({"rev_head": F.concat(F.lit("H"), F.col("id").cast("string")), "enter_by": F.lit("later")})
    wh.commit(spec, log.at(), "run-2", run, run, 0, wh.write_parts(later, spec, "run-2", log.at()), wh.parts_of(spec, log.at(), later), "run-2")
    return wh.read_table(spec)


# --- watermarks ----------------------------------------------------------------------------------------------
def load_accounting(spark: SparkSession, sf_dir: str, marks: dict[str, str]) -> DataFrame:
    """Control rows after one run of all six loaders, given the stored marks (others fall back)."""
    control = wm.control_rows(spark, {t: (m, RUN_START, 0) for t, m in marks.items()})
    stored = wm.read_watermarks(control, [s.name for s in LOAD_ORDER if s.refresh != "full"])
    rows = []
    for spec in LOAD_ORDER:
        src = _raw(spark, sf_dir, spec.name)
        if spec.refresh == "full":
            rows.append(wm.after_full_refresh(src, spec, RUN_START))
        else:
            w = stored[spec.name]
            rows.append(wm.after_incremental(wm.extract_slice(src, spec, wm.lookback(w)), spec, w, RUN_START))
    return _union(rows)


@_register("watermark_after_load")
def watermark_after_load(spark, sf_dir):
    return load_accounting(spark, sf_dir, STORED_MARKS)


@_register("watermark_after_empty_load")
def watermark_after_empty_load(spark, sf_dir):
    return load_accounting(spark, sf_dir, {t: FUTURE_MARK for t in STORED_MARKS})


# --- data tests and source profile ---------------------------------------------------------------------------
# Columns whose duplicates fan out joins (not declared tests; reported with the declared unique tests).
FAN_OUT_CHECKS = (("merchant_user", "email"), ("concession_permit", "product_code"))


@_register("dq_unique")
def dq_unique(spark, sf_dir):
    checks = [(t, c) for t, c, k in DATA_TESTS if k == "unique"] + list(FAN_OUT_CHECKS)
    return quality.unique_report(models(spark, sf_dir).raw, checks)


@_register("dq_not_null")
def dq_not_null(spark, sf_dir):
    return quality.not_null_report(models(spark, sf_dir).raw, [(t, c) for t, c, k in DATA_TESTS if k == "not_null"])


@_register("dq_suite")
def dq_suite(spark, sf_dir):
    return quality.run_suite(models(spark, sf_dir).raw, DATA_TESTS)


@_register("dq_unique_new_keys")
def dq_unique_new_keys(spark, sf_dir):
    """Uniqueness over two loads: keys of a new slice (every fifth row twice) that repeat in it or are stored already."""
    spec = SPECS["bus_ticketing_transaction"]
    source = _raw(spark, sf_dir, spec.name)
    wh = _warehouse(spark, "dq-new-keys")
    load_table(wh, spec, source.filter(F.col("trans_date") <= ts_lit("2024-01-20 12:00:00")), "run-1", dt.datetime(2024, 1, 21, 6), wh.control(), fallback="2024-01-01 00:00:00")
    late = source.filter(F.col("trans_date") > ts_lit("2024-01-20 00:00:00"))
    return quality.unique_new_keys(wh, spec, late.unionByName(late.filter("id % 5 = 0")))


def _at(spark, sf_dir):
    return _raw(spark, sf_dir, "agent_transactions")


@_register("profile_counts")
def profile_counts(spark, sf_dir):
    df = _at(spark, sf_dir)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("agent_transactions").alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )


@_register("profile_date_range")
def profile_date_range(spark, sf_dir):
    return profile.time_ranges(_at(spark, sf_dir), ["trans_date", "payment_date"])


@_register("profile_status_top10")
def profile_status_top10(spark, sf_dir):
    return profile.top_values(_at(spark, sf_dir), "status", 10)


@_register("profile_amounts")
def profile_amounts(spark, sf_dir):
    return present(profile.amount_summary(_at(spark, sf_dir), "amount"))


@_register("profile_latest5")
def profile_latest5(spark, sf_dir):
    return present(
        profile.latest_rows(_at(spark, sf_dir), "trans_date", "idagent_transactions", PROFILE_SAMPLE_COLUMNS, 5)
    )


@_register("schema_check")
def schema_check(spark, sf_dir):
    exists = profile.path_exists(spark, f"{sf_dir.rstrip('/')}/orders.parquet")
    return profile.schema_check(_at(spark, sf_dir), "agent_transactions", PROFILE_EXPECTED_COLUMNS, exists)


@_register("profile_stored")
def profile_stored(spark, sf_dir):
    """Row count and key range of a stored table, from its files' footers."""
    spec = SPECS["agent_transactions"]
    wh = _warehouse(spark, "profile")
    store(wh, {spec.name: _raw(spark, sf_dir, spec.name)}, "v1")
    paths = [f"{wh.table_path(spec.name, s.version)}/part={s.part}" for s in wh.log(spec.name).at().segments]
    return profile.footer_profile(spark, paths, spec.name, spec.key)


@_register("schema_check_source")
def schema_check_source(spark, sf_dir):
    """The columns of the sources as they are: one that lacks what the profile expects, and one that does not exist."""
    orders = f"{sf_dir.rstrip('/')}/orders.parquet"
    source = spark.read.parquet(orders).withColumnsRenamed({"o_orderkey": "idagent_transactions", "o_totalprice": "amount", "o_orderstatus": "status"})
    here = profile.schema_check(source, "orders", PROFILE_EXPECTED_COLUMNS, profile.path_exists(spark, orders))
    gone = Files(spark).exists(f"{sf_dir.rstrip('/')}/no_such_table.parquet")
    return here.unionByName(profile.schema_check(spark.createDataFrame([], "none int"), "no_such_table", PROFILE_EXPECTED_COLUMNS, gone))


def old_rev_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue codes in the old layout, with rev_head still an integer (its value: the code number × 10)."""
    return _raw(spark, sf_dir, "rev_sub_newcode").withColumn("rev_head", (F.col("id") * 10).cast("int"))


@_register("schema_migrate_rev_head")
def schema_migrate_rev_head(spark, sf_dir):
    return migrate_integral_to_string(old_rev_codes(spark, sf_dir), "rev_head")


def changed_raw(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables as an earlier day held them: other values in some rows of every table, others not there yet."""
    some = lambda df, c, value, key, n: df.withColumn(c, F.when(F.col(key) % n == 0, value).otherwise(F.col(c)))
    late = "payment_date >= timestamp_ntz'2024-02-01 00:00:00' AND idagent_transactions % 3 = 0"
    return {
        "agent_transactions": some(raw["agent_transactions"].filter(f"({late}) IS NOT TRUE"), "status", F.lit("Processing"), "idagent_transactions", 2003),
        "rev_sub_newcode": some(raw["rev_sub_newcode"], "mda", F.lit("MDA-old"), "id", 24),
        "bus_ticketing_transaction": some(raw["bus_ticketing_transaction"], "amount", F.lit(1).cast("decimal(10,2)"), "id", 3001),
        "concession_permit": some(raw["concession_permit"], "plan_code", F.lit("Other"), "id", 397),
        "enumeration": raw["enumeration"].filter("id % 2500 <> 7"),
        "merchant_user": some(raw["merchant_user"], "email", F.lit("user7@example.org"), "user_id", 500),
    }


def store(wh: Warehouse, tables: dict[str, DataFrame], version: str) -> None:
    """Commit whole tables as a version."""
    at = dt.datetime(2024, 2, 3, 6)
    for name, df in tables.items():
        spec, state = SPECS[name], wh.log(name).at()
        segments = wh.write_parts(df, spec, version, state, lie=True)
        wh.commit(spec, state, version, at, at, sum(s.rows for s in segments), segments, ALL, version)


@_register("incremental_marts")
def incremental_marts(spark, sf_dir):
    """The combined mart after a build over earlier tables and an incremental one over the present ones."""
    raw = models(spark, sf_dir).raw
    wh = _warehouse(spark, "incremental-marts")
    store(wh, changed_raw(raw), "v1")
    build_marts(wh, "b1")
    store(wh, raw, "v2")
    return present(build_marts(wh, "b2", affected_days(wh, wh.last_build()))["agg_combined_revenue_daily"])


# --- run history ---------------------------------------------------------------------------------------------
@_register("run_history")
def run_history(spark, sf_dir):
    """What three runs of the loaders recorded: a first load, one with quiet buses, one that stops at rows without a key."""
    raw = models(spark, sf_dir).raw
    wh = _warehouse(spark, "run-history")
    early = dict(raw, agent_transactions=raw["agent_transactions"].filter(F.col("trans_date") <= ts_lit("2024-01-28 12:00:00")))
    quiet = dict(raw, bus_ticketing_transaction=raw["bus_ticketing_transaction"].limit(0))
    broken = dict(raw, enumeration=raw["enumeration"].withColumn("id", F.when(F.col("id") % 10 > 0, F.col("id"))))
    for day, sources in ((28, early), (29, quiet), (30, broken)):
        start = dt.datetime(2024, 1, day, 6)
        with suppress(RejectedRows), recorded(wh, f"run-{day}", start) as run:
            run.loads(load_all(wh, sources, start, run_id=f"run-{day}", fallback="2024-01-01 00:00:00", done=run.load))
    return status.history(wh)
