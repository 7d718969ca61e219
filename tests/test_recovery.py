"""Loads and marts after failures: nothing is lost, dropped or read through a stale base."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from levyline import schemas
from levyline.operators.merge import merge
from levyline.plans import ingest
from levyline.plans.pipeline import build_marts, run_daily, touched_days
from levyline.sources import fixtures
from levyline.sources.warehouse import Warehouse
from levyline.streaming.merge_stream import start_merge_stream
from tests.conftest import SF_SMALL
from tests.helpers import make, rows_by

AT = schemas.AGENT_TRANSACTIONS
START = "2024-01-01 00:00:00"


def _sources(spark):
    return fixtures.raw_tables(spark, SF_SMALL)


def _mart(wh, model, day):
    days = wh.mart_days(model).limit(1).collect()[0]
    schema = wh.spark.read.parquet(wh.mart_path(model, days["version"])).schema
    return wh.read_days(model, day, schema)


@pytest.mark.parametrize("first_build", [False, True])
def test_incremental_marts_after_a_failed_build(spark, scratch, first_build):
    """A load whose model stage dies is caught up by the next incremental run."""
    src = _sources(spark)
    early = dict(src, agent_transactions=src["agent_transactions"].filter("trans_date <= timestamp_ntz'2024-01-28 12:00:00'"))
    wh = Warehouse(spark, f"{scratch}/inc")
    if first_build:
        run_daily(spark, early, wh.root, dt.datetime(2024, 1, 28, 6), fallback=START)
    changed = dict(src, agent_transactions=src["agent_transactions"].withColumn("amount", F.col("amount") + 1))
    ingest.load_all(wh, changed, dt.datetime(2024, 1, 29, 6), fallback=START)  # and then the model stage dies
    inc = run_daily(spark, changed, wh.root, dt.datetime(2024, 1, 30, 6), incremental=True)
    assert (inc.touched_days is None) == (not first_build)
    full = Warehouse(spark, f"{scratch}/inc")
    got = {m: _mart(full, m, d).collect() for m, d in (("fct_transactions", "payment_day"), ("agg_revenue_daily", "payment_day"))}
    build_marts(full, "rebuild")
    for m, d in (("fct_transactions", "payment_day"), ("agg_revenue_daily", "payment_day")):
        want = _mart(full, m, d).collect()
        assert sorted(map(str, got[m])) == sorted(map(str, want)) and len(want) > 0
    assert touched_days(full, full.last_build()) == []


def test_marks_keep_microseconds(spark, scratch):
    src, wh = _sources(spark), Warehouse(spark, scratch)
    ingest.load_all(wh, src, dt.datetime(2024, 2, 1, 6), fallback=START)
    marks = {r["table_name"]: r["last_loaded_at"] for r in wh.control().collect()}
    newest = src["bus_ticketing_transaction"].agg(F.max("trans_date")).collect()[0][0]
    assert newest.microsecond and marks["bus_ticketing_transaction"] == newest


def _bus_rows(spark, n):
    return fixtures.bus_ticketing_transaction(spark, SF_SMALL).filter("trans_date is not null").orderBy("id").limit(n)


def test_rule_breaking_rows_stop_the_load(spark, scratch):
    spec, wh = schemas.BUS_TICKETING_TRANSACTION, Warehouse(spark, scratch)
    rows = _bus_rows(spark, 20)
    ingest.load_table(wh, spec, rows, "r1", dt.datetime(2024, 2, 1), wh.control(), fallback=START)
    before = wh.current_version(spec.name)
    for broken, message in (
        (rows.withColumn("id", F.when(F.col("id") % 4 == 0, F.col("id"))), r"NULL in id \(1[0-9]\)"),
        (rows.withColumn("amount", F.when(F.col("id") < 0, F.col("amount"))), r"amount \(20\)"),
    ):
        with pytest.raises(ingest.RejectedRows, match=message):
            ingest.load_table(wh, spec, broken, "r2", dt.datetime(2024, 2, 2), wh.control(), fallback=START)
    assert wh.current_version(spec.name) == before and wh.read_table(spec).count() == 20


def test_merge_fails_at_null_keys_with_and_without_duplicates(spark):
    tgt = make(spark, AT, [])
    for rows in ([{"status": "x"}], [{"idagent_transactions": 1}, {"idagent_transactions": 1}, {"status": "x"}]):
        with pytest.raises(Exception, match="NULL key"):
            merge(tgt, make(spark, AT, rows), AT).collect()


def test_duplicate_keys_of_a_new_row(spark):
    """As if loaded one after another: the first row is inserted, the last one updates its update columns."""
    rows = [
        {"idagent_transactions": 1, "status": "Processing", "agency": "A", "trans_date": "2024-01-01 10:00:00"},
        {"idagent_transactions": 1, "status": "Failed", "agency": "B", "trans_date": "2024-01-01 11:00:00"},
        {"idagent_transactions": 1, "status": "Completed", "agency": "C", "trans_date": "2024-01-01 12:00:00"},
    ]
    out = rows_by(merge(make(spark, AT, []), make(spark, AT, rows), AT), "idagent_transactions")[1]
    assert (out["status"], out["agency"], out["trans_date"].hour) == ("Completed", "A", 10)


def test_two_streams_do_not_share_epochs(spark, scratch):
    spec, wh = schemas.BUS_TICKETING_TRANSACTION, Warehouse(spark, f"{scratch}/wh")
    rows = _bus_rows(spark, 400).withColumn("trans_date", F.expr("timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, id % 60)"))
    rows = rows.unionByName(rows.limit(1).withColumns({"id": F.lit(10**6).cast("int"), "trans_date": F.lit(None).cast("timestamp_ntz")}))
    rows.filter("id % 2 = 0").write.parquet(f"{scratch}/a/f1")
    rows.filter("id % 2 = 1").write.parquet(f"{scratch}/b/f1")
    for name in "ab":
        start_merge_stream(spark, wh, spec, f"{scratch}/{name}/*", f"{scratch}/ckpt-{name}", fallback=START).awaitTermination(300)
    assert wh.read_table(spec).count() == 400  # both epochs 0; the row without a time is not loaded
    assert wh.control_history().select("run_id").distinct().count() == 2
