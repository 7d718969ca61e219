"""Merge policies, slice rules and watermark accounting on hand-made rows (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from levyline import schemas
from levyline.operators import merge as M
from levyline.operators import watermark as wm
from levyline.operators.merge import dedupe, merge
from tests.helpers import make, rows_by, ts

AT = schemas.AGENT_TRANSACTIONS


def _target(spark):
    return make(spark, AT, [
        {"idagent_transactions": 1, "status": "Processing", "amount": 0, "comment": "kept", "trans_date": "2024-01-28 10:00:00"},
        {"idagent_transactions": 2, "status": "Processing", "amount": 7, "comment": "old", "trans_date": "2024-01-10 10:00:00"},
    ])


def _slice(spark):
    return make(spark, AT, [
        {"idagent_transactions": 1, "status": "Completed", "amount": None, "comment": "new", "agency": "X",
         "trans_date": "2024-01-28 10:00:00", "payment_date": "2024-01-29 10:00:00"},
        {"idagent_transactions": 3, "status": "Completed", "amount": 9, "comment": "fresh", "trans_date": "2024-01-29 11:00:00"},
    ])


def test_partial_update_keeps_other_columns_and_null_overwrites(spark):
    out = rows_by(merge(_target(spark), _slice(spark), AT), "idagent_transactions")
    assert set(out) == {1, 2, 3}
    assert out[1]["status"] == "Completed" and out[1]["amount"] is None  # NULL overwrites
    assert out[1]["payment_date"] == ts("2024-01-29 10:00:00")
    assert out[1]["comment"] == "kept" and out[1]["agency"] is None  # not in the update list
    assert out[2]["amount"] == Decimal("7.00") and out[2]["comment"] == "old"  # untouched
    assert out[3]["comment"] == "fresh" and out[3]["amount"] == Decimal("9.00")  # new key: whole row


def test_broadcast_plan_equals_join_plan(spark):
    a = merge(_target(spark), _slice(spark), AT, small_slice=False)
    b = merge(_target(spark), _slice(spark), AT, small_slice=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_is_idempotent(spark):
    once = merge(_target(spark), _slice(spark), AT)
    twice = merge(once, _slice(spark), AT)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_insert_only_never_changes_existing(spark):
    spec = schemas.ENUMERATION
    tgt = make(spark, spec, [{"id": 1, "category": "Changed", "create_time": "2024-01-01 00:00:00"}])
    sl = make(spark, spec, [
        {"id": 1, "category": "Individual", "create_time": "2024-01-02 00:00:00"},
        {"id": 2, "category": "Corporate", "create_time": "2024-01-03 00:00:00"},
        {"id": 2, "category": "Later", "create_time": "2024-01-04 00:00:00"},
    ])
    out = rows_by(merge(tgt, sl, spec), "id")
    assert out[1]["category"] == "Changed"
    assert out[2]["category"] == "Corporate"  # duplicate new key: the earliest row is inserted


def test_scd1_replaces_all_columns(spark):
    spec = schemas.MERCHANT_USER
    tgt = make(spark, spec, [{"user_id": 1, "status": "Old", "bank": "Old Bank", "email": "a@x"}])
    sl = make(spark, spec, [{"user_id": 1, "status": "Verified", "bank": None, "email": "b@x",
                             "create_time": "2024-01-01 00:00:00", "update_time": "2024-01-20 00:00:00"}])
    out = rows_by(merge(tgt, sl, spec), "user_id")
    assert out[1]["status"] == "Verified" and out[1]["bank"] is None and out[1]["email"] == "b@x"


def test_dedupe_keeps_latest_deterministically(spark):
    df = spark.createDataFrame(
        [(1, ts("2024-01-01 00:00:00"), "a"), (1, ts("2024-01-02 00:00:00"), "b"), (1, ts("2024-01-02 00:00:00"), "c"),
         (2, None, "z")], "k int, t timestamp_ntz, v string")
    got = rows_by(dedupe(df, "k", ["t"], "latest"), "k")
    assert got[1]["v"] == "c" and got[2]["v"] == "z"
    got = rows_by(dedupe(df, "k", ["t"], "earliest"), "k")
    assert got[1]["v"] == "a"


def test_full_refresh_replaces_target(spark):
    spec = schemas.REV_SUB_NEWCODE
    tgt = make(spark, spec, [{"id": 1, "mda": "old"}, {"id": 2, "mda": "gone"}])
    src = make(spark, spec, [{"id": 1, "mda": "new"}])
    assert [r.asDict()["mda"] for r in merge(tgt, src, spec).collect()] == ["new"]


def test_slice_is_strict_and_skips_null_times(spark):
    src = make(spark, AT, [
        {"idagent_transactions": 1, "trans_date": "2024-01-27 00:00:00"},  # exactly the lookback: excluded
        {"idagent_transactions": 2, "trans_date": "2024-01-27 00:00:01"},
        {"idagent_transactions": 3, "trans_date": None},
    ])
    since = wm.lookback("2024-01-30 00:00:00")
    assert since == dt.datetime(2024, 1, 27)
    assert [r[0] for r in wm.extract_slice(src, AT, since).select("idagent_transactions").collect()] == [2]


def test_two_column_slice_and_newest_time(spark):
    spec = schemas.MERCHANT_USER
    src = make(spark, spec, [
        {"user_id": 1, "create_time": "2024-01-01 00:00:00", "update_time": "2024-01-25 00:00:00"},
        {"user_id": 2, "create_time": "2024-01-20 00:00:00", "update_time": None},
        {"user_id": 3, "create_time": "2024-01-01 00:00:00", "update_time": None},
    ])
    sl = wm.extract_slice(src, spec, wm.lookback("2024-01-20 00:00:00"))
    assert sorted(r[0] for r in sl.select("user_id").collect()) == [1, 2]
    row = wm.after_incremental(sl, spec, "2024-01-20 00:00:00", "2024-02-01 06:00:00").collect()[0]
    assert row["last_loaded_at"] == ts("2024-01-25 00:00:00") and row["rows_loaded"] == 2


def test_watermark_monotone_and_empty_slice(spark):
    src = make(spark, AT, [{"idagent_transactions": 1, "trans_date": "2024-01-28 00:00:00"}])
    # the slice's newest time is older than the stored mark: the mark does not move back
    row = wm.after_incremental(src, AT, "2024-01-30 00:00:00", "2024-02-01 06:00:00").collect()[0]
    assert row["last_loaded_at"] == ts("2024-01-30 00:00:00") and row["rows_loaded"] == 1
    empty = src.limit(0)
    row = wm.after_incremental(empty, AT, "2024-01-30 00:00:00", "2024-02-01 06:00:00").collect()[0]
    assert row["last_loaded_at"] == ts("2024-01-30 00:00:00") and row["rows_loaded"] == 0
    assert row["last_run_at"] == ts("2024-02-01 06:00:00")


def test_fallback_when_no_control_row(spark):
    control = wm.empty_control(spark)
    mark = wm.read_watermark(control, "agent_transactions", "2025-01-01 00:00:00")
    assert mark == dt.datetime(2025, 1, 1) and wm.lookback(mark) == dt.datetime(2024, 12, 29)
    control = wm.control_rows(spark, {"agent_transactions": ("2024-01-30 00:00:00", "2024-01-30 06:00:00", 5)})
    assert wm.read_watermark(control, "agent_transactions") == dt.datetime(2024, 1, 30)


def test_only_repeated_keys_are_grouped(spark):
    """Rows whose key does not repeat never enter the grouping, which sorts whole rows in the task that reads them."""
    rows = [(i, i % 7, f"r{i}") for i in range(2000)] + [(i, -1 - i, f"s{i}") for i in range(0, 2000, 400)] + [(None, 1, "n"), (None, 0, "m")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    grouped = []
    got = M._repeated_only(df, "k", lambda d: grouped.append(d) or d.groupBy("k").agg(F.min(F.struct("t", "v")).alias("m")).select("k", "m.t", "m.v"))
    assert grouped[0].count() == 2 * 5 + 2  # both rows of the five keys and of the NULL key
    assert got.count() == 2001 and dedupe(df, "k", ["t"], "earliest").exceptAll(got).isEmpty()
    assert {r["k"]: r["v"] for r in got.where("k IS NULL OR k % 400 = 0").collect()} == {None: "m", **{k: f"s{k}" for k in range(0, 2000, 400)}}
    folded = {r["k"]: (r["t"], r["v"]) for r in M.fold(df, "k", F.col("t"), ["v"]).collect()}
    assert len(folded) == 2001 and folded[400] == (-401, "r400") and folded[1] == (1, "r1") and folded[None] == (0, "n")
    enum = schemas.ENUMERATION
    rows = make(spark, enum, [{"id": i, "create_time": "2024-01-10 00:00:00"} for i in range(9)])
    plan = M.merge(rows, rows, enum, dedupe_slice=False)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan  # whatever Spark takes the table's keys for
