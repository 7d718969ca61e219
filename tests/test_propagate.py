"""Incremental marts after changes of every table; lookups of codes; pulls by range."""

import re

import pytest
from pyspark.sql import functions as F

from levyline import schemas
from levyline.catalog import changed_raw, store
from levyline.operators import lookup as L
from levyline.plans import marts
from levyline.plans.pipeline import MART_LAYOUT, build_marts
from levyline.plans.propagate import affected_days, changed_rows
from levyline.sources import fixtures, ranges
from levyline.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL
from tests.helpers import make, ts

BUS = schemas.BUS_TICKETING_TRANSACTION


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def raw(spark):
    return fixtures.raw_tables(spark, SF_SMALL)


def test_incremental_equals_full_after_changes_of_every_table(spark, scratch, raw):
    wh = Warehouse(spark, scratch, part_keys=4096)
    store(wh, changed_raw(raw), "v1")
    build_marts(wh, "b1")
    store(wh, raw, "v2")
    touched = affected_days(wh, wh.last_build())
    inc = {m: df.collect() for m, df in build_marts(wh, "b2", touched).items() if m in MART_LAYOUT}
    written = {m: {r["day"] for r in wh.mart_days(m).collect() if r["version"] == "b2"} for m in MART_LAYOUT}
    full = {m: df.collect() for m, df in build_marts(wh, "b3").items() if m in MART_LAYOUT}
    for m in MART_LAYOUT:
        assert sorted(map(str, inc[m])) == sorted(map(str, full[m])) and full[m], m
        assert written[m] <= set(touched[m])
    assert 0 < len(touched["fct_agent_enumeration"]) < len({r["create_day"] for r in full["fct_agent_enumeration"]})
    assert affected_days(wh, wh.last_build()) == {m: [] for m in MART_LAYOUT}


@pytest.mark.parametrize("table, column, value, marts_", [
    ("concession_permit", "p_amount", 5, {"fct_concession_permits", "agg_concession_by_plancode", "agg_combined_revenue_daily"}),
    ("merchant_user", "bank", "Other Bank", {"fct_agent_enumeration"}),
    ("rev_sub_newcode", "mda", "MDA-x", {"fct_transactions", "agg_revenue_daily", "fct_concession_permits", "agg_concession_by_plancode", "agg_combined_revenue_daily"}),
    ("bus_ticketing_transaction", "amount", 3, {"agg_combined_revenue_daily"}),
])
def test_a_change_reaches_its_marts_and_no_others(spark, scratch, raw, table, column, value, marts_):
    wh, spec = Warehouse(spark, scratch, part_keys=4096), schemas.SPECS[table]
    store(wh, raw, "v1")
    built = {t: "v1" for t in schemas.SPECS}
    row = raw[table].filter(f"{spec.key} = 3")
    later = row.withColumn(column, F.lit(value).cast(spec.type_of(column)))
    changed = raw[table].filter(f"{spec.key} <> 3").unionByName(later)
    store(wh, {table: changed}, "v2")
    assert changed_rows(wh, spec, "v1").select("key").collect() == [(3,)]
    touched = affected_days(wh, built)
    assert {m for m, d in touched.items() if d} == marts_
    assert affected_days(wh, {**built, table: "unknown"}) is None


def _listed(seq):
    return [seq.apply(i) for i in range(seq.length())]


def test_changed_rows_are_found_by_digest_and_only_followed_columns_are_dealt(spark, scratch):
    """Text that moves to the next column, NULL against an empty text, and a microsecond are changes; equal rows are none."""
    wh = Warehouse(spark, scratch, part_keys=10)
    held = [
        {"id": 1, "event": "ab", "event_name": "c"}, {"id": 2, "event": "", "event_name": "x"}, {"id": 3, "event": "x"}, {"id": 4, "trans_date": "2024-01-10 00:00:00.000001"},
        {"id": 5, "event": "same", "trans_date": "2024-01-10 00:00:00"}, {"id": 6, "trans_date": "2024-01-11 00:00:00"}, {"id": 15, "event": "other part"},
    ]
    now = [
        {"id": 1, "event": "a", "event_name": "bc"}, {"id": 2, "event_name": "x"}, {"id": 3, "event_name": "x"}, {"id": 4, "trans_date": "2024-01-10 00:00:00.000002"},
        held[4], {"id": 7, "trans_date": "2024-01-12 00:00:00"}, held[6],
    ]
    store(wh, {BUS.name: make(spark, BUS, held)}, "v1")
    store(wh, {BUS.name: make(spark, BUS, now)}, "v2")
    got = changed_rows(wh, BUS, "v1", ["trans_date"])
    assert sorted(r["key"] for r in got.collect()) == [1, 2, 3, 4, 6, 7]
    assert {r["key"]: (r["old"], r["new"]) for r in got.where("key > 5").collect()} == {6: ((ts("2024-01-11"),), None), 7: (None, (ts("2024-01-12"),))}
    assert changed_rows(wh, BUS, "v1").where("key = 1").first()["new"]["event_name"] == "bc"
    join = got._jdf.queryExecution().optimizedPlan()
    while join.nodeName() != "Join":
        join = join.children().head()
    sides = [{a.name() for a in _listed(join.children().apply(i).output())} for i in (0, 1)]
    assert sides == [{"key", "old_digest", "old"}, {"key", "new_digest", "new"}]


# --- lookups --------------------------------------------------------------------------------------------------
def test_lookups_agree_and_spread_a_hot_code(spark):
    fact = spark.range(2000).selectExpr("id AS transaction_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 30) END AS code")
    codes = spark.createDataFrame([("hot", 1), ("c1", 2), ("c1", 3), (None, 4)], "code_ string, x int")
    rows = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left", "inner"):
            for small in (None, True, False):
                df = L.lookup(fact, codes, "code", "code_", "transaction_id", how, small).select("t.transaction_id", "t.code", "r.x")
                plan = df._jdf.queryExecution().executedPlan().toString()
                dealt = re.findall(r"hashpartitioning\(([^)]*)", plan)
                if small:
                    assert "BroadcastHashJoin" in plan and not dealt  # no exchange of the fact
                elif small is False:
                    assert dealt and all(d.count("#") >= 2 or "pmod" in d for d in dealt)  # by code and salt
                rows[how, small] = sorted(map(str, df.collect()))
            assert rows[how, None] == rows[how, True] == rows[how, False]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_only_hot_codes_of_a_large_table_are_copied(spark, monkeypatch):
    """A large code table is neither broadcast on Spark's estimate of it nor copied whole; codes hot in the fact stay spread."""
    fact = spark.range(4000).selectExpr("id AS transaction_id", "CASE WHEN id % 4 = 0 THEN 'hot' WHEN id % 4 = 1 THEN NULL ELSE concat('c', id) END AS code")
    codes = spark.range(3000).selectExpr("CASE WHEN id % 1000 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('c', id % 2500) END AS code_", "id AS x")
    assert L.hot_codes(fact, "code") == ["hot"] and L.hot_codes(fact.limit(0), "code") == []
    for broadcast in (True, False):  # the hot codes' rows are small, or not
        if not broadcast:
            monkeypatch.setattr(L, "measured_bytes", lambda df: None)
        for how in ("left", "inner"):
            df = L.lookup(fact, codes, "code", "code_", "transaction_id", how, False).select("t.*", "r.*")
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == broadcast and "SortMergeJoin" in plan
            wanted = L.lookup(fact, codes, "code", "code_", "transaction_id", how, None).select("t.*", "r.*")
            got = df.select("transaction_id", "code", "code_", "x")
            assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    copies = L._dealt(fact, codes, "code", "code_", "transaction_id", "inner", F.col("code") == "hot", F.coalesce(F.col("code_") == "hot", F.lit(False)))
    salted = copies.where("code = 'hot'").groupBy("__slot").count().collect()
    assert len(salted) == L.SALTS and sum(r["count"] for r in salted) == 3 * 1000


def test_size_is_measured_not_declared(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 1000) AS s")
    assert L.measured_bytes(df) == 1000 * (16 + 8 + 1000)
    assert L.measured_bytes(df, limit=500_000) is None and L.measured_bytes(df.limit(0)) == 0
    assert L.measured_bytes(spark.range(10**6), limit=10**6) is None


def test_marts_are_the_same_whatever_the_lookup(spark, raw):
    from levyline.plans.models import RevenueModels

    m = RevenueModels(raw)
    assert m.small_codes and m.small_permits
    for small in (None, False):
        assert same(marts.fct_transactions(m.stg_agent_transactions, m.stg_rev_sub_newcode, small), m.fct_transactions)
        assert same(marts.fct_concession_permits(m.fct_transactions, m.stg_concession_permit, small), m.fct_concession_permits)


# --- pulls by range -------------------------------------------------------------------------------------------
def test_a_killed_pull_restarts_the_unfinished_ranges_only(spark, scratch, raw):
    wh = Warehouse(spark, scratch)
    source = raw[BUS.name]
    high = source.agg(F.max("id")).first()[0]
    broken = source.withColumn("event", F.when(F.col("id") == high, F.raise_error(F.lit("source gone"))).otherwise(F.col("event")))
    with pytest.raises(Exception, match="source gone"):
        ranges.pull(wh, BUS, broken, "r1", ranges=5, parallel=1)
    done = ranges.progress_rows(wh, BUS, "r1")
    assert len(done) == 4 and done[-1]["percent"] < 100
    heard = []
    got = ranges.pull(wh, BUS, source, "r1", parallel=1, heard=heard.append)
    assert [r["range_no"] for r in heard] == [4, 5] and heard[-1]["percent"] == 100.0  # the last range and rows without a key
    assert same(got, source)
    assert ranges.progress(wh, BUS, "r1").agg(F.sum("rows")).first()[0] == source.count()
    assert ranges.pull(wh, BUS, broken, "r1", heard=heard.append).count() == source.count() and len(heard) == 2


def test_ranges_are_even_and_reach_the_scan(spark, scratch, raw):
    source = raw[BUS.name].select("id", "amount")
    skewed = source.withColumn("id", F.when(F.col("id") % 10 > 0, F.col("id")).otherwise(F.col("id") * 100_000)).filter("id % 97 <> 5")
    plan = ranges.plan_ranges(skewed, "id", 8)
    counts = [skewed.filter(c).count() for _, _, c in ranges._conditions("id", plan["edges"])]
    assert sum(counts) == plan["rows"] == skewed.count() and max(counts) < 2 * plan["rows"] / 8
    source.withColumn("id", F.col("id").cast("int")).write.parquet(f"{scratch}/stored")
    stored = spark.read.parquet(f"{scratch}/stored")
    _, _, condition = ranges._conditions("id", ranges.plan_ranges(stored, "id", 4)["edges"])[1]
    text = stored.filter(condition)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id" in text and "LessThanOrEqual(id" in text
    assert ranges.plan_ranges(stored.limit(0), "id") == {"edges": [], "rows": 0}


def test_rows_without_a_key_and_an_empty_source(spark, scratch, raw):
    wh = Warehouse(spark, scratch)
    holes = raw[BUS.name].withColumn("id", F.when(F.col("id") % 5 > 0, F.col("id")))
    assert same(ranges.pull(wh, BUS, holes, "r1", ranges=3), holes)
    assert ranges.pull(wh, BUS, holes.limit(0), "r2").count() == 0
