"""Hand-made rows for the semantic traps of the models and the join fan-outs."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from levyline import schemas
from levyline.functions import month_start, year_month
from levyline.plans import marts, reports, staging
from levyline.plans.models import RevenueModels
from levyline.sources import fixtures
from tests.conftest import SF_SMALL
from tests.helpers import make, rows_by


def _tx(spark, rows):
    return make(spark, schemas.AGENT_TRANSACTIONS, rows)


def _codes(spark, rows):
    return make(spark, schemas.REV_SUB_NEWCODE, rows)


def test_month_start_is_zone_free(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 1, 0, 30),)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Sao_Paulo", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            row = df.select(month_start("t").alias("m")).collect()[0]
            assert row["m"] == dt.datetime(2024, 3, 1)
        assert dict(df.select(month_start("t").alias("m")).dtypes)["m"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_year_month_uses_calendar_year(spark):
    # 2024-12-30 belongs to ISO week-year 2025; the month text must say 2024.
    df = spark.createDataFrame([(dt.datetime(2024, 12, 30, 10),)], "t timestamp_ntz")
    assert df.select(year_month("t").alias("m")).collect()[0]["m"] == "2024-12"


def test_flags_and_payment_method(spark):
    tx = _tx(spark, [
        {"idagent_transactions": 1, "status": None, "amount": 5, "payment_date": "2024-01-02 10:00:00", "payment_method": "CASH"},
        {"idagent_transactions": 2, "status": "Completed", "amount": -1, "payment_date": "2024-01-02 10:00:00", "payment_method": None},
        {"idagent_transactions": 3, "status": "Reversed", "amount": 1, "payment_date": "2024-01-02 10:00:00", "payment_method": "bank"},
        {"idagent_transactions": 4, "status": "Completed", "amount": None, "payment_date": "2024-01-02 10:00:00"},
        {"idagent_transactions": 5, "status": "Completed", "amount": 1, "payment_date": None},
    ])
    fct = rows_by(marts.fct_transactions(staging.stg_agent_transactions(tx), staging.stg_rev_sub_newcode(_codes(spark, []))), "transaction_id")
    assert set(fct) == {1, 2, 3}  # NULL amount and NULL payment date dropped
    assert fct[1]["is_completed"] is False and fct[1]["is_reversed"] is False  # NULL status -> false, not NULL
    assert fct[1]["payment_method_clean"] == "CASH"  # exact spellings only
    assert fct[2]["payment_method_clean"] == "Unknown" and fct[2]["is_negative_amount"] is True
    assert fct[3]["payment_method_clean"] == "Bank Transfer" and fct[3]["is_reversed"] is True
    assert fct[1]["mda"] == "Unknown" and fct[1]["revenue_item_name"] is None


def test_reversed_count_is_zero_after_completed_filter(spark):
    m = RevenueModels(fixtures.raw_tables(spark, SF_SMALL))
    assert m.agg_revenue_daily.agg(F.sum("reversed_count")).collect()[0][0] == 0
    assert m.agg_concession_by_plancode.agg(F.sum("reversed_count")).collect()[0][0] == 0


def test_daily_total_equals_completed_fact_total(spark):
    m = RevenueModels(fixtures.raw_tables(spark, SF_SMALL))
    a = m.agg_revenue_daily.agg(F.sum("total_amount")).collect()[0][0]
    b = m.fct_transactions.filter("is_completed").agg(F.sum("amount")).collect()[0][0]
    assert a == b


def test_combined_rows_are_bus_days_plus_concession_rows(spark):
    m = RevenueModels(fixtures.raw_tables(spark, SF_SMALL))
    combined = m.agg_combined_revenue_daily
    bus_days = m.stg_bus_ticketing_transaction.select("transaction_day").distinct().count()
    assert combined.count() == bus_days + m.agg_concession_by_plancode.count()
    assert combined.filter("revenue_source = 'Bus Ticket'").count() == bus_days
    assert {r[0] for r in combined.select("revenue_source").distinct().collect()} == {
        "Bus Ticket", "Market Ticket", "Vehicle Ticket"}


def test_duplicate_product_codes_fan_out_but_count_once(spark):
    tx = _tx(spark, [{"idagent_transactions": 1, "status": "Completed", "amount": 100,
                      "payment_date": "2024-01-02 10:00:00", "revenue_item": "P-1"}])
    permits = make(spark, schemas.CONCESSION_PERMIT, [
        {"id": 1, "product_code": "P-1", "plan_code": "Trader", "status": "Active", "amount": 60, "category": "c"},
        {"id": 2, "product_code": "P-1", "plan_code": "Trader", "status": "Active", "amount": 80, "category": "c"},
    ])
    fct = marts.fct_transactions(staging.stg_agent_transactions(tx), staging.stg_rev_sub_newcode(_codes(spark, [])))
    fcp = marts.fct_concession_permits(fct, staging.stg_concession_permit(permits))
    assert fcp.count() == 2
    agg = marts.agg_concession_by_plancode(fcp).collect()
    assert len(agg) == 1
    r = agg[0]
    assert r["transaction_count"] == 1 and r["total_paid_amount"] == Decimal("200.00")
    assert r["expected_amount"] == Decimal("80.00") and r["total_shortfall"] == Decimal("-120.00")
    assert r["fully_paid_count"] == 2


def test_duplicate_emails_split_counts_by_agent(spark):
    enum = make(spark, schemas.ENUMERATION, [
        {"id": i, "created_by": "a@x", "revenue_item": "MarketEnumeration", "category": "Individual",
         "create_time": "2024-01-05 08:00:00"} for i in range(3)
    ] + [{"id": 9, "created_by": "nobody@x", "revenue_item": "OtherEnumeration", "create_time": "2024-01-05 09:00:00"}])
    agents = make(spark, schemas.MERCHANT_USER, [
        {"user_id": 1, "email": "a@x", "status": "Verified"}, {"user_id": 2, "email": "a@x", "status": "Pending"}])
    out = marts.fct_agent_enumeration(staging.stg_enumeration(enum), staging.stg_merchant_user(agents))
    got = {(r["user_id"], r["revenue_type"]): r["enumeration_count"] for r in out.collect()}
    assert got == {(1, "Market"): 3, (2, "Market"): 3, (None, None): 1}
    row = out.filter("user_id = 1").collect()[0]
    assert row["create_month"] == "2024-01" and row["create_year"] == 2024


def test_report_window_and_descending_nulls_first(spark):
    assert reports.report_window("2024-02-03") == ("2024-01-27", "2024-02-02")
    daily = spark.createDataFrame(
        [(dt.date(2024, 1, 27), "A", 1, Decimal("5.00")), (dt.date(2024, 2, 2), "B", 2, None),
         (dt.date(2024, 2, 3), "C", 9, Decimal("99.00"))],
        "payment_day date, mda string, transaction_count bigint, total_amount decimal(29,2)")
    out = reports.report_mda(daily, "2024-01-27", "2024-02-02").collect()
    assert [r["mda"] for r in out] == ["B", "A"]  # NULL total first, the day after the window excluded


def test_empty_reports_gate(spark, scratch):
    empty = spark.createDataFrame([], "x string")
    reps = {"mda": empty, "eticket": empty, "bus": empty,
            "agents": spark.createDataFrame([("a",)], "x string")}
    assert reports.write_reports(reps, "2024-02-03", scratch) == {}
    idx = reports.report_index(reps, "2024-02-03").collect()
    assert all(r["produced"] is False for r in idx)


def test_csv_header_written_for_empty_report(spark, scratch):
    reps = {"mda": spark.createDataFrame([("m", 1, Decimal("1.50"))], "mda string, transaction_count bigint, total_amount decimal(29,2)"),
            "eticket": spark.createDataFrame([], "`Ticket type` string, `Ticket sold` bigint, Revenue decimal(29,2)"),
            "bus": spark.createDataFrame([('say "hi"', 1, None)], "bus_id string, trips bigint, revenue decimal(29,2)"),
            "agents": spark.createDataFrame([], "agent_email string")}
    paths = reports.write_reports(reps, "2024-02-03", scratch)
    assert paths["eticket"].endswith("eticket_type_breakdown_2024-01-27_to_2024-02-02.csv")
    et = [r.value for r in spark.read.text(paths["eticket"]).collect()]
    assert et == ["Ticket type,Ticket sold,Revenue"]
    bus = [r.value for r in spark.read.text(paths["bus"]).collect()]
    assert bus == ["bus_id,trips,revenue", '"say ""hi""",1,']
    mda = [r.value for r in spark.read.text(paths["mda"]).collect()]
    assert mda == ["mda,transaction_count,total_amount", "m,1,1.50"]
