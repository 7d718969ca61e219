"""The six raw tables derived from the driver's test tables (rules in FIXTURES.md §2).

Every rule is a column expression over one test table, so each derived table is a projection (plus one
filter, and one distinct for the revenue codes) of a Parquet scan: nothing is materialised and the
test tables' size carries straight through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyline import schemas
from levyline.functions import ts_lit
from levyline.schemas import TableSpec


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def filler(name: str, typ: str, position: int, key: str) -> str:
    """The value of a column that no rule derives, from its name or position and the key: no two columns of a table hold
    the same, so that a column read under another's name shows; NULL in one of 19 rows."""
    if typ == "string":
        value = f"concat('{name}-', CAST(`{key}` AS STRING))"
    elif typ == "timestamp_ntz":
        value = f"timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval({position}, CAST(`{key}` % 24 AS INT))"
    else:
        value = f"`{key}` % 1000 + {1000 * position}"
    return f"CASE WHEN `{key}` % 19 = {position % 19} THEN NULL ELSE {value} END"


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select the spec's columns in order and type; absent columns are filled (or their NOT NULL default)."""
    present = set(df.columns)
    out = []
    for position, (name, typ) in enumerate(spec.columns, 1):
        if name in present:
            out.append(f"CAST(`{name}` AS {typ}) AS `{name}`")
        elif name in spec.not_null:
            out.append(f"CAST({spec.not_null[name]} AS {typ}) AS `{name}`")
        else:
            out.append(f"CAST({filler(name, typ, position, spec.key)} AS {typ}) AS `{name}`")
    return df.selectExpr(*out)  # one call for the whole projection


def _s(c: Column) -> Column:
    return c.cast("string")


def _hours_after(base: str, days: Column, hours: Column) -> Column:
    return ts_lit(base) + F.make_dt_interval(days.cast("int"), hours.cast("int"))


def agent_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_test_table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    even = (k % 2) == 0
    pr = F.col("o_orderpriority")
    st = F.col("o_orderstatus")
    derived = o.select(
        k.alias("idagent_transactions"),
        F.concat(F.lit("AGENCY-"), _s(k % 4)).alias("agency"),
        F.when((k % 13) == 0, F.lit(None)).otherwise(F.concat(F.lit("agent"), _s(k % 40))).alias("agent_user"),
        F.when((k % 61) == 0, F.lit(None)).otherwise(_hours_after("2024-01-25", k % 7, k % 24)).alias("trans_date"),
        F.when((k % 29) == 0, F.lit(None))
        .otherwise(_hours_after("2024-01-25", k % 7 + k % 3, k % 24))
        .alias("payment_date"),
        F.concat(F.lit("Brand#"), _s(c % 30)).alias("rev_code"),
        F.when((k % 53) == 0, F.lit(None))
        .when((k % 41) == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .cast("decimal(19,2)")
        .alias("amount"),
        F.when((k % 3) == 0, F.lit("")).when((k % 3) == 1, F.lit("2024")).alias("payment_period"),
        F.when((c % 4) == 0, F.lit("POS"))
        .when((c % 4) == 1, F.lit("Web"))
        .when((c % 4) == 2, F.lit("Mobile"))
        .alias("trans_channel"),
        F.when(st == "F", F.lit("Completed"))
        .when(st == "P", F.when(even, F.lit("Completed")).otherwise(F.lit("Processing")))
        .when(st == "O", F.when((k % 3) == 0, "Reversed").when((k % 3) == 1, "Failed").otherwise("Cancelled"))
        .alias("status"),
        F.concat(F.lit("LGA-"), _s(c % 5)).alias("lga"),
        F.concat(F.lit("Customer-"), _s(c)).alias("taxpayer_name"),
        F.concat(F.lit("P-"), _s(c % 20)).alias("revenue_item"),
        F.when(pr == "1-URGENT", F.when(even, F.lit("card")).otherwise(F.lit("Card")))
        .when(pr == "2-HIGH", F.when((k % 3) == 0, "Bank").when((k % 3) == 1, "bank").otherwise("Bank Transfer"))
        .when(pr == "3-MEDIUM", F.when(even, F.lit("USSD")).otherwise(F.lit("ussd")))
        .when(pr == "5-LOW", F.when((k % 3) == 0, "Cash").when((k % 3) == 1, "cash").otherwise("Wallet"))
        .alias("payment_method"),
    )
    return conform(derived, schemas.AGENT_TRANSACTIONS)


def rev_sub_newcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = read_test_table(spark, sf_dir, "part").select("p_brand").distinct()
    n = F.regexp_extract(F.col("p_brand"), r"#(\d+)$", 1).cast("int")
    derived = brands.select(
        n.alias("id"),
        F.concat(F.lit("MDA-"), _s(n % 5)).alias("mda"),
        F.col("p_brand").alias("rev_code"),
        F.when((n % 6) == 0, F.lit(None)).otherwise(F.concat(F.lit("Item for "), F.col("p_brand"))).alias(
            "revenue_item"
        ),
    )
    return conform(derived, schemas.REV_SUB_NEWCODE)


def concession_permit(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_test_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    code_no = F.when(k.between(20, 23), k - 20).otherwise(k)
    plan = k % 5
    derived = p.select(
        k.alias("id"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("P-"), _s(code_no)).alias("product_code"),
        F.col("p_name").alias("product_name"),
        (F.col("p_retailprice") * 200).cast("decimal(10,2)").alias("amount"),
        (F.col("p_retailprice") * 150).cast("decimal(10,2)").alias("p_amount"),
        F.when(plan.isin(0, 2), F.lit("Vehicle")).when(plan.isin(1, 3), F.lit("Trader")).otherwise(F.lit("Other")).alias(
            "plan_code"
        ),
        F.when((k % 7) == 6, F.lit("Inactive")).otherwise(F.lit("Active")).alias("status"),
    )
    return conform(derived, schemas.CONCESSION_PERMIT)


def bus_ticketing_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_test_table(spark, sf_dir, "events")
    k, u = F.col("event_id"), F.col("user_id")
    derived = e.select(
        k.alias("id"),
        F.col("event_type").alias("event"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.when((k % 97) == 0, F.lit(None)).otherwise(F.col("ts")).alias("trans_date"),
        F.concat(F.lit("080"), _s(u)).alias("phone"),
        F.concat(F.lit("BUS-"), _s(u % 20)).alias("bus_id"),
        F.concat(F.lit("ISS-"), _s(k % 7)).alias("issuer_id"),
    )
    return conform(derived, schemas.BUS_TICKETING_TRANSACTION)


# Event type -> enumeration revenue item (other event types have none).
ENUMERATION_ITEMS = {
    "signup": "MarketEnumeration",
    "click": "TransportEnumeration",
    "error": "OtherEnumeration",
}


def enumeration(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_test_table(spark, sf_dir, "events")
    k = F.col("event_id")
    item = None
    for ev, it in ENUMERATION_ITEMS.items():
        cond = F.col("event_type") == ev
        item = F.when(cond, F.lit(it)) if item is None else item.when(cond, F.lit(it))
    derived = e.select(
        k.alias("id"),
        F.col("ts").alias("create_time"),
        F.concat(F.lit("user"), _s(F.col("user_id")), F.lit("@example.org")).alias("created_by"),
        item.alias("revenue_item"),
        F.when((k % 4) == 0, F.lit("Corporate")).otherwise(F.lit("Individual")).alias("category"),
    )
    return conform(derived, schemas.ENUMERATION)


def merchant_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    # All customers (FIXTURES.md keeps only keys below 110; extended here so the agent table grows with the
    # data). The email rule equals FIXTURES.md for keys below 110 and repeats per block of 100 keys: keys
    # x00..x09 take user(k-100), which duplicates some emails and leaves others unused; every 50th is NULL.
    cu = read_test_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    derived = cu.select(
        k.alias("user_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("user_cat"),
        F.concat(F.lit("LGA-"), _s(k % 5)).alias("lga"),
        F.when((k % 50) == 49, F.lit(None))
        .otherwise(
            F.concat(
                F.lit("user"), _s(F.when((k >= 100) & ((k % 100) < 10), k - 100).otherwise(k + 5)), F.lit("@example.org")
            )
        )
        .alias("email"),
        F.when(F.col("c_acctbal") > 0, F.lit("Verified")).otherwise(F.lit("Pending")).alias("status"),
        _hours_after("2024-01-01", k % 28, F.lit(0)).alias("create_time"),
        F.when((k % 3) == 0, _hours_after("2024-01-15", k % 14, F.lit(0))).alias("update_time"),
    )
    return conform(derived, schemas.MERCHANT_USER)


BUILDERS = {
    "agent_transactions": agent_transactions,
    "rev_sub_newcode": rev_sub_newcode,
    "bus_ticketing_transaction": bus_ticketing_transaction,
    "concession_permit": concession_permit,
    "enumeration": enumeration,
    "merchant_user": merchant_user,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six raw tables, lazily."""
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}
