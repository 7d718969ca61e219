"""Marts: enriched facts and daily aggregates, as DataFrame functions of the staging views.

Join strategy: the caller says whether it has measured a reference table (revenue codes, permits) as small
(``operators.lookup``): small ones are broadcast, large ones copied to salted parts of the fact. Without a measurement, and for agents, the
side is left to AQE, which broadcasts it only once its materialised size is known to be under
``spark.sql.adaptive.autoBroadcastJoinThreshold``. A hint without a measurement would broadcast whatever the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyline.functions import case_map, clean_payment_method, exact_avg, flag, year, year_month
from levyline.operators.lookup import lookup

# fct_transactions output columns, in order (computed ones are built below).
FCT_TRANSACTION_COLUMNS = (
    "transaction_id", "transaction_ref", "payment_ref",
    "payment_date", "payment_day", "payment_month", "payment_year", "transaction_date",
    "agent_user", "agent_code", "agency", "transaction_channel", "terminal_id",
    "lga", "state_id", "tax_office",
    "mda", "revenue_item", "revenue_item_name", "revenue_head", "revenue_code",
    "taxpayer_name", "taxpayer_email", "taxpayer_phone", "taxpayer_type", "plate_number", "enumeration_id",
    "amount", "status", "transaction_type", "payment_method", "payment_period", "notice_number",
    "notice_number_fiscal_year",
    "vehicle_type", "vehicle_tonnage", "take_off_point", "drop_off_destination", "market", "zone_line",
    "shop_number",
    "valid_date", "updated_at",
    "is_completed", "is_reversed", "is_negative_amount", "payment_method_clean",
)

# fct_concession_permits output columns, in order.
FCT_PERMIT_COLUMNS = (
    "transaction_id", "transaction_ref", "payment_ref", "permit_id",
    "plan_code", "category", "product_code", "product_name", "product_tag", "merchant_id",
    "payment_date", "payment_day", "payment_month", "payment_year", "transaction_date",
    "agent_user", "agent_code", "agency", "transaction_channel", "terminal_id",
    "lga", "state_id", "tax_office",
    "mda", "revenue_item", "revenue_item_name", "revenue_head", "revenue_code",
    "taxpayer_name", "taxpayer_email", "taxpayer_phone", "taxpayer_type", "plate_number", "enumeration_id",
    "paid_amount", "expected_amount", "previous_expected_amount", "variance_amount",
    "status", "transaction_type", "payment_method", "payment_method_clean", "payment_period", "notice_number",
    "notice_number_fiscal_year",
    "vehicle_type", "vehicle_tonnage", "take_off_point", "drop_off_destination", "market", "zone_line",
    "shop_number",
    "is_completed", "is_reversed", "is_negative_amount", "is_fully_paid",
    "valid_date", "updated_at",
)

PERMIT_COLUMNS = (
    "permit_id", "plan_code", "category", "product_code", "product_name", "product_tag", "merchant_id",
    "expected_amount", "previous_expected_amount",
)

# CASE maps of the marts.
REVENUE_TYPES = {"MarketEnumeration": "Market", "TransportEnumeration": "Transport"}
REVENUE_SOURCES = {"Trader": "Market Ticket", "Vehicle": "Vehicle Ticket"}
BUS_SOURCE = "Bus Ticket"
UNKNOWN_MDA = "Unknown"

AGENT_COLUMNS = (
    "user_id", "agent_email", "first_name", "last_name", "phone_no", "lga", "user_cat", "bank", "bank_account",
    "agent_status", "agent_code",
)


def fct_transactions(stg_tx: DataFrame, stg_codes: DataFrame, small_codes: bool | None = None) -> DataFrame:
    """Transactions with an amount, enriched with MDA and item name from the revenue codes (left join)."""
    t = stg_tx.filter(F.col("amount").isNotNull())
    r = stg_codes.select("rev_code", "mda", "revenue_item_full")
    joined = lookup(t, r, "revenue_code", "rev_code", "transaction_id", "left", small_codes)
    computed = {
        "mda": F.coalesce(F.col("r.mda"), F.lit(UNKNOWN_MDA)),
        "revenue_item_name": F.coalesce(F.col("r.revenue_item_full"), F.col("t.revenue_item")),
        "is_completed": flag(F.col("t.status") == "Completed"),
        "is_reversed": flag(F.col("t.status") == "Reversed"),
        "is_negative_amount": flag(F.col("t.amount") < 0),
        "payment_method_clean": clean_payment_method(F.col("t.payment_method")),
    }
    return joined.select(
        *[computed[c].alias(c) if c in computed else F.col(f"t.{c}").alias(c) for c in FCT_TRANSACTION_COLUMNS]
    )


def _permit_select(t: str, p: str) -> list:
    computed = {
        "paid_amount": F.col(f"{t}.amount"),
        "variance_amount": F.col(f"{t}.amount") - F.col(f"{p}.expected_amount"),
        "is_fully_paid": flag(F.col(f"{t}.amount") >= F.col(f"{p}.expected_amount")),
    }
    out = []
    for c in FCT_PERMIT_COLUMNS:
        if c in computed:
            out.append(computed[c].alias(c))
        elif c in PERMIT_COLUMNS:
            out.append(F.col(f"{p}.{c}").alias(c))
        else:
            out.append(F.col(f"{t}.{c}").alias(c))
    return out


def fct_concession_permits(fct_tx: DataFrame, stg_permits: DataFrame, small_permits: bool | None = None) -> DataFrame:
    """Transactions whose raw revenue item is an active permit's product code; one row per matching permit.

    fct_transactions carries the raw revenue_item unchanged and transaction_id is its key, so joining it to the
    permits directly equals the two-step form (raw transactions ⋈ permits, then ⋈ fct_transactions on the id)
    without the second join; the oracle SQL uses the two-step form.
    """
    joined = lookup(fct_tx, stg_permits.select(*PERMIT_COLUMNS), "revenue_item", "product_code", "transaction_id", "inner", small_permits)
    return joined.select(*_permit_select("t", "r"))


def fct_agent_enumeration(stg_enum: DataFrame, stg_agents: DataFrame) -> DataFrame:
    """Enumeration counts per agent (left join on email) and item/category/day.

    Enumerations are first counted per (created_by, item, category, day): that partial aggregate runs
    map-side, so a prolific agent collapses to a few rows before any shuffle, and the join sees counts
    instead of raw rows. A left join keeps unmatched enumerations with NULL agent columns; an email held
    by several agents counts the enumerations once per agent, split by user_id.
    """
    per_creator = stg_enum.groupBy(
        "created_by", "revenue_item", "category", F.to_date("create_time").alias("create_day")
    ).agg(F.count("enumeration_pk").alias("n"))
    agents = stg_agents.select(
        "user_id", F.col("email").alias("agent_email"), "first_name", "last_name", "phone_no", "lga", "user_cat",
        "bank", "bank_account", "agent_status", "agent_code",
    )
    joined = per_creator.join(agents, per_creator["created_by"] == agents["agent_email"], "left")
    return joined.groupBy(
        *AGENT_COLUMNS,
        "revenue_item",
        case_map(F.col("revenue_item"), REVENUE_TYPES).alias("revenue_type"),
        "category",
        "create_day",
        year_month("create_day").alias("create_month"),
        year("create_day").alias("create_year"),
    ).agg(F.sum("n").alias("enumeration_count"))


def agg_revenue_daily(fct_tx: DataFrame) -> DataFrame:
    """Completed transactions per day and 8 keys; NULL keys form groups of their own."""
    return (
        fct_tx.filter(F.col("is_completed"))
        .groupBy(
            "payment_day", "payment_month", "payment_year", "lga", "mda", "revenue_item", "transaction_channel",
            "payment_method_clean",
        )
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.count_distinct("agent_user").alias("unique_agents"),
            F.count_distinct("taxpayer_name").alias("unique_taxpayers"),
            F.sum("amount").alias("total_amount"),
            exact_avg("amount").alias("avg_amount"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
            F.count_if(F.col("is_reversed")).alias("reversed_count"),
            F.count_if(F.col("is_negative_amount")).alias("negative_amount_count"),
        )
    )


def agg_concession_by_plancode(fct_permits: DataFrame) -> DataFrame:
    """Completed permit payments per day, plan, product and channel keys.

    transaction_count is distinct (a transaction matching two permits with one code counts once) while the
    amounts run over rows, so such a transaction is summed twice, as the model defines it.
    """
    return (
        fct_permits.filter(F.col("is_completed"))
        .groupBy(
            "payment_day", "payment_month", "payment_year", "plan_code", "category", "product_code", "product_name",
            "lga", "transaction_channel", "payment_method_clean",
        )
        .agg(
            F.count_distinct("transaction_id").alias("transaction_count"),
            F.count_distinct("taxpayer_name").alias("unique_taxpayers"),
            F.count_distinct("agent_user").alias("unique_agents"),
            F.sum("paid_amount").alias("total_paid_amount"),
            exact_avg("paid_amount").alias("avg_paid_amount"),
            F.min("paid_amount").alias("min_paid_amount"),
            F.max("paid_amount").alias("max_paid_amount"),
            F.max("expected_amount").alias("expected_amount"),
            F.max("previous_expected_amount").alias("previous_expected_amount"),
            (F.max("expected_amount") * F.count_distinct("transaction_id") - F.sum("paid_amount")).alias(
                "total_shortfall"
            ),
            F.count_if(F.col("is_reversed")).alias("reversed_count"),
            F.count_if(F.col("is_fully_paid")).alias("fully_paid_count"),
        )
    )


# Combined-revenue layout: the concession side's types; the bus side is cast to them.
COMBINED_TYPES = (
    ("revenue_source", "string"), ("revenue_date", "date"), ("revenue_month", "timestamp_ntz"),
    ("revenue_year", "int"), ("lga", "string"), ("transaction_channel", "string"),
    ("payment_method_clean", "string"), ("category", "string"), ("product_code", "string"),
    ("product_name", "string"), ("transaction_count", "bigint"), ("unique_payers", "bigint"),
    ("unique_agents", "bigint"), ("total_amount", "decimal(29,2)"), ("avg_amount", "double"),
    ("min_amount", "decimal(19,2)"), ("max_amount", "decimal(19,2)"), ("expected_amount", "decimal(10,2)"),
    ("total_shortfall", "decimal(32,2)"), ("reversed_count", "bigint"), ("fully_paid_count", "bigint"),
)


def agg_bus_daily(stg_bus: DataFrame) -> DataFrame:
    """Bus ticket revenue per day, in the combined layout (the six dimensions and last four measures NULL)."""
    agg = stg_bus.groupBy(
        F.col("transaction_day").alias("revenue_date"),
        F.col("transaction_month").alias("revenue_month"),
        F.col("transaction_year").alias("revenue_year"),
    ).agg(
        F.count_distinct("ticket_id").alias("transaction_count"),
        F.count_distinct("phone").alias("unique_payers"),
        F.count_distinct("issuer_id").alias("unique_agents"),
        F.sum("amount").alias("total_amount"),
        exact_avg("amount").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    present = set(agg.columns)
    return agg.select(
        *[
            (F.col(c) if c in present else (F.lit(BUS_SOURCE) if c == "revenue_source" else F.lit(None)))
            .cast(t)
            .alias(c)
            for c, t in COMBINED_TYPES
        ]
    )


def agg_combined_revenue_daily(bus_daily: DataFrame, concession: DataFrame) -> DataFrame:
    """Bus days UNION ALL relabelled concession rows (plan code -> revenue source)."""
    renamed = {
        "revenue_source": case_map(F.col("plan_code"), REVENUE_SOURCES),
        "revenue_date": F.col("payment_day"),
        "revenue_month": F.col("payment_month"),
        "revenue_year": F.col("payment_year"),
        "unique_payers": F.col("unique_taxpayers"),
        "total_amount": F.col("total_paid_amount"),
        "avg_amount": F.col("avg_paid_amount"),
        "min_amount": F.col("min_paid_amount"),
        "max_amount": F.col("max_paid_amount"),
    }
    c = concession.select(*[(renamed.get(n, F.col(n))).cast(t).alias(n) for n, t in COMBINED_TYPES])
    return bus_daily.unionByName(c)
