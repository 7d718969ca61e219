"""Staging views: renames, calendar parts and the two row filters. Lazy DataFrames, never materialised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyline.functions import day, month_start, year

# Staging renames (source column -> staging column).
AGENT_TRANSACTION_RENAMES = {
    "idagent_transactions": "transaction_id",
    "trans_date": "transaction_date",
    "trans_ref": "transaction_ref",
    "rev_head": "revenue_head",
    "rev_code": "revenue_code",
    "trans_channel": "transaction_channel",
    "trans_type": "transaction_type",
    "taxoffice": "tax_office",
    "terminalid": "terminal_id",
}
BUS_RENAMES = {"id": "ticket_id", "trans_id": "transaction_ref", "trans_date": "transaction_date", "i_type": "instrument_type"}
PERMIT_RENAMES = {"id": "permit_id", "amount": "expected_amount", "p_amount": "previous_expected_amount"}
ENUMERATION_RENAMES = {"id": "enumeration_pk"}
MERCHANT_RENAMES = {"status": "agent_status"}
REV_CODE_RENAMES = {
    "id": "rev_sub_id",
    "item": "revenue_item_name",
    "idrev_sub": "rev_sub_ref_id",
    "revenue_item": "revenue_item_full",
}

# Staging column order of the agent transactions view (raw names before renaming).
AGENT_TRANSACTION_COLUMNS = (
    "idagent_transactions", "agency", "state_id", "agent_user", "agent_code", "trans_date", "trans_ref",
    "payment_ref", "rev_head", "rev_code", "refcode", "reference", "amount", "payment_period", "trans_channel",
    "status", "trans_type", "lga", "taxpayer_type", "taxpayer_name", "taxpayer_email", "taxpayer_phone", "market",
    "zone_line", "shop_number", "revenue_item", "payment_method", "plate_number", "enumeration_id", "vehicle_type",
    "vehicle_tonnage", "vehicle_content", "take_off_point", "drop_off_destination", "taxoffice", "notice_number",
    "notice_number_fiscal_year", "payment_date", "valid_date", "terminalid", "terminal_serial_number", "updated_at",
)

# Permits that count as concessions.
PERMIT_STATUS = "Active"
PERMIT_PLANS = ("Vehicle", "Trader")


def _renamed(df: DataFrame, renames: dict[str, str], columns=None) -> DataFrame:
    cols = columns or df.columns
    return df.selectExpr(*[f"`{c}` AS `{renames.get(c, c)}`" for c in cols])


def stg_agent_transactions(raw: DataFrame) -> DataFrame:
    """42 of 48 columns (9 renamed) + payment day/month/year; only rows with a payment date."""
    return (
        raw.filter(F.col("payment_date").isNotNull())
        .transform(lambda d: _renamed(d, AGENT_TRANSACTION_RENAMES, AGENT_TRANSACTION_COLUMNS))
        .withColumns(
            {
                "payment_day": day("payment_date"),
                "payment_month": month_start("payment_date"),
                "payment_year": year("payment_date"),
            }
        )
    )


def stg_bus_ticketing_transaction(raw: DataFrame) -> DataFrame:
    """18 columns (4 renamed) + transaction day/month/year; only rows with a transaction date."""
    return (
        raw.filter(F.col("trans_date").isNotNull())
        .transform(lambda d: _renamed(d, BUS_RENAMES))
        .withColumns(
            {
                "transaction_day": day("transaction_date"),
                "transaction_month": month_start("transaction_date"),
                "transaction_year": year("transaction_date"),
            }
        )
    )


def stg_concession_permit(raw: DataFrame) -> DataFrame:
    """Active Vehicle/Trader permits, 3 renames."""
    return raw.filter((F.col("status") == PERMIT_STATUS) & F.col("plan_code").isin(*PERMIT_PLANS)).transform(
        lambda d: _renamed(d, PERMIT_RENAMES)
    )


def stg_enumeration(raw: DataFrame) -> DataFrame:
    return _renamed(raw, ENUMERATION_RENAMES)


def stg_merchant_user(raw: DataFrame) -> DataFrame:
    return _renamed(raw, MERCHANT_RENAMES)


def stg_rev_sub_newcode(raw: DataFrame) -> DataFrame:
    return _renamed(raw, REV_CODE_RENAMES)


STAGING = {
    "agent_transactions": stg_agent_transactions,
    "bus_ticketing_transaction": stg_bus_ticketing_transaction,
    "concession_permit": stg_concession_permit,
    "enumeration": stg_enumeration,
    "merchant_user": stg_merchant_user,
    "rev_sub_newcode": stg_rev_sub_newcode,
}
