"""Raw table schemas and the load registry (keys, refresh policy, high-water columns, update columns).

One ``TableSpec`` per source table. Loaders, the merge, the data tests and the fixtures are all driven
from this registry, so the six tables need no code of their own.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

TS = "timestamp_ntz"


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]  # (target name, Spark DDL type), in stored order
    key: str
    refresh: str  # "upsert" | "insert_only" | "full"
    hwm: tuple[str, ...] = ()  # high-water columns; the slice takes rows newer than the lookback in any
    update_columns: tuple[str, ...] = ()  # columns replaced on a key match (upsert only)
    not_null: dict[str, str] = field(default_factory=dict)  # NOT NULL column -> SQL literal default
    source_names: dict[str, str] = field(default_factory=dict)  # target -> source column where they differ
    former_names: dict[str, str] = field(default_factory=dict)  # target -> its name in older stored layouts

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in self.columns))

    def type_of(self, column: str) -> str:
        return dict(self.columns)[column]

    @property
    def row_bytes(self) -> int:
        """A generous per-row size in memory, from the declared types (strings at 64 bytes)."""
        return declared_bytes(self.columns)


def declared_bytes(columns: Sequence[tuple[str, str]]) -> int:
    """A generous size in memory of a row of columns (name, DDL type): strings at 64 bytes."""
    return sum(_TYPE_BYTES.get(t.split("(")[0], 64) for _, t in columns) + 8 * len(columns)


_TYPE_BYTES = {"string": 64, "decimal": 16, "timestamp_ntz": 8, "int": 4, "bigint": 8, "date": 4}


def _cols(spec: str) -> tuple[tuple[str, str], ...]:
    """'a bigint, b, c ts' -> (('a','bigint'), ('b','string'), ('c', TS)); untyped means string."""
    out = []
    for part in re.split(r",(?![^(]*\))", spec):
        bits = part.split()
        name, typ = bits[0], (bits[1] if len(bits) > 1 else "string")
        out.append((name, TS if typ == "ts" else typ))
    return tuple(out)


# Table layouts, key columns, refresh policies and update-column lists of the source system.
AGENT_TRANSACTIONS = TableSpec(
    name="agent_transactions",
    columns=_cols(
        "idagent_transactions bigint, agency, state_id, agent_user, agent_code, trans_date ts, trans_ref,"
        " payment_ref, rev_head, rev_code, refcode, reference, initialize_url, payment_token,"
        " amount decimal(19,2), payment_period, next_date, no_of_days, trans_channel, status, trans_type, lga,"
        " createtime, vehicle_type, vehicle_tonnage, vehicle_content, take_off_point, drop_off_destination,"
        " taxpayer_type, taxpayer_name, taxpayer_email, taxpayer_phone, market, zone_line, shop_number,"
        " revenue_item, payment_method, plate_number, enumeration_id, comment, taxoffice, notice_number,"
        " notice_number_fiscal_year, payment_date ts, valid_date ts, terminalid, terminal_serial_number,"
        " updated_at ts"
    ),
    key="idagent_transactions",
    refresh="upsert",
    hwm=("trans_date",),
    update_columns=("status", "amount", "payment_date", "updated_at"),
    source_names={
        "payment_token": "paymentToken",
        "market": "Market",
        "zone_line": "zoneLine",
        "shop_number": "shopNumber",
        "terminal_serial_number": "terminalSerialNumber",
    },
)

REV_SUB_NEWCODE = TableSpec(
    name="rev_sub_newcode",
    columns=_cols(
        "id int, mda, rev_head, rev_code, item, receipt, idrev_sub int, revenue_item, enter_by, created_at ts"
    ),
    key="id",
    refresh="full",
    not_null={"created_at": "timestamp_ntz'2024-01-01 00:00:00'"},
)

BUS_TICKETING_TRANSACTION = TableSpec(
    name="bus_ticketing_transaction",
    columns=_cols(
        "id int, event, event_name, trans_id, amount decimal(10,2), card_serial, phone, trans_date ts,"
        " checkout ts, bus_id, route_name, entry_point, exit_point, i_type, issuer_id, issuer_name,"
        " created_at ts, updated_at ts"
    ),
    key="id",
    refresh="upsert",
    hwm=("trans_date",),
    update_columns=("amount", "checkout", "updated_at"),
    not_null={"amount": "0.00", "created_at": "timestamp_ntz'2024-01-01 00:00:00'"},
    source_names={
        "event_name": "eventName",
        "trans_id": "transID",
        "card_serial": "cardSerial",
        "trans_date": "transDate",
        "bus_id": "busID",
        "route_name": "routeName",
        "entry_point": "entryPoint",
        "exit_point": "exitPoint",
        "i_type": "iType",
        "issuer_id": "issuerID",
        "issuer_name": "issuerName",
        "created_at": "createdAt",
        "updated_at": "updatedAt",
    },
)

CONCESSION_PERMIT = TableSpec(
    name="concession_permit",
    columns=_cols(
        "id int, merchant_id, category, product_tag, product_code, product_name, amount decimal(10,2),"
        " p_amount decimal(10,2), plan_code, status"
    ),
    key="id",
    refresh="full",
    source_names={
        "product_tag": "productTag",
        "product_code": "productCode",
        "product_name": "productName",
        "p_amount": "pAmount",
        "plan_code": "planCode",
    },
)

ENUMERATION = TableSpec(
    name="enumeration",
    columns=_cols(
        "id int, site_id, enumeration_id, park, taxpayer_id, taxpayer_name, revenue_year, location,"
        " revenue_item, category, union_name, plate_number, market, market_id, zone_line, shop_number,"
        " have_abssin, taxpayer_phone, shop_occupants, income_category, monthly_income, income_amount,"
        " shop_category, occupant_income_amount, payment_method, enumeration_plan, enumeration_fee, status,"
        " enumeration_status, asset_code, enumeration_type, notice_generated int, created_by, create_time ts"
    ),
    key="id",
    refresh="insert_only",
    hwm=("create_time",),
    not_null={"create_time": "timestamp_ntz'2024-01-01 00:00:00'"},
    source_names={
        "site_id": "SiteID",
        "enumeration_id": "EnumerationID",
        "park": "Park",
        "taxpayer_id": "TaxpayerID",
        "taxpayer_name": "TaxpayerName",
        "revenue_year": "RevenueYear",
        "location": "Location",
        "revenue_item": "RevenueItem",
        "category": "Category",
        "union_name": "UnionName",
        "plate_number": "PlateNumber",
        "market": "Market",
        "market_id": "Market_Id",
        "zone_line": "zoneLine",
        "shop_number": "shopNumber",
        "have_abssin": "HaveABSSIN",
        "taxpayer_phone": "TaxpayerPhone",
        "shop_occupants": "shopOccupants",
        "income_category": "IncomeCategory",
        "monthly_income": "MonthlyIncome",
        "income_amount": "IncomeAmount",
        "shop_category": "shopCategory",
        "occupant_income_amount": "occupantIncomeAmount",
        "payment_method": "PaymentMethod",
        "enumeration_plan": "EnumerationPlan",
        "enumeration_fee": "EnumerationFee",
        "status": "Status",
        "enumeration_status": "EnumerationStatus",
        "asset_code": "assetCode",
        "enumeration_type": "enumerationType",
        "notice_generated": "NoticeGenerated",
        "created_by": "CreatedBy",
        "create_time": "CreateTime",
    },
)

MERCHANT_USER = TableSpec(
    name="merchant_user",
    columns=_cols(
        "user_id int, abssin, user_cat, first_name, last_name, company, merchant_id, agent_code,"
        " collection_type, phone_no, email, status, create_by, lga, lga_zone, bank, bank_account, balance,"
        " create_time ts, createdate ts, update_by, update_time ts"
    ),
    key="user_id",
    refresh="upsert",
    hwm=("create_time", "update_time"),
    update_columns=(
        "abssin", "user_cat", "first_name", "last_name", "company", "merchant_id", "agent_code",
        "collection_type", "phone_no", "email", "status", "create_by", "lga", "lga_zone", "bank",
        "bank_account", "balance", "create_time", "createdate", "update_by", "update_time",
    ),
)

WATERMARK = TableSpec(
    name="etl_watermark",
    columns=_cols("table_name, last_loaded_at ts, last_run_at ts, rows_loaded bigint"),
    key="table_name",
    refresh="upsert",
)

# Load order of the daily run.
LOAD_ORDER = (
    AGENT_TRANSACTIONS,
    REV_SUB_NEWCODE,
    BUS_TICKETING_TRANSACTION,
    CONCESSION_PERMIT,
    ENUMERATION,
    MERCHANT_USER,
)
SPECS = {s.name: s for s in LOAD_ORDER}

# Declared data tests (table, column, test).
DATA_TESTS = (
    ("agent_transactions", "idagent_transactions", "unique"),
    ("agent_transactions", "idagent_transactions", "not_null"),
    ("rev_sub_newcode", "id", "unique"),
    ("rev_sub_newcode", "id", "not_null"),
    ("rev_sub_newcode", "rev_code", "unique"),
    ("bus_ticketing_transaction", "id", "unique"),
    ("bus_ticketing_transaction", "id", "not_null"),
    ("concession_permit", "id", "unique"),
    ("concession_permit", "id", "not_null"),
    ("enumeration", "id", "unique"),
    ("enumeration", "id", "not_null"),
    ("merchant_user", "user_id", "unique"),
    ("merchant_user", "user_id", "not_null"),
)

# Columns the source profile expects on agent_transactions.
PROFILE_EXPECTED_COLUMNS = (
    "idagent_transactions", "agency", "state_id", "agent_user", "agent_code",
    "trans_date", "trans_ref", "payment_ref", "rev_head", "rev_code",
    "amount", "status", "trans_type", "lga", "trans_channel",
    "taxpayer_name", "taxpayer_email", "taxpayer_phone", "plate_number",
    "payment_date", "updated_at",
)

# Columns of the "latest rows" sample in the source profile.
PROFILE_SAMPLE_COLUMNS = (
    "idagent_transactions", "agency", "state_id", "agent_user", "trans_date",
    "amount", "status", "trans_type", "lga", "taxpayer_name", "payment_date",
)

# First-load fallback watermark, lookback days, bulk back-fill start.
FALLBACK_START = "2025-01-01 00:00:00"
LOOKBACK_DAYS = 3
BULK_START = "2025-01-01 00:00:00"
