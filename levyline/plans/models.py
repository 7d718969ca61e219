"""The model graph: raw tables -> staging views -> marts, built lazily from one mapping of raw tables.

Each property returns the same DataFrame object on every access, so a plan that uses a model twice
(fct_transactions feeds three consumers) shares one subtree and Spark reuses its exchanges.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from levyline.operators.lookup import measured_bytes
from levyline.plans import marts, staging


class RevenueModels:
    def __init__(self, raw: Mapping[str, DataFrame]):
        self.raw = raw

    # staging views
    @cached_property
    def stg_agent_transactions(self) -> DataFrame:
        return staging.stg_agent_transactions(self.raw["agent_transactions"])

    @cached_property
    def stg_bus_ticketing_transaction(self) -> DataFrame:
        return staging.stg_bus_ticketing_transaction(self.raw["bus_ticketing_transaction"])

    @cached_property
    def stg_concession_permit(self) -> DataFrame:
        return staging.stg_concession_permit(self.raw["concession_permit"])

    @cached_property
    def stg_enumeration(self) -> DataFrame:
        return staging.stg_enumeration(self.raw["enumeration"])

    @cached_property
    def stg_merchant_user(self) -> DataFrame:
        return staging.stg_merchant_user(self.raw["merchant_user"])

    @cached_property
    def stg_rev_sub_newcode(self) -> DataFrame:
        return staging.stg_rev_sub_newcode(self.raw["rev_sub_newcode"])

    # whether the reference tables are small, measured once a graph by a bounded read of the columns that are joined
    @cached_property
    def small_codes(self) -> bool:
        return measured_bytes(self.stg_rev_sub_newcode.select("rev_code", "mda", "revenue_item_full")) is not None

    @cached_property
    def small_permits(self) -> bool:
        return measured_bytes(self.stg_concession_permit.select(*marts.PERMIT_COLUMNS)) is not None

    # marts
    @cached_property
    def fct_transactions(self) -> DataFrame:
        return marts.fct_transactions(self.stg_agent_transactions, self.stg_rev_sub_newcode, self.small_codes)

    @cached_property
    def fct_concession_permits(self) -> DataFrame:
        return marts.fct_concession_permits(self.fct_transactions, self.stg_concession_permit, self.small_permits)

    @cached_property
    def fct_agent_enumeration(self) -> DataFrame:
        return marts.fct_agent_enumeration(self.stg_enumeration, self.stg_merchant_user)

    @cached_property
    def agg_revenue_daily(self) -> DataFrame:
        return marts.agg_revenue_daily(self.fct_transactions)

    @cached_property
    def agg_concession_by_plancode(self) -> DataFrame:
        return marts.agg_concession_by_plancode(self.fct_concession_permits)

    @cached_property
    def agg_bus_daily(self) -> DataFrame:
        return marts.agg_bus_daily(self.stg_bus_ticketing_transaction)

    @cached_property
    def agg_combined_revenue_daily(self) -> DataFrame:
        return marts.agg_combined_revenue_daily(self.agg_bus_daily, self.agg_concession_by_plancode)

    STAGING = (
        "stg_agent_transactions",
        "stg_bus_ticketing_transaction",
        "stg_concession_permit",
        "stg_enumeration",
        "stg_merchant_user",
        "stg_rev_sub_newcode",
    )
    # Materialised marts, in dependency order.
    MARTS = (
        "fct_transactions",
        "fct_concession_permits",
        "fct_agent_enumeration",
        "agg_revenue_daily",
        "agg_concession_by_plancode",
        "agg_combined_revenue_daily",
    )

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)


def register_views(spark, models: RevenueModels, names=None) -> list[str]:
    """Expose models as temporary views (the staging layer as views), for SQL users."""
    names = list(names or (RevenueModels.STAGING + RevenueModels.MARTS))
    for n in names:
        models.model(n).createOrReplaceTempView(n)
    return names
