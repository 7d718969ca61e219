"""Weekly reports over the marts: window, the four report queries, the empty-report gate, the index, CSV files.

Report results are grouped by a dimension (MDA, revenue item, bus, agent), so they are small; only they are
coalesced to one CSV file each. Everything before the final aggregate runs partitioned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levyline.functions import date_lit
from levyline.plans.models import RevenueModels


def report_window(as_of: str | dt.date | None = None) -> tuple[str, str]:
    """The seven days before ``as_of`` (default: today): as_of − 7 … as_of − 1, both inclusive."""
    day = dt.date.today() if as_of is None else dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return (day - dt.timedelta(days=7)).isoformat(), (day - dt.timedelta(days=1)).isoformat()


def _in_window(col: str, start: str, end: str):
    return F.col(col).between(date_lit(start), date_lit(end))


def _ordered(df: DataFrame, col: str) -> DataFrame:
    """Largest first, NULL first (the source database's DESC)."""
    return df.orderBy(F.col(col).desc_nulls_first())


# The ordering column of each report.
REPORT_ORDER = {"mda": "total_amount", "eticket": "Revenue", "bus": "revenue", "agents": "total_enumeration_count"}


def report_mda(agg_revenue_daily: DataFrame, start: str, end: str, ordered: bool = True) -> DataFrame:
    """Collections per MDA: re-aggregation of the daily mart over the window."""
    out = (
        agg_revenue_daily.filter(_in_window("payment_day", start, end))
        .groupBy("mda")
        .agg(
            F.sum("transaction_count").cast("bigint").alias("transaction_count"),
            F.sum("total_amount").alias("total_amount"),
        )
    )
    return _ordered(out, "total_amount") if ordered else out


def report_eticket(fct_transactions: DataFrame, start: str, end: str, ordered: bool = True) -> DataFrame:
    """Completed tickets with a payment period, per revenue item."""
    out = (
        fct_transactions.filter(
            _in_window("payment_day", start, end)
            & F.col("is_completed")
            & F.col("payment_period").isNotNull()
            & (F.col("payment_period") != "")
        )
        .groupBy(F.col("revenue_item").alias("Ticket type"))
        .agg(F.count(F.lit(1)).alias("Ticket sold"), F.sum("amount").alias("Revenue"))
    )
    return _ordered(out, "Revenue") if ordered else out


def report_bus(stg_bus: DataFrame, start: str, end: str, ordered: bool = True) -> DataFrame:
    """Trips and revenue per bus."""
    out = (
        stg_bus.filter(_in_window("transaction_day", start, end))
        .groupBy("bus_id")
        .agg(F.count("ticket_id").alias("trips"), F.sum("amount").alias("revenue"))
    )
    return _ordered(out, "revenue") if ordered else out


def report_agent_enumeration(fct_agent_enumeration: DataFrame, start: str, end: str, ordered: bool = True) -> DataFrame:
    """Enumerations per verified agent. The equality on the left-joined status drops enumerations without an agent."""
    out = (
        fct_agent_enumeration.filter((F.col("agent_status") == "Verified") & _in_window("create_day", start, end))
        .groupBy("agent_email", "first_name", "last_name", "bank", "bank_account")
        .agg(F.sum("enumeration_count").cast("bigint").alias("total_enumeration_count"))
    )
    return _ordered(out, "total_enumeration_count") if ordered else out


# Report names and CSV file stems, in attachment order.
REPORT_FILES = (
    ("mda", "mda_collections"),
    ("eticket", "eticket_type_breakdown"),
    ("bus", "bus_performance_summary"),
    ("agents", "agent_enumeration"),
)
# The empty-report gate looks at these three only.
GATE_REPORTS = ("mda", "eticket", "bus")


def weekly_reports(m: RevenueModels, as_of: str | dt.date, ordered: bool = True) -> dict[str, DataFrame]:
    start, end = report_window(as_of)
    return {
        "mda": report_mda(m.agg_revenue_daily, start, end, ordered),
        "eticket": report_eticket(m.fct_transactions, start, end, ordered),
        "bus": report_bus(m.stg_bus_ticketing_transaction, start, end, ordered),
        "agents": report_agent_enumeration(m.fct_agent_enumeration, start, end, ordered),
    }


def file_name(stem: str, start: str, end: str) -> str:
    return f"{stem}_{start}_to_{end}.csv"


def report_index(reports: dict[str, DataFrame], as_of: str | dt.date) -> DataFrame:
    """One row per report: file name, period, row count, and whether the set is produced (gate)."""
    start, end = report_window(as_of)
    parts = [
        reports[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("report"),
            F.lit(file_name(stem, start, end)).alias("file_name"),
            date_lit(start).alias("period_start"),
            date_lit(end).alias("period_end"),
            "row_count",
        )
        for name, stem in REPORT_FILES
    ]
    index = parts[0]
    for p in parts[1:]:
        index = index.unionByName(p)
    # Four rows, one window over all of them: the gate passes if any of the gated reports has rows.
    gated = F.when(F.col("report").isin(*GATE_REPORTS), F.col("row_count")).otherwise(F.lit(0))
    return index.withColumn("produced", F.max(gated).over(Window.partitionBy(F.lit(0))) > 0)


def write_reports(reports: dict[str, DataFrame], as_of: str | dt.date, out_dir: str) -> dict[str, str]:
    """Write each report as one CSV file (with header, even when empty) under ``out_dir``; return name -> path.

    Nothing is written when the gate fails. Quotes are doubled and NULL and '' are both written empty, as a
    plain CSV writer does; lines end with LF.
    """
    start, end = report_window(as_of)
    if all(reports[n].isEmpty() for n in GATE_REPORTS):
        return {}
    paths = {}
    for name, stem in REPORT_FILES:
        path = f"{out_dir.rstrip('/')}/{file_name(stem, start, end)}"
        df = reports[name].repartition(1)  # aggregated in parallel; the result (one row per dimension value) is one file
        if REPORT_ORDER[name] in df.columns:
            df = df.sortWithinPartitions(F.col(REPORT_ORDER[name]).desc_nulls_first())
        (
            df.write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .option("emptyValue", "")
            .option("nullValue", "")
            .csv(path)
        )
        paths[name] = path
    return paths
